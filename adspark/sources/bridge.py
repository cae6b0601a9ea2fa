"""Raw-shaped advertising inputs derived from the driver's test tables.

The reference reads three CSV files (ad events, campaigns, users) that ship without
data.  This module derives the same three shapes, every column as text like a CSV
scan gives, from ``events``, ``part``, ``customer`` and ``nation``, so that all later
stages run on data whose size grows with the scale factor:

* campaigns: one per part row; id ``p_partkey + 1``, advertiser ``p_brand``;
* ad events: one per ``events`` row; campaign ``props.k + 1``, user ``user_id``,
  location = the user's nation, clicked when ``event_type = 'click'``;
* users: one per customer.

``dirty=True`` blanks some costs, breaks some timestamps and repeats some rows, the
inputs the cleaning stage exists for.  The DuckDB oracle in ``__spark_entry__`` spells
the same derivation in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adspark.operators.keys import lookup_side


@dataclass
class RawInputs:
    ad_events: DataFrame
    campaigns: DataFrame
    users: DataFrame


_SCANS: dict[tuple, DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one driver table; the (immutable) input's scan is reused within a
    session so its footers are read once."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _SCANS:
        _SCANS[key] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return _SCANS[key]


def _s(c) -> F.Column:
    return c.cast("string")


def _campaign_attrs(part: DataFrame) -> DataFrame:
    # SQL text: one call per column into the JVM (column objects cost a call per literal)
    return part.selectExpr(
        "p_partkey + 1 AS campaign_id",
        "concat('Campaign_', CAST(p_partkey + 1 AS STRING)) AS campaign_name",
        "p_brand AS advertiser_name",
        "date_add(DATE'2024-01-01', CAST(p_partkey % 10 AS INT)) AS start_date",
        "date_add(date_add(DATE'2024-01-01', CAST(p_partkey % 10 AS INT)), p_size + 30) AS end_date",
        "concat('Age ', CAST(p_size AS STRING), '-', CAST(p_size + 10 AS STRING), ', ', p_type, ', NATION_', "
        "CAST(p_partkey % 25 AS STRING)) AS targeting",
        "p_type AS interest",
        "concat('NATION_', CAST(p_partkey % 25 AS STRING)) AS country",
        "CASE p_size % 3 WHEN 0 THEN '300x250' WHEN 1 THEN '728x90' ELSE '160x600' END AS slot",
        "p_retailprice AS budget",
        "round(p_retailprice * (p_partkey % 10) / 10, 2) AS remaining",
    )


def raw_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _campaign_attrs(read_table(spark, sf_dir, "part"))
    return c.select(
        _s(F.col("campaign_id")).alias("CampaignID"),
        F.col("advertiser_name").alias("AdvertiserName"),
        F.col("campaign_name").alias("CampaignName"),
        _s(F.col("start_date")).alias("CampaignStartDate"),
        _s(F.col("end_date")).alias("CampaignEndDate"),
        F.col("targeting").alias("TargetingCriteria"),
        F.col("slot").alias("AdSlotSize"),
        _s(F.col("budget")).alias("Budget"),
        _s(F.col("remaining")).alias("RemainingBudget"),
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    gender = (F.when(key % 6 == 0, "Male").when(key % 6 == 1, "Female").when(key % 6 == 2, "Non-Binary")
              .when(key % 6 == 3, "Other").when(key % 6 == 4, "Prefer not to say").otherwise("Unknown"))
    return (cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey, "left")  # 25 nations
            .select(_s(key).alias("UserID"),
                    _s(F.lit(18) + key % 60).alias("Age"),
                    gender.alias("Gender"),
                    F.col("n_name").alias("Location"),
                    F.concat(F.col("c_mktsegment"), F.lit(", , "), F.lower("c_mktsegment")).alias("Interests"),
                    _s(F.date_add(F.lit("2023-01-01").cast("date"), (key % 365).cast("int"))).alias("SignupDate")))


def raw_ad_events(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    camp = _campaign_attrs(read_table(spark, sf_dir, "part")).withColumn("k", F.col("campaign_id") - 1)
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    users = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey, "left") \
        .select(F.col("c_custkey"), F.col("n_name"))
    # users first: the campaigns' columns widen the rows
    df = (ev.join(lookup_side(users), ev.user_id == users.c_custkey, "left")
            .join(lookup_side(camp), "k", "left"))
    cost = "CAST(value AS STRING)"
    ts = "CAST(ts AS STRING)"
    if dirty:
        cost = f"CASE WHEN event_id % 97 = 0 THEN '' ELSE {cost} END"
        ts = f"CASE WHEN event_id % 89 = 0 THEN 'bad' ELSE {ts} END"
    out = df.selectExpr(
        "CAST(event_id AS STRING) AS EventID",
        "advertiser_name AS AdvertiserName",
        "campaign_name AS CampaignName",
        "CAST(start_date AS STRING) AS CampaignStartDate",
        "CAST(end_date AS STRING) AS CampaignEndDate",
        "interest AS CampaignTargetingInterest",
        "country AS CampaignTargetingCountry",
        "CAST(user_id AS STRING) AS UserID",
        "CASE event_id % 3 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'Desktop' ELSE 'Tablet' END AS Device",
        "n_name AS Location",
        f"{ts} AS Timestamp",
        "CASE WHEN event_type = 'click' THEN CAST(ts + INTERVAL 30 SECONDS AS STRING) END AS ClickTimestamp",
        "CAST(value * 2 AS STRING) AS BidAmount",
        f"{cost} AS AdCost",
        "CASE WHEN event_type = 'click' THEN CAST(round(value * 1.2, 2) AS STRING) ELSE '0.0' END AS AdRevenue",
        "CAST(budget AS STRING) AS Budget",
        "CAST(remaining AS STRING) AS RemainingBudget",
        "CASE WHEN event_type = 'click' THEN 'True' ELSE 'False' END AS WasClicked",
    )
    if dirty:  # every 50th event arrives twice (one pass: explode 1 or 2 copies)
        copies = F.array_repeat(F.struct(*out.columns), F.when(F.col("EventID").cast("bigint") % 50 == 0, 2)
                                .otherwise(1))
        out = out.select(F.explode(copies).alias("_r")).select("_r.*")
    return out


def raw_inputs(spark: SparkSession, sf_dir: str, dirty: bool = False) -> RawInputs:
    return RawInputs(raw_ad_events(spark, sf_dir, dirty), raw_campaigns(spark, sf_dir), raw_users(spark, sf_dir))


# What is wrong with the dirty star: table -> column -> its value, in SQL that any engine reads.
DIRTY_STAR = {
    "users": {"age": "CASE WHEN user_id % 50 = 0 THEN 0 ELSE age END",
              "gender": "CASE WHEN user_id % 70 = 0 THEN 'Unknown' ELSE gender END",
              "country_id": "CASE WHEN user_id % 30 = 0 THEN 999 ELSE country_id END"},
    "campaigns": {"campaign_name": "CASE WHEN campaign_id % 40 = 0 THEN NULL WHEN campaign_id % 45 = 0 THEN repeat('n', 120) "
                                   "WHEN campaign_id % 15 = 1 THEN 'Campaign_again' ELSE campaign_name END",
                  "advertiser_id": "CASE WHEN campaign_id % 60 = 0 THEN 9999 ELSE advertiser_id END",
                  "campaign_start_date": "CASE WHEN campaign_id % 75 = 0 THEN NULL ELSE campaign_start_date END",
                  "targeting_age_from": "CASE WHEN campaign_id % 25 = 0 THEN 0 ELSE targeting_age_from END",
                  "targeting_interest_id": "CASE WHEN campaign_id % 35 = 0 THEN 9999 ELSE targeting_interest_id END",
                  "targeting_country_id": "CASE WHEN campaign_id % 55 = 0 THEN 9999 ELSE targeting_country_id END",
                  "budget": "CASE WHEN campaign_id % 65 = 0 THEN 99999999999.00 ELSE budget END"},
    "users_interests": {"interest_id": "CASE WHEN user_id % 33 = 0 THEN 9999 WHEN user_id % 44 = 0 THEN 1 ELSE interest_id END",
                        "user_id": "CASE WHEN user_id % 66 = 0 THEN 9999999 ELSE user_id END"},
    "ad_impressions": {"device": "CASE WHEN CAST(impression_id AS BIGINT) % 200 = 0 THEN 'Watch' ELSE device END",
                       "user_id": "CASE WHEN CAST(impression_id AS BIGINT) % 210 = 0 THEN 9999999 ELSE user_id END",
                       "campaign_id": "CASE WHEN CAST(impression_id AS BIGINT) % 220 = 0 THEN NULL "
                                      "WHEN CAST(impression_id AS BIGINT) % 130 = 0 THEN 9999999 ELSE campaign_id END",
                       "location_id": "CASE WHEN CAST(impression_id AS BIGINT) % 230 = 0 THEN 999 ELSE location_id END",
                       "ad_cost": "CASE WHEN CAST(impression_id AS BIGINT) % 250 = 0 THEN 12345.5000 ELSE ad_cost END",
                       "impression_id": "CASE WHEN CAST(impression_id AS BIGINT) % 300 = 0 THEN '7' "
                                        "WHEN CAST(impression_id AS BIGINT) % 310 = 0 THEN repeat('9', 60) ELSE impression_id END"},
    "ad_clicks": {"impression_id": "CASE WHEN click_id % 50 = 0 THEN concat('none-', click_id) WHEN click_id % 51 = 0 THEN '7' "
                                   "ELSE impression_id END",
                  "click_timestamp": "CASE WHEN click_id % 60 = 0 THEN NULL ELSE click_timestamp END"},
    "countries": {"country_name": "CASE WHEN country_id = 3 THEN 'NATION_1' WHEN country_id = 5 THEN repeat('c', 256) "
                                  "ELSE country_name END"},
    "advertisers": {"advertiser_name": "CASE WHEN advertiser_id = 2 THEN NULL ELSE advertiser_name END"},
    "interests": {},
}


def dirty_star(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The star with every kind of broken constraint."""
    return {name: tables[name].selectExpr(*[f"{changes[c]} AS {c}" if c in changes else c for c in tables[name].columns])
            for name, changes in DIRTY_STAR.items()}


# What is wrong with the dirty clean tables (SQL that any engine reads): names that no dimension has, and none at all.
DIRTY_CLEAN = {
    "events_clean": {"location": "CASE WHEN CAST(event_id AS BIGINT) % 40 = 0 THEN 'ATLANTIS' "
                                 "WHEN CAST(event_id AS BIGINT) % 41 = 0 THEN NULL ELSE location END",
                     "campaign_name": "CASE WHEN CAST(event_id AS BIGINT) % 60 = 0 THEN 'Campaign_lost' "
                                      "WHEN CAST(event_id AS BIGINT) % 61 = 0 THEN NULL ELSE campaign_name END",
                     "was_clicked": "CASE WHEN CAST(event_id AS BIGINT) % 9 = 0 THEN NULL ELSE was_clicked END"},
    "campaigns_clean": {"advertiser_name": "CASE WHEN campaign_id % 70 = 0 THEN 'Nobody' ELSE advertiser_name END"},
}


def dirty_clean(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """A clean table with the names and flags that cleaning lets through."""
    changes = DIRTY_CLEAN[name]
    return tables[name].selectExpr(*[f"{changes[c]} AS {c}" if c in changes else c for c in tables[name].columns])
