"""SQL report questions (F1-F7) and entity metrics (G1-G3) over the star.

Shape of every plan: filter the fact (pushed to the Parquet scan), read impressions
with their click (joined once at load time), aggregate per small key with
partial aggregation, and only then join dimension names with a size-checked
broadcast.  Ties in top-k are broken by id ascending (T13).  Money is summed exactly
as DECIMAL and rounded half away from zero; ratios are rounded through integers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspark.functions.metrics import money_sum, money_units, round_money, round_ratio
from adspark.operators.keys import broadcastable, lookup_side


def _ts(x: str) -> F.Column:
    return F.lit(x).cast("timestamp_ntz")


def window_impressions(star: dict, start: str | None, end: str | None, cols: list[str],
                       with_clicks: bool = False) -> DataFrame:
    """Impressions with ``impression_timestamp BETWEEN start AND end`` (closed; a date
    literal means midnight, so the last day stops at 00:00, T14).

    ``with_clicks`` gives ``impressions LEFT JOIN clicks ON impression_id`` (adds
    ``click_id``, ``click_timestamp``).  The warehouse publishes that join once at load
    time (``impression_clicks``), so a report scans one table; on a bare star the join
    is planned here."""
    if with_clicks and "impression_clicks" in star:
        imps = star["impression_clicks"]
    else:
        imps = star["ad_impressions"]
        if with_clicks:
            imps = join_clicks(imps, star["ad_clicks"])
    if start is not None:
        imps = imps.where(F.col("impression_timestamp").between(_ts(start), _ts(end)))
    return imps.select(*cols)


def join_clicks(impressions: DataFrame, clicks: DataFrame) -> DataFrame:
    """impressions LEFT JOIN clicks on impression_id (one shuffle on a uniform key)."""
    return impressions.join(lookup_side(clicks.select("impression_id", "click_id", "click_timestamp")), "impression_id", "left")


def count_ids(star: dict, col: str, key_checks: set[str]) -> F.Column:
    """COUNT(DISTINCT col) as written; a plain COUNT when the load verified the keys that
    make ``col`` unique in what is counted (no shuffle of every id to de-duplicate)."""
    if key_checks <= set(star.get("_verified_keys", ())):
        return F.count(col)
    return F.countDistinct(col)


def _impressions_counted(star: dict) -> F.Column:
    """Distinct impressions over impressions LEFT JOIN clicks: one row per impression
    when impressions have a primary key and each has at most one click."""
    return count_ids(star, "impression_id", {"pk_ad_impressions", "unique_click_per_impression"})


def _campaign_names(star: dict) -> DataFrame:
    return lookup_side(star["campaigns"].select("campaign_id", "campaign_name"))


def top_campaigns_ctr(star: dict, start: str, end: str, k: int = 5) -> DataFrame:
    """top campaigns by CTR = clicks * 100 / distinct impressions, in a window."""
    j = window_impressions(star, start, end, ["impression_id", "campaign_id", "click_id"], with_clicks=True)
    per = j.groupBy("campaign_id").agg(_impressions_counted(star).alias("impressions"),
                                       F.count("click_id").alias("clicks"))
    out = per.join(_campaign_names(star), "campaign_id").select(
        "campaign_id", "campaign_name", "impressions", "clicks",
        round_ratio(F.col("clicks") * 100, "impressions").alias("ctr_percentage"))
    return out.orderBy(F.desc("ctr_percentage"), "campaign_id").limit(k)


def advertiser_spend(star: dict, start: str, end: str) -> DataFrame:
    """spend per advertiser in the window, highest first."""
    imps = window_impressions(star, start, end, ["campaign_id", "ad_cost"])
    per_adv = spend_by_advertiser(imps, star["campaigns"].select("campaign_id", "advertiser_id"))
    out = per_adv.join(lookup_side(star["advertisers"]), "advertiser_id").select(
        "advertiser_id", "advertiser_name", round_money("spend").alias("total_spent"))
    return out.orderBy(F.desc("total_spent"), "advertiser_id")


def spend_by_advertiser(imps: DataFrame, campaign_advertiser: DataFrame) -> DataFrame:
    """Exact spend per advertiser.  With the campaign -> advertiser map proven small it
    is broadcast and joined on the map side, leaving one partial + final aggregate;
    otherwise impressions are first reduced per campaign and the (small) result is
    joined, so the fact side never shuffles whole."""
    if broadcastable(campaign_advertiser):
        j = imps.join(F.broadcast(campaign_advertiser), "campaign_id")
        return j.groupBy("advertiser_id").agg(money_sum("ad_cost").alias("spend"))
    per_campaign = imps.groupBy("campaign_id").agg(money_sum("ad_cost").alias("spend"))
    return per_campaign.join(campaign_advertiser.hint("merge"), "campaign_id").groupBy("advertiser_id") \
        .agg(F.sum("spend").alias("spend"))


def campaign_cpc_cpm(star: dict, start: str, end: str) -> DataFrame:
    """CPC = cost / clicks (NULL without clicks), CPM = cost / impressions * 1000."""
    j = window_impressions(star, start, end, ["impression_id", "campaign_id", "ad_cost", "click_id"],
                           with_clicks=True)
    per = j.groupBy("campaign_id").agg(money_sum("ad_cost").alias("cost"),
                                       F.count("click_id").alias("k"), F.count("impression_id").alias("n"))
    units = money_units("cost")  # cost in 1/10000
    return per.join(_campaign_names(star), "campaign_id").select(
        "campaign_id", "campaign_name",
        round_ratio(units, F.col("k") * 10000).alias("avg_cpc"),
        round_ratio(units, F.col("n") * 10).alias("avg_cpm"))


def top_locations_revenue(star: dict, start: str, end: str, k: int = 10) -> DataFrame:
    """revenue of clicked impressions per user location, top k (T6: the location
    name comes from the country dimension)."""
    j = window_impressions(star, start, end, ["location_id", "ad_revenue", "click_id"], with_clicks=True) \
        .where(F.col("click_id").isNotNull())  # inner join with clicks
    per = j.groupBy("location_id").agg(money_sum("ad_revenue").alias("rev"))
    names = lookup_side(star["countries"].select(F.col("country_id").alias("location_id"),
                                                     F.col("country_name").alias("user_location")))
    out = per.join(names, "location_id", "left").select("user_location", round_money("rev").alias("total_revenue"))
    return out.orderBy(F.desc("total_revenue"), F.asc_nulls_last("user_location")).limit(k)


def top_users_clicks(star: dict, start: str, end: str, k: int = 10) -> DataFrame:
    """users by clicks, window on the click time."""
    j = window_impressions(star, None, None, ["user_id", "click_id", "click_timestamp"], with_clicks=True) \
        .where(F.col("click_timestamp").between(_ts(start), _ts(end)))  # inner join: a click exists
    per = j.groupBy("user_id").agg(F.count("click_id").alias("total_clicks"))
    per = per.join(lookup_side(star["users"].select("user_id")), "user_id", "left_semi")
    return per.select("user_id", "total_clicks").orderBy(F.desc("total_clicks"), "user_id").limit(k)


def budget_spent(star: dict, threshold_pct: int = 80) -> DataFrame:
    """campaigns that spent at least ``threshold_pct`` % of the budget.

    Compared in integer cents, so 80 % is exact; a zero budget gives no ratio and no row
    (T7)."""
    b = (F.col("budget") * 100).cast("bigint")
    r = (F.col("remaining_budget") * 100).cast("bigint")
    spent = b - r
    hit = F.when(b > 0, spent * 100 >= b * threshold_pct).when(b < 0, spent * 100 <= b * threshold_pct)
    c = star["campaigns"].where(hit)
    pct = F.when(b > 0, round_ratio(spent * 100, b)).otherwise(-round_ratio(spent * 100, -b))
    return c.select("campaign_id", "campaign_name", F.col("budget").cast("double").alias("budget"),
                    F.col("remaining_budget").cast("double").alias("remaining_budget"),
                    pct.alias("percent_spent")).orderBy(F.desc("percent_spent"), "campaign_id")


def device_ctr(star: dict, start: str, end: str) -> DataFrame:
    """CTR per device."""
    j = window_impressions(star, start, end, ["impression_id", "device", "click_id"], with_clicks=True)
    per = j.groupBy("device").agg(_impressions_counted(star).alias("impressions"),
                                  F.count("click_id").alias("clicks"))
    return per.select("device", "impressions", "clicks",
                      round_ratio(F.col("clicks") * 100, "impressions").alias("ctr_percentage")) \
        .orderBy(F.desc("ctr_percentage"), "device")


def campaign_performance(star: dict, campaign_id: int | None = None) -> DataFrame:
    """G1: distinct impressions, distinct clicks, CTR x100 (0 when no impression, rounded
    to 4 places, T16) and spend, for one campaign or all."""
    j = window_impressions(star, None, None, ["impression_id", "campaign_id", "ad_cost", "click_id"],
                           with_clicks=True)
    if campaign_id is not None:
        j = j.where(F.col("campaign_id") == F.lit(campaign_id))
    per = j.groupBy("campaign_id").agg(_impressions_counted(star).alias("impressions"),
                                       count_ids(star, "click_id", {"pk_ad_clicks", "pk_ad_impressions"}).alias("clicks"),
                                       money_sum("ad_cost").alias("spend"))
    return per.select("campaign_id", "impressions", "clicks",
                      F.coalesce(round_ratio(F.col("clicks") * 100, "impressions", 4), F.lit(0.0)).alias("ctr"),
                      F.col("spend").cast("double").alias("ad_spend"))


def advertiser_total_spend(star: dict, advertiser_id: int | None = None) -> DataFrame:
    """All-time spend of one advertiser or all."""
    camp = star["campaigns"].select("campaign_id", "advertiser_id")
    if advertiser_id is not None:
        camp = camp.where(F.col("advertiser_id") == F.lit(advertiser_id))
    per_adv = spend_by_advertiser(star["ad_impressions"].select("campaign_id", "ad_cost"), camp)
    return per_adv.select("advertiser_id", F.col("spend").cast("double").alias("ad_spend"))


def user_engagements(star: dict, user_id: int | None = None) -> DataFrame:
    """Clicked impressions with advertiser; for one user newest click first (an unknown
    user gives an empty frame), for all users unsorted."""
    j = window_impressions(star, None, None, ["impression_id", "campaign_id", "user_id", "impression_timestamp",
                                              "click_id", "click_timestamp"], with_clicks=True) \
        .where(F.col("click_id").isNotNull())
    if user_id is not None:
        j = j.where(F.col("user_id") == F.lit(user_id))
    j = j.join(lookup_side(star["campaigns"].select("campaign_id", "advertiser_id")), "campaign_id")
    out = j.select("user_id", "advertiser_id", "campaign_id", "impression_id", "click_id",
                   F.col("impression_timestamp").alias("impression_time"),
                   F.col("click_timestamp").alias("click_time"))
    return out if user_id is None else out.orderBy(F.desc("click_time"), "click_id")


def sql_report(star: dict, start: str, end: str) -> dict[str, DataFrame]:
    """The reference's SQL report: its seven sections, titled, for one window."""
    return {
        "Top 5 Campaigns by Click-Through Rate (CTR)": top_campaigns_ctr(star, start, end),
        "Advertisers with Highest Spend": advertiser_spend(star, start, end),
        "Cost Efficiency: Average CPC and CPM per Campaign": campaign_cpc_cpm(star, start, end),
        "Top Locations by Total Ad Revenue from Clicks": top_locations_revenue(star, start, end),
        "Top 10 Most Engaged Users by Clicks": top_users_clicks(star, start, end),
        "Campaigns with > 80% Budget Spent": budget_spent(star),
        "CTR Comparison Across Devices": device_ctr(star, start, end),
    }
