"""Questions answered from the rollup tables.

The reference reads 31 single-day partitions one by one and merges them in client
memory; here one filter on the partition column (pruned at planning time) feeds one
re-aggregation.  ``as_of`` anchors the 31-day window ``[as_of - 30, as_of]`` (I12).
Top-k per group uses ``row_number() <= k`` (Spark plans a partial WindowGroupLimit
before the shuffle, so a hot group is cut to k rows per task early).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adspark.functions.metrics import round_ratio


def window_days(as_of: str, days: int = 31) -> F.Column:
    d = F.lit(as_of).cast("date")
    return F.date_sub(d, days - 1), d


def campaign_day_ctr(campaign_day: DataFrame, campaign_id: int | None = None, day: str | None = None) -> DataFrame:
    """CTR % (2 places; 0 when no impression) per campaign and day, or for one."""
    df = campaign_day
    if campaign_id is not None:
        df = df.where(F.col("campaign_id") == F.lit(campaign_id))
    if day is not None:
        df = df.where(F.col("date") == F.lit(day).cast("date"))
    return df.select("campaign_id", "date", "impressions", "clicks",
                     F.coalesce(round_ratio(F.col("clicks") * 100, "impressions"), F.lit(0.0)).alias("ctr"))


def top_advertisers_31d(advertiser_day: DataFrame, as_of: str, k: int = 5) -> DataFrame:
    """I8: top advertisers by spend in the 31-day window."""
    lo, hi = window_days(as_of)
    per = advertiser_day.where(F.col("day").between(lo, hi)).groupBy("advertiser_id") \
        .agg(F.sum("total_spend").alias("s"))
    return per.select("advertiser_id", F.round("s", 2).cast("double").alias("total_spend")) \
        .orderBy(F.desc("total_spend"), "advertiser_id").limit(k)


def top_users_31d(user_day: DataFrame, as_of: str, k: int = 10) -> DataFrame:
    """Top users by clicks in the 31-day window."""
    lo, hi = window_days(as_of)
    per = user_day.where(F.col("day").between(lo, hi)).groupBy("user_id") \
        .agg(F.sum("clicks").cast("bigint").alias("clicks"))
    return per.orderBy(F.desc("clicks"), "user_id").limit(k)


def top_region_advertisers(region_day: DataFrame, as_of: str, region: str | None = None, k: int = 5) -> DataFrame:
    """Top advertisers by spend per region (or in one region) in the window."""
    lo, hi = window_days(as_of)
    df = region_day.where(F.col("day").between(lo, hi))
    if region is not None:
        df = df.where(F.col("region") == F.lit(region))
    per = df.groupBy("region", "advertiser_id").agg(F.round(F.sum("total_spend"), 2).cast("double").alias("total_spend"))
    w = Window.partitionBy("region").orderBy(F.desc("total_spend"), "advertiser_id")
    return per.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def last_ads_seen(history: DataFrame, user_id: int | None = None, scan: int = 50, k: int = 10) -> DataFrame:
    """Per user, the last ``k`` impressions among the newest ``scan`` log rows, with
    'Yes' when the same campaign was clicked within those rows (T11)."""
    df = history if user_id is None else history.where(F.col("user_id") == F.lit(user_id))
    recent = df.withColumn("_r", F.row_number().over(
        Window.partitionBy("user_id").orderBy(F.desc("timestamp")))).where(F.col("_r") <= scan)
    # same user partitioning serves the (user, campaign) window: one shuffle, no join back
    hit = F.max((F.col("action") == "click").cast("int")).over(Window.partitionBy("user_id", "campaign_id"))
    imps = recent.withColumn("_hit", hit).where(F.col("action") == "impression")
    imps = imps.withColumn("rank", F.row_number().over(Window.partitionBy("user_id").orderBy("_r"))) \
        .where(F.col("rank") <= k)
    return imps.select("user_id", "rank", "timestamp", "campaign_id", "advertiser_id",
                       F.when(F.col("_hit") == 1, F.lit("Yes")).otherwise(F.lit("No")).alias("clicked"))


def wide_report(w: dict, as_of: str) -> dict[str, DataFrame]:
    """B2: the wide-column store's report, its five questions titled."""
    return {
        "CTR per campaign and day": campaign_day_ctr(w["campaign_day"]),
        "Top 5 advertisers by spend in 31 days": top_advertisers_31d(w["advertiser_day"], as_of),
        "Last 10 ads seen by each user": last_ads_seen(w["engagement_history"]),
        "Top 10 users by clicks in 31 days": top_users_31d(w["user_day"], as_of),
        "Top 5 advertisers by spend in each region in 31 days": top_region_advertisers(w["region_day_spend"], as_of),
    }


def asof_totals(daily: DataFrame, keys: list[str], measure: str, days: int = 31) -> DataFrame:
    """``as_of, keys.., total`` for every day as the as-of day: ``measure`` over the ``days`` days
    that end with it, of the keys that have a row there (I12 for all days at once).

    Each daily row adds its value on its day and takes it away ``days`` later; running sums
    over these changes give a key's total from each change to the next.  So a day is read
    once, not ``days`` times, and a key's window holds two rows a day of its own at most.
    ``daily`` has a ``day`` and one row per key and day or more."""
    end = F.lit(daily.agg(F.max("day")).first()[0]).cast("date")  # one row
    rows = daily.where(F.col("day").isNotNull()).select(*keys, "day", F.col(measure).alias("_v"))
    change = lambda day, sign: rows.select(*keys, day.alias("day"), (F.col("_v") * sign).alias("_v"), F.lit(sign).alias("_n"))
    changes = (change(F.col("day"), 1).unionAll(change(F.date_add("day", days), -1))
               .groupBy(*keys, "day").agg(F.sum("_v").alias("_v"), F.sum("_n").alias("_n")))
    w = Window.partitionBy(*keys).orderBy("day")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    spans = changes.select(*keys, "day", F.sum("_v").over(so_far).alias("total"), F.sum("_n").over(so_far).alias("_n"),
                           F.date_sub(F.lead("day").over(w), 1).alias("_until"))
    spans = spans.where((F.col("_n") > 0) & (F.col("day") <= end))  # the last change leaves nothing
    return spans.select(F.explode(F.sequence("day", F.least("_until", end))).alias("as_of"), *keys, "total")


def top_asof(totals: DataFrame, id_col: str, k: int, within: list[str] | None = None) -> DataFrame:
    """I8, I10, I11 for every as-of day: the ``k`` largest totals of each day (and of each
    ``within``), ties to the smaller id.  Tasks cut their part to ``k`` before the shuffle."""
    groups = ["as_of", *(within or [])]
    w = Window.partitionBy(*groups).orderBy(F.desc("total"), id_col)
    return (totals.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select(*groups, "rank", id_col, "total"))


def spend_asof(daily: DataFrame, keys: list[str]) -> DataFrame:
    """Spend totals of every as-of day, rounded to cents as the single-day reports do."""
    return asof_totals(daily, keys, "total_spend").withColumn("total", F.round("total", 2).cast("double"))
