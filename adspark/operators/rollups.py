"""Daily and regional rollup tables (I1-I6), built from resolved events.

Each is one hash aggregate with partial (map-side) aggregation, so a hot campaign,
user or region is reduced before the shuffle.  NULL keys are dropped first and empty
sums are 0, as the reference's pandas group-by does (T10).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspark.functions.parsing import action_label
from adspark.operators.keys import keep_one


def _day() -> F.Column:
    return F.to_date("ts")


def _counts():
    return [F.count("was_clicked").alias("impressions"),
            F.coalesce(F.sum(F.col("was_clicked").cast("int")), F.lit(0)).cast("bigint").alias("clicks")]


def campaign_day(events: DataFrame) -> DataFrame:
    """Impressions (non-NULL flags) and clicks per campaign and day."""
    return events.where(F.col("campaign_id").isNotNull() & F.col("ts").isNotNull()) \
        .groupBy("campaign_id", _day().alias("date")).agg(*_counts())


def user_day(events: DataFrame) -> DataFrame:
    """Impressions and clicks per user and day."""
    return events.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull()) \
        .groupBy(_day().alias("day"), "user_id").agg(*_counts())


def _spend():
    return F.coalesce(F.sum(F.col("ad_cost").cast("decimal(18,4)")), F.lit(0).cast("decimal(18,4)")) \
        .alias("total_spend")


def advertiser_day(events: DataFrame) -> DataFrame:
    """Spend per advertiser and day."""
    return events.where(F.col("advertiser_id").isNotNull() & F.col("ts").isNotNull()) \
        .groupBy(_day().alias("day"), "advertiser_id", "advertiser_name").agg(_spend())


def region_spend(events: DataFrame) -> DataFrame:
    """I4: all-time spend per region (user location) and advertiser."""
    return events.where(F.col("advertiser_id").isNotNull() & F.col("location").isNotNull()) \
        .groupBy(F.col("location").alias("region"), "advertiser_id", "advertiser_name").agg(_spend())


def region_day_spend(events: DataFrame) -> DataFrame:
    """Spend per region, day and advertiser."""
    return events.where(F.col("advertiser_id").isNotNull() & F.col("location").isNotNull()
                        & F.col("ts").isNotNull()) \
        .groupBy(F.col("location").alias("region"), _day().alias("day"), "advertiser_id", "advertiser_name") \
        .agg(_spend())


def engagement_history(events: DataFrame) -> DataFrame:
    """The per-user event log keyed by (user_id, timestamp).

    Rows sharing a key overwrite each other in the reference's store (T11); the one
    with the greatest event id is kept.  A NULL click flag is an impression (T2)."""
    log = events.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull()
                       & F.col("campaign_id").isNotNull() & F.col("advertiser_id").isNotNull()) \
        .select("user_id", F.col("ts").alias("timestamp"), "event_id", "advertiser_id", "campaign_id",
                action_label(F.coalesce(F.col("was_clicked"), F.lit(False))).alias("action"))
    return keep_one(log, ["user_id", "timestamp"], ["event_id"], last=True).drop("event_id")


# The five rollups as grouping sets over one projection of the events: name -> keys.
ROLLUP_SETS = {
    "campaign_day": ["campaign_id", "day"],
    "user_day": ["day", "user_id"],
    "advertiser_day": ["day", "advertiser_id", "advertiser_name"],
    "region_spend": ["region", "advertiser_id", "advertiser_name"],
    "region_day_spend": ["region", "day", "advertiser_id", "advertiser_name"],
}
_ROLLUP_COLS = ["campaign_id", "day", "user_id", "advertiser_id", "advertiser_name", "region"]


def all_rollups(events: DataFrame) -> DataFrame:
    """I1-I5 in one pass: a grouping-sets aggregate (one scan, one shuffle with partial
    aggregation) tagged with the rollup name.  Groups with a NULL key of their own set are
    dropped, which is what each rollup's NULL-key filter does (T10).  ``split_rollups``
    turns the result back into the five tables."""
    ev = events.select("campaign_id", "user_id", "advertiser_id", "advertiser_name",
                       F.col("location").alias("region"), _day().alias("day"), "was_clicked", "ad_cost")
    n = len(_ROLLUP_COLS)
    masks = {name: sum(1 << (n - 1 - i) for i, c in enumerate(_ROLLUP_COLS) if c not in keys)
             for name, keys in ROLLUP_SETS.items()}
    agg = ev.groupingSets([[F.col(c) for c in keys] for keys in ROLLUP_SETS.values()],
                          *[F.col(c) for c in _ROLLUP_COLS]) \
        .agg(*_counts(), _spend(), F.grouping_id().alias("_gid"))
    name = None
    for r, m in masks.items():
        name = (F.when(F.col("_gid") == m, F.lit(r)) if name is None else name.when(F.col("_gid") == m, F.lit(r)))
    out = agg.withColumn("rollup", name)
    keep = None
    for r, keys in ROLLUP_SETS.items():
        cond = (F.col("rollup") == r)
        for k in keys:
            cond = cond & F.col(k).isNotNull()
        keep = cond if keep is None else keep | cond
    return out.where(keep).drop("_gid")


def split_rollups(rollups: DataFrame) -> dict[str, DataFrame]:
    """The five rollup tables out of ``all_rollups`` (each a partition-pruned filter)."""
    out = {}
    for r, keys in ROLLUP_SETS.items():
        measures = ["impressions", "clicks"] if r in ("campaign_day", "user_day") else ["total_spend"]
        cols = [F.col(k).alias("date") if (r == "campaign_day" and k == "day") else F.col(k) for k in keys]
        out[r] = rollups.where(F.col("rollup") == r).select(*cols, *measures)
    return out
