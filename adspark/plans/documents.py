"""Questions over the session documents.

``$unwind`` is ``explode`` (empty arrays vanish, as they do there), ``$filter`` +
``$size`` is ``size(filter(...))``, ``$group`` accumulators are aggregates.  Filters on
top-level fields (user, session time span) come before the explode so Parquet can skip
row groups; element predicates follow it.  Session documents are stored in buckets
(``operators.documents``), so per-session figures are sums over a session's buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adspark.functions.parsing import UNKNOWN_CATEGORY

IMPRESSION_FIELDS = ["impression_id", "campaign_id", "campaign_interest", "campaign_location", "campaign_name",
                     "advertiser_id", "timestamp", "location", "bid_amount", "ad_cost", "ad_revenue", "clicked",
                     "click_events"]


def _unwind(docs: DataFrame, keep: list[str], fields: list[str]) -> DataFrame:
    """One row an impression with ``keep`` of its document and some of its own fields.  The
    fields' arrays are zipped, not the array of whole impressions unwound, since that is what
    reaches the scan: only these fields are read from the files."""
    zipped = F.arrays_zip(*[F.col(f"impressions.{f}") for f in fields])
    return docs.select(*keep, F.explode(zipped).alias("_i")).select(*keep, *[F.col(f"_i.{f}").alias(f) for f in fields])


def sample_user(sessions: DataFrame, seed: int = 0) -> DataFrame:
    """H9: one session drawn by a seeded hash order (so users weigh by session count),
    returned as its ``user_id`` (a one-row frame, used as a semi-join key)."""
    h = F.md5(F.concat_ws(":", F.col("user_id").cast("string"), F.col("device"), F.lit(str(seed))))
    return sessions.select("user_id", "device").distinct() \
        .orderBy(h, "user_id", "device").limit(1).select("user_id")


def _for_user(sessions: DataFrame, user_id: int | None, seed: int) -> DataFrame:
    if user_id is not None:
        return sessions.where(F.col("user_id") == F.lit(user_id))
    return sessions.join(F.broadcast(sample_user(sessions, seed)), "user_id", "left_semi")  # one row


def user_interactions(sessions: DataFrame, user_id: int | None = None, seed: int = 0) -> DataFrame:
    """H4: every impression of one user (given, or drawn as H9 does)."""
    s = _for_user(sessions, user_id, seed)
    imp = s.select("user_id", F.explode("impressions").alias("imp"))
    return imp.select("user_id", *[F.col("imp." + f).alias(f) for f in IMPRESSION_FIELDS])


def session_summary(sessions: DataFrame) -> DataFrame:
    """Per-session scalars over the bucket documents (H1 check and H5 input)."""
    b = sessions.select(
        "user_id", "device", "session_start", "session_end",
        F.size("impressions").alias("n"),
        F.size(F.filter("impressions", lambda x: x["clicked"])).alias("k"),
        F.size(F.flatten(F.transform("impressions", lambda x: x["click_events"]))).alias("ce"),
        F.aggregate("impressions", F.lit(0).cast("decimal(18,4)"),
                    lambda acc, x: (acc + x["ad_cost"].cast("decimal(18,4)")).cast("decimal(18,4)")).alias("cost"))
    return b.groupBy("user_id", "device").agg(
        F.first("session_start").alias("session_start"), F.first("session_end").alias("session_end"),
        F.sum("n").cast("bigint").alias("impressions"), F.sum("k").cast("bigint").alias("clicks"),
        F.sum("ce").cast("bigint").alias("click_events"),
        F.sum("cost").cast("double").alias("ad_cost"))


def last_sessions(sessions: DataFrame, user_id: int | None = None, k: int = 5,
                  sample_seed: int | None = None) -> DataFrame:
    """H5: each user's last ``k`` sessions by end time, with clicks; or one user's
    (given, or drawn as H9 does with ``sample_seed``)."""
    if user_id is not None or sample_seed is not None:
        sessions = _for_user(sessions, user_id, sample_seed or 0)
    s = session_summary(sessions)
    w = Window.partitionBy("user_id").orderBy(F.desc("session_end"), "device")
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k) \
        .select("user_id", "device", "rank", "session_start", "session_end", "clicks")


def clicks_per_hour(sessions: DataFrame, day: str, advertiser_id: int | None = None) -> DataFrame:
    """H6: clicked impressions per campaign and UTC hour on ``day`` (half-open day),
    for one advertiser or, with ``advertiser_id=None``, for each advertiser."""
    lo = F.lit(day).cast("timestamp_ntz")
    hi = F.date_add(F.lit(day).cast("date"), 1).cast("timestamp_ntz")
    s = sessions.where((F.col("session_start") < hi) & (F.col("session_end") >= lo))  # row-group skipping
    x = _unwind(s, [], ["advertiser_id", "campaign_id", "timestamp", "clicked"])
    x = x.where(F.col("clicked") & (F.col("timestamp") >= lo) & (F.col("timestamp") < hi))
    if advertiser_id is not None:
        x = x.where(F.col("advertiser_id") == F.lit(advertiser_id))
    return x.groupBy("advertiser_id", "campaign_id", F.hour("timestamp").alias("hour")) \
        .agg(F.count(F.lit(1)).alias("clicks"))


def repeated_no_click(sessions: DataFrame, threshold: int = 5, ad_key: str = "campaign_id") -> DataFrame:
    """H7: (user, ad) pairs seen at least ``threshold`` times and never clicked.

    One row per pair (the reference lists the ads per user; a list per user would
    gather an unbounded group into one row).  ``ad_key='impression_id'`` is the
    reference's literal grouping, which never matches after de-duplication (T9)."""
    x = _unwind(sessions, ["user_id"], [ad_key, "clicked"])
    per = x.groupBy("user_id", ad_key).agg(F.count(F.lit(1)).alias("impressions"), F.max("clicked").alias("_clicked"))
    return per.where((F.col("impressions") >= threshold) & ~F.col("_clicked")).drop("_clicked")


def top_categories(sessions: DataFrame, user_id: int | None = None, k: int = 3,
                   fanout_compat: bool = False) -> DataFrame:
    """H8: each user's (or one user's) top ``k`` campaign interests by clicks; a missing
    interest shows as 'Unknown' (H15).  ``fanout_compat`` multiplies counts by the
    user's session count, as the reference's self-lookup does (T8)."""
    s = sessions if user_id is None else sessions.where(F.col("user_id") == F.lit(user_id))
    x = _unwind(s, ["user_id"], ["campaign_interest", "clicked"]).where("clicked")
    per = x.groupBy("user_id", F.coalesce("campaign_interest", F.lit(UNKNOWN_CATEGORY)).alias("category")) \
        .agg(F.count(F.lit(1)).alias("clicks"))
    if fanout_compat:
        n = s.select("user_id", "device").distinct().groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
        per = per.join(n, "user_id").withColumn("clicks", F.col("clicks") * F.col("_n")).drop("_n")
    w = Window.partitionBy("user_id").orderBy(F.desc("clicks"), "category")
    return per.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def document_report(sessions: DataFrame, day: str, seed: int = 0) -> dict[str, DataFrame]:
    """B2: the document store's report, its five questions titled."""
    return {
        "All ad interactions for a sampled user": user_interactions(sessions, seed=seed),
        "Last 5 ad sessions of each user": last_sessions(sessions),
        "Ad clicks per hour and campaign on one day": clicks_per_hour(sessions, day),
        "Users who saw the same ad 5+ times without a click": repeated_no_click(sessions),
        "Top 3 ad categories of each user": top_categories(sessions),
    }


def day_sequence(docs: DataFrame) -> DataFrame:
    """``user_id, device, day, seq, impression_id`` from day documents: each impression's number
    in its user's day on a device.  Only the documents' sizes are numbered across; the
    impressions follow from their places inside them."""
    light = docs.select("user_id", "device", "day", "first_at", "first_id", "n")
    w = Window.partitionBy("user_id", "device", "day").orderBy("first_at", "first_id")
    before = light.withColumn("_before", F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    keyed = before.select(F.col("first_id").alias("_id"), "_before")  # an impression begins one document at most
    return (docs.join(keyed, F.col("first_id") == F.col("_id"))
            .select("user_id", "device", "day", "_before", F.posexplode("impressions").alias("_pos", "_imp"))
            .select("user_id", "device", "day", (F.col("_before") + F.col("_pos") + 1).alias("seq"),
                    F.col("_imp.impression_id").alias("impression_id")))


def clicks_per_hour_of_days(docs: DataFrame, day: str) -> DataFrame:
    """H6 over day documents: documents of other days are not read."""
    x = _unwind(docs.where(F.col("day") == F.lit(day).cast("date")), [],
                ["advertiser_id", "campaign_id", "timestamp", "clicked"]).where("clicked")
    return x.groupBy("advertiser_id", "campaign_id", F.hour("timestamp").alias("hour")).agg(F.count(F.lit(1)).alias("clicks"))
