"""Nested documents (H1-H3): ad sessions and user documents.

A session is every impression of one (user, device) pair (T22).  A session's
impression array is unbounded, so a session document is stored as bucket documents of
about ``bucket_size`` impressions each (the bucket pattern): the bucket of an
impression is a hash of its id modulo the session's bucket count.  No group larger than
a bucket is ever collected into one row.  Session start / end are exact over the whole
session.  ``build_session_days`` makes documents by day instead, in time order, without
the join that ``build_sessions`` needs for its buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType, TimestampNTZType

from adspark.functions.parsing import list_keep_blanks
from adspark.operators.keys import lookup_side

DEFAULT_BUCKET = 1000
CLICK_EVENT = StructType([StructField("click_timestamp", TimestampNTZType(), True)])


def click_events(click_ts) -> F.Column:
    """H2: [] or [{click_timestamp}]."""
    c = F.col(click_ts) if isinstance(click_ts, str) else click_ts
    return F.when(c.isNotNull(), F.array(F.struct(c.alias("click_timestamp")))) \
        .otherwise(F.array().cast(ArrayType(CLICK_EVENT)))


def impression_struct() -> F.Column:
    """One nested impression, in the document field order (§1.4 of the survey)."""
    return F.struct(
        F.col("event_id").alias("impression_id"),
        F.col("campaign_id").cast("int").alias("campaign_id"),
        F.col("campaign_interest"), F.col("campaign_location"), F.col("campaign_name"),
        F.col("advertiser_id").cast("int").alias("advertiser_id"),
        F.col("ts").alias("timestamp"), F.col("location"),
        F.coalesce(F.col("bid_amount").cast("double"), F.lit(0.0)).alias("bid_amount"),
        F.coalesce(F.col("ad_cost").cast("double"), F.lit(0.0)).alias("ad_cost"),
        F.coalesce(F.col("ad_revenue").cast("double"), F.lit(0.0)).alias("ad_revenue"),
        F.coalesce(F.col("was_clicked"), F.lit(False)).alias("clicked"),
        click_events("click_ts").alias("click_events"),
    )


def build_sessions(events: DataFrame, bucket_size: int = DEFAULT_BUCKET) -> DataFrame:
    """H1: session bucket documents
    ``(user_id, device, bucket, session_start, session_end, n_buckets, impressions[])``.

    ``events`` are resolved events with campaign attributes (campaign_interest,
    campaign_location, campaign_name, advertiser_id).  Impressions inside a bucket are
    sorted by (timestamp, impression_id)."""
    ev = events.where(F.col("user_id").isNotNull() & F.col("campaign_id").isNotNull())
    keys = ["user_id", "device"]
    sessions = ev.groupBy(*keys).agg(
        F.min("ts").alias("session_start"), F.max("ts").alias("session_end"),
        F.count(F.lit(1)).alias("n"))
    sessions = sessions.select(*keys, "session_start", "session_end",
                               F.ceil(F.col("n") / F.lit(bucket_size)).cast("int").alias("n_buckets"))
    tagged = ev.join(lookup_side(sessions), keys)  # one row per session; shuffle join beyond the bound
    tagged = tagged.withColumn("bucket", F.pmod(F.xxhash64("event_id"), F.col("n_buckets")).cast("int"))
    docs = tagged.groupBy(*keys, "bucket").agg(
        F.first("session_start").alias("session_start"), F.first("session_end").alias("session_end"),
        F.first("n_buckets").alias("n_buckets"),
        F.sort_array(F.collect_list(F.struct(F.col("ts").alias("_t"), F.col("event_id").alias("_id"),
                                             impression_struct().alias("imp")))).alias("_imps"))
    return docs.select(F.col("user_id").cast("int").alias("user_id"), "device", "bucket", "n_buckets",
                       "session_start", "session_end",
                       F.transform("_imps", lambda x: x["imp"]).alias("impressions"))


def build_session_days(events: DataFrame, most: int = DEFAULT_BUCKET) -> DataFrame:
    """H1 by day: documents ``(user_id, device, day, first_at, last_at, first_id, n, impressions[])``
    of at most ``most`` impressions of one user on one device on one day, in time order; a long
    day is several documents, each after the other (``first_at``, ``first_id``).

    One rule for every size: impressions are range-partitioned and sorted by user, device, time
    and id, so a session with a third of all rows is cut over many tasks, and every run of
    ``most`` rows of a task's sorted rows becomes an array on its own.  No join, no count of
    sessions beforehand, and no array or group larger than ``most``."""
    ev = events.where(F.col("user_id").isNotNull() & F.col("campaign_id").isNotNull())
    by = ["user_id", "device", "ts", "event_id"]
    rows = ev.select(*by, F.to_date("ts").alias("day"), impression_struct().alias("imp"))
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    # the row's number in its task is in the low bits
    run = placed.withColumn("_run", F.shiftright("_at", 33)) \
        .withColumn("_piece", F.floor(F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) / F.lit(most)))
    docs = run.groupBy("user_id", "device", "day", "_run", "_piece").agg(
        F.min("ts").alias("first_at"), F.max("ts").alias("last_at"), F.count(F.lit(1)).alias("n"),
        F.sort_array(F.collect_list(F.struct(F.col("ts").alias("_t"), F.col("event_id").alias("_id"), "imp"))).alias("_imps"))
    return docs.select(F.col("user_id").cast("int").alias("user_id"), "device", "day", "first_at", "last_at",
                       F.get("_imps", F.lit(0))["_id"].alias("first_id"), "n",
                       F.transform("_imps", lambda x: x["imp"]).alias("impressions"))


def build_user_documents(users: DataFrame) -> DataFrame:
    """H3: user documents with nested demographics, interests as a list (inner blanks
    kept, C12) and a zeroed interaction history.  ``created_at`` / ``updated_at`` are the
    load time (C21)."""
    now = F.current_timestamp()
    return users.select(
        F.col("user_id").cast("int").alias("user_id"),
        F.struct(F.col("age").cast("int").alias("age"), F.col("gender"),
                 list_keep_blanks("interests").alias("interests"), F.col("location")).alias("demographics"),
        F.col("signup_date").cast("timestamp_ntz").alias("signup_date"),
        now.alias("created_at"), now.alias("updated_at"),
        F.struct(F.lit(0).alias("total_impressions"), F.lit(0).alias("total_clicks")).alias("interaction_history"))
