"""K1 + K2: campaign x day impression / click counters kept up to date by a stream.

Events arrive as files; each is mapped to its campaign (a stream-static join with the
campaign lookup), de-duplicated by event id within the watermark (K2), and counted in
one-day event-time windows (K1) in update mode.  Each micro-batch's updated windows are
appended, with the batch id, to a Parquet log in the shared folder (``foreachBatch``);
the current counters are the last version per window.  The checkpoint location makes
a restarted query resume exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adspark.operators.keys import keep_one, lookup_side
from adspark.session import materialize
from adspark.sources import keyed, versions

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def as_instant(ntz_col: str) -> F.Column:
    """Wall-clock TIMESTAMP_NTZ (UTC by convention) -> TIMESTAMP, independent of the
    session time zone (a watermark needs TIMESTAMP)."""
    micros = F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), F.col(ntz_col))
    return F.timestamp_micros(micros)


def utc_day(instant: F.Column) -> F.Column:
    return F.date_add(F.lit("1970-01-01").cast("date"),
                      F.floor(F.unix_micros(instant) / F.lit(86_400_000_000)).cast("int"))


def campaign_day_stream(events: DataFrame, campaign_of: DataFrame, watermark: str = "1 day") -> DataFrame:
    """The streaming plan: events(event_id, ts ntz, campaign_name, clicked) -> windowed
    counters; ``campaign_of`` maps campaign_name -> campaign_id (``model.campaign_lookup``)."""
    ev = events.withColumn("event_time", as_instant("ts")).withWatermark("event_time", watermark)
    ev = ev.dropDuplicatesWithinWatermark(["event_id"])
    ev = ev.join(lookup_side(campaign_of), "campaign_name")  # static lookup, one row per name
    agg = ev.groupBy(F.window("event_time", "1 day").alias("w"), "campaign_id").agg(
        F.count("clicked").alias("impressions"),
        F.coalesce(F.sum(F.col("clicked").cast("int")), F.lit(0)).cast("bigint").alias("clicks"))
    return agg.select("campaign_id", utc_day(F.col("w.start")).alias("date"), "impressions", "clicks")


def run_campaign_day(spark: SparkSession, source: DataFrame, campaign_of: DataFrame, out_dir: str,
                     checkpoint_dir: str, available_now: bool = True):
    """Start the stream; each batch appends its updated windows to ``out_dir``.

    A batch re-run after a failure appends the same rows with the same batch id again;
    ``current_counters`` keeps one row per window from the highest batch id, so the
    copies do not change the result."""
    plan = campaign_day_stream(source, campaign_of)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out_dir)

    w = plan.writeStream.outputMode("update").option("checkpointLocation", checkpoint_dir).foreachBatch(sink)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def current_counters(spark: SparkSession, out_dir: str) -> DataFrame:
    """Latest row per (campaign, day) across the appended batches."""
    log = spark.read.parquet(out_dir)
    return keep_one(log, ["campaign_id", "date"], ["batch_id"], last=True).drop("batch_id")


def events_file_stream(spark: SparkSession, sf_dir: str, files_per_batch: int = 1) -> DataFrame:
    """Files ``events*.parquet`` of a folder (the driver's ``events`` table, or new
    event files landing next to it) read as a file stream, in the shape the counters
    need (the bridge's campaign naming: ``Campaign_<k+1>``)."""
    # a file source watches a directory; the glob keeps it to the events file(s)
    glob = f"{sf_dir.rstrip('/')}/events*.parquet"
    schema = spark.read.parquet(glob).schema
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(glob)
    return src.select(F.col("event_id").cast("string").alias("event_id"), F.col("ts"),
                      F.concat(F.lit("Campaign_"),
                               (F.get_json_object("props", "$.k").cast("bigint") + 1).cast("string"))
                      .alias("campaign_name"),
                      (F.col("event_type") == "click").alias("clicked"))


# ---- counters that lose no row -----------------------------------------------------
def run_counted(spark: SparkSession, source: DataFrame, campaign_of: DataFrame, root: str, delay: str = "1 day"):
    """K1 + K2 without losses: start the stream over what has arrived (``availableNow``).

    Every micro-batch is split by the watermark that the batches before it set (their latest
    event time less ``delay``): rows behind it, and rows without a time, go to a late log,
    the others are counted once for each event id.  Ids are remembered as long as the
    watermark lets their events in, by day, so old ones go.  The counts are added to stored
    counters under the batch's number (``sources.keyed.add_counts``), the late rows and ids
    go to folders of their own, and one manifest commits the batch's watermark and folders.
    A batch that dies anywhere and runs again is split by the same state and counted once.
    ``read_counters`` and ``read_late`` read the results."""
    seconds = int(spark.sql(f"SELECT unix_seconds(timestamp_seconds(0) + INTERVAL {delay})").first()[0])
    lookup = materialize(campaign_of)
    name = f"{root.rstrip('/')}/checkpoint"

    def one(batch: DataFrame, batch_id: int) -> None:
        state_root = versions.join(root, "state")
        number, state = versions.newest(spark, state_root)
        if batch_id <= state.get("batch", -1):
            return
        rows = materialize(batch.select("event_id", "ts", "campaign_name", "clicked"))
        mark = state.get("watermark")
        late = F.col("ts").isNull() if mark is None else F.col("ts").isNull() | (seconds_of("ts") < F.lit(mark))
        folder = versions.fresh_folder("late")
        rows.where(late).withColumn("batch", F.lit(batch_id)).write.parquet(versions.join(state_root, folder))
        fresh = keep_one(rows.where(~late), ["event_id"], ["ts", "campaign_name", "clicked"])
        known = [p for p, newest_day in state.get("seen", []) if mark is None or newest_day >= mark // 86_400]
        if known:
            ids = spark.read.schema("event_id string, day int").parquet(*[versions.join(state_root, p) for p in known])
            fresh = fresh.join(ids.where(F.col("day") >= F.lit((mark or 0) // 86_400)).select("event_id"), "event_id", "left_anti")
        fresh = materialize(fresh)
        counts = (fresh.join(lookup_side(lookup), "campaign_name")
                  .groupBy("campaign_id", F.to_date("ts").alias("date"))
                  .agg(F.count("clicked").alias("impressions"),
                       F.coalesce(F.sum(F.col("clicked").cast("int")), F.lit(0)).cast("bigint").alias("clicks")))
        keyed.add_counts(spark, versions.join(root, "counters"), f"batch-{batch_id}", counts, ["campaign_id", "date"],
                         ["impressions", "clicks"], "date")
        seen = versions.fresh_folder("seen")
        day = F.floor(seconds_of("ts") / 86_400).cast("int")
        fresh.select("event_id", day.alias("day")).write.parquet(versions.join(state_root, seen))
        high, newest_day = fresh.agg(F.max(seconds_of("ts")), F.max(day)).first()  # one row
        marks = [m for m in (mark, None if high is None else high - seconds) if m is not None]
        versions.commit(spark, state_root, {
            "batch": batch_id, "watermark": max(marks) if marks else None, "late": state.get("late", []) + [folder],
            "seen": [[p, d] for p, d in state.get("seen", []) if p in known] + ([] if newest_day is None else [[seen, newest_day]])},
            number)

    return (source.writeStream.option("checkpointLocation", name).foreachBatch(one).trigger(availableNow=True).start())


def seconds_of(ntz_col: str) -> F.Column:
    """Whole seconds of a wall-clock time, rounded down."""
    return F.floor(F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), F.col(ntz_col)) / F.lit(1_000_000))


def read_counters(spark: SparkSession, root: str) -> DataFrame:
    """``campaign_id, date, impressions, clicks`` of the rows that came in time."""
    return keyed.read(spark, versions.join(root, "counters"))


def read_late(spark: SparkSession, root: str) -> DataFrame:
    """``event_id, ts, campaign_name, clicked, batch``: the rows that came behind the
    watermark, as they came."""
    _, state = versions.newest(spark, versions.join(root, "state"))
    schema = "event_id string, ts timestamp_ntz, campaign_name string, clicked boolean, batch int"
    paths = [versions.join(root, "state", p) for p in state.get("late", [])]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
