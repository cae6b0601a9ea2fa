"""Raw CSV scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from adspark.operators.keys import dense_ids
from adspark.operators.clean import FILE_ORDER, null_tokens

# Raw column sets the reference reads (every column text; typing is the cleaning stage's job).
RAW_EVENT_COLUMNS = ["EventID", "AdvertiserName", "CampaignName", "CampaignStartDate", "CampaignEndDate",
                     "CampaignTargetingInterest", "CampaignTargetingCountry", "UserID", "Device", "Location",
                     "Timestamp", "ClickTimestamp", "BidAmount", "AdCost", "AdRevenue", "Budget",
                     "RemainingBudget", "WasClicked"]
RAW_CAMPAIGN_COLUMNS = ["CampaignID", "AdvertiserName", "CampaignName", "CampaignStartDate", "CampaignEndDate",
                        "TargetingCriteria", "AdSlotSize", "Budget", "RemainingBudget"]
RAW_USER_COLUMNS = ["UserID", "Age", "Gender", "Location", "Interests", "SignupDate"]


PERCENTILE_ACCURACY = 10_000
MARGIN = 0.01  # share of rows kept beyond the n-th at first


def text_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_raw(spark: SparkSession, path: str, columns: list[str] | None = None, file_order: bool = False) -> DataFrame:
    """A1: header CSV, every column as text (no inference pass over the data), NA
    tokens -> NULL.  With ``columns`` the file's header must hold them; they are bound
    by name, so column order in the file does not matter (A6).  ``file_order`` adds each
    row's place in the files (``FILE_ORDER``): files by path, rows as they stand in them;
    a task reads the rows of a split in order, so its own row numbers rise along it."""
    df = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
          .option("sep", ",").option("mode", "PERMISSIVE").csv(path))  # all string without inferSchema
    if columns is not None:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"{path}: missing columns {missing}")
    place = [F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("row")).alias(FILE_ORDER)] if file_order else []
    return null_tokens(df.select(*(columns or df.columns), *place))


def first_n(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """A2: the first ``n`` rows in ``order_by`` order (a total order).

    An approximate percentile of the first order column, a little beyond the n-th row's, cuts
    the table first (a wider one, should it leave too few); what it leaves is numbered
    distributedly, so neither the whole table is sorted nor a single task holds a top-n of
    millions of rows (the reference caps at 3,000,000 events).  A first column that has no
    percentiles (text) is numbered whole."""
    lead = F.col(order_by[0])
    if isinstance(df.schema[order_by[0]].dataType, (NumericType, DateType, TimestampType, TimestampNTZType)):
        total, nulls = df.agg(F.count(F.lit(1)), F.count_if(lead.isNull())).first()
        if total > n:
            margin = MARGIN
            while (share := (n - nulls) / max(1, total - nulls) * (1 + margin) + margin) < 1:
                bound = df.select(F.percentile_approx(lead, F.lit(max(0.0, share)), F.lit(PERCENTILE_ACCURACY)).alias("b"))
                part = df.where(lead.isNull() | (lead <= bound.first()["b"]))  # nulls come first
                if part.count() >= n:
                    df = part
                    break
                margin *= 4
    numbered = dense_ids(df, order_by, "_rank")
    return numbered.where(F.col("_rank") <= n).drop("_rank")


def read_inputs(spark: SparkSession, events_path: str, campaigns_path: str, users_path: str):
    """The three raw CSV inputs of the reference (ad events, campaigns, users) as text
    frames, columns bound by header name; of events with the same id the first of the file counts."""
    from adspark.sources.bridge import RawInputs
    return RawInputs(read_raw(spark, events_path, RAW_EVENT_COLUMNS, file_order=True),
                     read_raw(spark, campaigns_path, RAW_CAMPAIGN_COLUMNS),
                     read_raw(spark, users_path, RAW_USER_COLUMNS))
