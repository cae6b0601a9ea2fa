"""Cleaning and normalisation of the three raw inputs.

Input: text columns as a CSV scan gives them (``sources.csv.read_raw`` or the test
bridge).  Output: typed, snake_case frames.  Names are trimmed here once (T20) so that
dimension building and lookups agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspark.functions.parsing import (
    age_bound, blank_to_null, lenient_decimal, lenient_int, lenient_timestamp, na_to_null,
    targeting_part, to_bool,
)
from adspark.operators.keys import keep_one

FILE_ORDER = "_file_order"  # a row's place in the files: path, first byte of the split, row of the scan

# wide enough that cleaning drops no amount; a relational table's narrower columns are a matter of its own checks
MONEY = (18, 4)    # bid / cost / revenue
BUDGET = (18, 2)   # budget / remaining budget


def null_tokens(df: DataFrame) -> DataFrame:
    """T5: NA text tokens -> NULL on every text column (what the reference's CSV reader does)."""
    return df.select(*[na_to_null(c).alias(c) if kind == "string" else F.col(f"`{c}`") for c, kind in df.dtypes])


def exact_dedup(df: DataFrame) -> DataFrame:
    """Drop rows equal in every column (hash aggregate, partial per partition)."""
    return df.distinct()


def key_dedup_first(df: DataFrame, key: str = "EventID", order: list | None = None) -> DataFrame:
    """One row per ``key``, the first by ``order``.  A scan that carries ``FILE_ORDER``
    decides by that by default: the row that stands first in the files stays, as in the
    reference, and the column goes.  Otherwise the default is Timestamp, then every other
    column: a total order, so the choice does not depend on how the rows arrive (T1)."""
    if order is None and FILE_ORDER in df.columns:
        return keep_one(df, [key], [FILE_ORDER]).drop(FILE_ORDER)
    order = order or ["Timestamp"]
    order = order + [c for c in df.columns if c != key and c not in order]
    return keep_one(df, [key], order)


def normalize_events(raw: DataFrame, dedup: bool = True, extra: dict | None = None) -> DataFrame:
    """Clean ``ad_events``: drop copies (C1 + C2 in one aggregate), type every column
    leniently (C3-C5), trim names (T20).  ``extra`` adds named columns computed from the
    de-duplicated raw text in the same pass."""
    df = null_tokens(raw)
    if dedup:
        # keep-first per EventID also removes every exact copy, so C1 needs no pass of its own
        df = key_dedup_first(df)
    return df.select(
        F.col("EventID").alias("event_id"),
        F.trim("AdvertiserName").alias("advertiser_name"),
        F.col("CampaignName").alias("campaign_name"),
        F.to_date(lenient_timestamp("CampaignStartDate")).alias("campaign_start_date"),
        F.to_date(lenient_timestamp("CampaignEndDate")).alias("campaign_end_date"),
        F.trim("CampaignTargetingInterest").alias("targeting_interest"),
        F.trim("CampaignTargetingCountry").alias("targeting_country"),
        lenient_int("UserID").alias("user_id"),
        F.trim("Device").alias("device"),
        F.trim("Location").alias("location"),
        lenient_timestamp("Timestamp").alias("ts"),
        lenient_timestamp(blank_to_null(F.col("ClickTimestamp"))).alias("click_ts"),
        lenient_decimal("BidAmount", *MONEY).alias("bid_amount"),
        lenient_decimal("AdCost", *MONEY).alias("ad_cost"),
        lenient_decimal("AdRevenue", *MONEY).alias("ad_revenue"),
        lenient_decimal("Budget", *BUDGET).alias("budget"),
        lenient_decimal("RemainingBudget", *BUDGET).alias("remaining_budget"),
        to_bool("WasClicked").alias("was_clicked"),
        *[c.alias(n) for n, c in (extra or {}).items()],
    )


def normalize_campaigns(raw: DataFrame) -> DataFrame:
    """Clean ``campaigns``: dates, budgets, targeting split into ages / interest /
    country (C9, C10)."""
    df = null_tokens(raw)
    p0 = targeting_part("TargetingCriteria", 0)
    return df.select(
        lenient_int("CampaignID").alias("campaign_id"),
        F.trim("AdvertiserName").alias("advertiser_name"),
        F.col("CampaignName").alias("campaign_name"),
        F.to_date(lenient_timestamp("CampaignStartDate")).alias("campaign_start_date"),
        F.to_date(lenient_timestamp("CampaignEndDate")).alias("campaign_end_date"),
        F.col("TargetingCriteria").alias("targeting_criteria"),
        F.col("AdSlotSize").alias("ad_slot_size"),
        lenient_decimal("Budget", *BUDGET).alias("budget"),
        lenient_decimal("RemainingBudget", *BUDGET).alias("remaining_budget"),
        age_bound(p0, 1).alias("age_from"),
        age_bound(p0, 2).alias("age_to"),
        targeting_part("TargetingCriteria", 1).alias("interest"),
        targeting_part("TargetingCriteria", 2).alias("country"),
    )


def normalize_users(raw: DataFrame) -> DataFrame:
    df = null_tokens(raw)
    return df.select(
        lenient_int("UserID").alias("user_id"),
        lenient_int("Age").alias("age"),
        F.col("Gender").alias("gender"),
        F.trim("Location").alias("location"),
        F.col("Interests").alias("interests"),
        F.to_date(lenient_timestamp("SignupDate")).alias("signup_date"),
    )
