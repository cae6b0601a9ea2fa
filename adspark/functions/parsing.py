"""Lenient scalar parsing used by the cleaning stage.

Every parse is a ``try_*`` form: a value that does not parse becomes NULL, as the
reference's ``errors='coerce'`` does, and ANSI mode never raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

__all__ = [
    "NA_TOKENS", "GENDERS", "DEVICES", "AGE_RANGE_PATTERN", "UNKNOWN_CATEGORY",
    "na_to_null", "lenient_timestamp", "lenient_decimal", "lenient_int",
    "to_bool", "blank_to_null", "force_bool", "targeting_part", "age_bound",
    "clean_list", "list_keep_blanks", "coerce_enum", "zero_default", "iso_or_epoch",
    "action_label",
]

# ---- fixed values (must equal the reference's behaviour) --------------------------
# Text that pandas.read_csv reads as a missing value by default.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null"]
# Text that it reads as booleans.
TRUE_TOKENS = ["True", "TRUE", "true"]
FALSE_TOKENS = ["False", "FALSE", "false"]
# Allowed user genders (users table enum); anything else becomes "Other".
GENDERS = ["Male", "Female", "Non-Binary", "Other", "Prefer not to say"]
# Allowed impression devices (ad_impressions enum).
DEVICES = ["Mobile", "Desktop", "Tablet", "Other"]
# Age range inside the first targeting part, e.g. "Age 25-34".
AGE_RANGE_PATTERN = r"Age\s+(\d+)-(\d+)"
# Label shown for a click whose campaign has no interest.
UNKNOWN_CATEGORY = "Unknown"
# -----------------------------------------------------------------------------------

# a time of day followed by Z or a numeric offset
OFFSET_PATTERN = r"\d:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|[+-]\d{1,2}(:?\d{2})?)$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


_NA_SQL_SET = ", ".join(_sql_str(t) for t in NA_TOKENS)


def na_to_null(c) -> Column:
    """T5: the NA text tokens become NULL (applied once, at scan time).

    For a column name the rule is one SQL expression (one call to the JVM instead of a
    literal per token)."""
    if isinstance(c, str):
        q = "`" + c.replace("`", "``") + "`"
        return F.expr(f"CASE WHEN {q} IN ({_NA_SQL_SET}) THEN CAST(NULL AS STRING) ELSE {q} END")
    return F.when(c.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def lenient_timestamp(c) -> Column:
    """Text to TIMESTAMP_NTZ (wall clock, UTC by convention); bad text -> NULL.  Text
    with an offset is moved to UTC by it."""
    c = _c(c)
    # by the instant itself: a wall clock of the session's zone repeats an hour when summer time ends
    moved = F.timestamp_add("MICROSECOND", F.unix_micros(c.try_cast("timestamp")), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return F.when(c.rlike(OFFSET_PATTERN), moved).otherwise(c.try_cast("timestamp_ntz"))


def lenient_decimal(c, precision: int = 12, scale: int = 4) -> Column:
    """C4: text to DECIMAL(p,s); unparseable or too wide -> NULL."""
    return _c(c).try_cast(DecimalType(precision, scale))


def lenient_int(c) -> Column:
    """Text to INT; a number with a zero fraction (``123.0``) counts, any other bad text -> NULL."""
    c = _c(c)
    wide = c.try_cast(DecimalType(20, 6))
    return F.coalesce(c.try_cast("int"), F.when(wide == F.floor(wide), wide.try_cast("int")))


def to_bool(c) -> Column:
    """The reader's spellings of true and false to boolean, anything else NULL."""
    c = _c(c)
    return F.when(c.isin(TRUE_TOKENS), F.lit(True)).when(c.isin(FALSE_TOKENS), F.lit(False))


def blank_to_null(c) -> Column:
    """C6."""
    return F.nullif(_c(c), F.lit(""))


def force_bool(c) -> Column:
    """A missing flag counts as True (the relational path's astype(bool))."""
    return F.coalesce(_c(c), F.lit(True))


def targeting_part(c, i: int) -> Column:
    """I-th comma part of the targeting text, trimmed; NULL when absent."""
    return F.trim(F.get(F.split(_c(c), ","), F.lit(i)))


def age_bound(part0, group: int) -> Column:
    """Lower (group 1) or upper (group 2) targeting age, NULL when no match."""
    return F.nullif(F.regexp_extract(_c(part0), AGE_RANGE_PATTERN, group), F.lit("")).try_cast("int")


def clean_list(c) -> Column:
    """C11: comma list -> array of trimmed, non-blank items (NULL input -> NULL)."""
    items = F.transform(F.split(_c(c), ","), lambda x: F.trim(x))
    return F.filter(items, lambda x: x != F.lit(""))


def list_keep_blanks(c) -> Column:
    """Comma list -> trimmed items, inner blanks kept; blank / NULL -> []."""
    c = _c(c)
    return F.when(c.isNull() | (F.trim(c) == ""), F.array().cast("array<string>")) \
        .otherwise(F.transform(F.split(c, ","), lambda x: F.trim(x)))


def coerce_enum(c, allowed, default: str) -> Column:
    """Values outside the enum (NULL included) become ``default``."""
    c = _c(c)
    return F.when(c.isin(list(allowed)), c).otherwise(F.lit(default))


def zero_default(c, zero=0) -> Column:
    """Unparseable number -> 0."""
    return F.coalesce(_c(c), F.lit(zero))


def iso_or_epoch(c) -> Column:
    """ISO text, else epoch seconds (UTC), else NULL; result TIMESTAMP_NTZ."""
    c = _c(c)
    micros = (c.try_cast("double") * F.lit(1_000_000)).try_cast("bigint")
    epoch = F.expr("timestampadd(MICROSECOND, 0, TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    from_epoch = F.timestamp_add("MICROSECOND", micros, epoch)
    return F.coalesce(lenient_timestamp(c), from_epoch)


def action_label(clicked) -> Column:
    """C19: 'click' for a clicked event, else 'impression'."""
    return F.when(_c(clicked), F.lit("click")).otherwise(F.lit("impression"))
