import datetime as dt
from decimal import Decimal


from adspark.functions.metrics import round_ratio
from adspark.functions.parsing import (
    GENDERS, age_bound, clean_list, coerce_enum, iso_or_epoch, lenient_decimal, lenient_timestamp,
    list_keep_blanks, na_to_null, targeting_part, to_bool,
)


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_lenient_timestamp_and_decimal(spark):
    assert one(spark, lenient_timestamp("v"), "not-a-date") is None
    assert one(spark, lenient_timestamp("v"), "2024-01-02 03:04:05") == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, lenient_decimal("v", 8, 4), "abc") is None
    assert one(spark, lenient_decimal("v", 8, 4), "12.5") == Decimal("12.5000")
    assert one(spark, lenient_decimal("v", 8, 4), "10000.00001") is None  # does not fit DECIMAL(8,4)


def test_bool_and_na(spark):
    assert [one(spark, to_bool("v"), x) for x in ["True", "False", "", "maybe"]] == [True, False, None, None]
    assert one(spark, na_to_null("v"), "N/A") is None
    assert one(spark, na_to_null("v"), "x") == "x"


def test_targeting_split_and_ages(spark):
    rows = ["Age 18-24, Travel, USA", "Age  18-24 ,Travel", "Everyone", None, "Age18-24, Food, India"]
    df = spark.createDataFrame([(r,) for r in rows], "v string")
    got = df.select(age_bound(targeting_part("v", 0), 1).alias("lo"), age_bound(targeting_part("v", 0), 2).alias("hi"),
                    targeting_part("v", 1).alias("i"), targeting_part("v", 2).alias("c")).collect()
    assert [tuple(r) for r in got] == [(18, 24, "Travel", "USA"), (18, 24, "Travel", None),
                                       (None, None, None, None), (None, None, None, None),
                                       (None, None, "Food", "India")]


def test_interest_lists(spark):
    df = spark.createDataFrame([("Travel, ,Food ",), ("",), (None,), ("Food,Food",)], "v string")
    got = df.select(clean_list("v").alias("a"), list_keep_blanks("v").alias("b")).collect()
    assert got[0]["a"] == ["Travel", "Food"] and got[0]["b"] == ["Travel", "", "Food"]
    assert got[1]["a"] == [] and got[1]["b"] == []
    assert got[2]["a"] is None and got[2]["b"] == []
    assert got[3]["a"] == ["Food", "Food"]


def test_enum_and_epoch(spark):
    assert one(spark, coerce_enum("v", GENDERS, "Other"), "Unknown") == "Other"
    assert one(spark, coerce_enum("v", GENDERS, "Other"), None) == "Other"
    assert one(spark, iso_or_epoch("v"), "1730000000.5") == dt.datetime(2024, 10, 27, 3, 33, 20, 500000)
    assert one(spark, iso_or_epoch("v"), "2024-01-01T10:00:00") == dt.datetime(2024, 1, 1, 10)
    assert one(spark, iso_or_epoch("v"), "") is None


def test_round_ratio_half_away(spark):
    df = spark.createDataFrame([(1, 8), (3, 8), (-1, 8), (5, 0), (2, 3)], "a long, b long")
    got = [r[0] for r in df.select(round_ratio("a", "b")).collect()]
    assert got == [0.13, 0.38, -0.13, None, 0.67]
    # 4087.14 / 12 = 340.595 exactly -> 340.60 (a double would give 340.59)
    df = spark.createDataFrame([(40871400, 120000)], "a long, b long")
    assert df.select(round_ratio("a", "b")).first()[0] == 340.6


def test_round_ratio_matches_decimal_half_up(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal as D
    rnd = random.Random(7)
    pairs = [(rnd.randint(-10**9, 10**9), rnd.randint(1, 10**6)) for _ in range(2000)]
    pairs += [(k * 5, 1000) for k in range(-50, 50)]  # exact halves at the third decimal
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {(r["a"], r["b"]): r["r"] for r in df.select("a", "b", round_ratio("a", "b").alias("r")).collect()}
    for a, b in pairs:
        want = float((D(a) / D(b)).quantize(D("0.01"), rounding=ROUND_HALF_UP))
        assert got[(a, b)] == want, (a, b)
