"""Inputs outside the tidy bridge data: nothing may be lost or changed on the way."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adspark.functions.metrics import round_ratio
from adspark.functions.parsing import iso_or_epoch, lenient_int, lenient_timestamp, to_bool
from adspark.operators.clean import MONEY
from adspark.functions.parsing import lenient_decimal
from adspark.sources.sinks import upsert_partitions


def values(spark, texts, fn, cast="string"):
    return [r[0] for r in spark.createDataFrame([(t,) for t in texts], "x string").select(fn("x").cast(cast)).collect()]


def test_boolean_spellings(spark):
    assert values(spark, ["True", "TRUE", "true", "False", "FALSE", "false", "yes", None], to_bool, "boolean") == \
        [True, True, True, False, False, False, None, None]


def test_integers_with_a_zero_fraction(spark):
    assert values(spark, ["123", "123.0", "12.5", "x", None, "99999999999"], lenient_int, "int") == \
        [123, 123, None, None, None, None]


def test_offsets_move_to_utc(spark):
    texts = ["2024-01-01T10:00:00+02:00", "2024-01-01 10:00:00Z", "2024-01-01 10:00:00", "2024-01-01", "2024-01-01T23:30:00.5-01:00"]
    want = ["2024-01-01 08:00:00", "2024-01-01 10:00:00", "2024-01-01 10:00:00", "2024-01-01 00:00:00", "2024-01-02 00:30:00.5"]
    assert values(spark, texts, lenient_timestamp) == want and values(spark, texts, iso_or_epoch) == want
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert values(spark, texts, lenient_timestamp) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_offsets_in_the_hour_that_comes_twice(spark):
    texts = ["2024-11-03T08:30:00Z", "2024-11-03T09:30:00Z", "2024-11-03 01:30:00-08:00", "2024-03-10T02:30:00Z", "2024-03-10 02:30:00"]
    want = ["2024-11-03 08:30:00", "2024-11-03 09:30:00", "2024-11-03 09:30:00", "2024-03-10 02:30:00", "2024-03-10 02:30:00"]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert values(spark, texts, lenient_timestamp) == want and values(spark, texts, iso_or_epoch) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_large_amounts_stay(spark):
    assert values(spark, ["12345.5", "99999999999.1234"], lambda c: lenient_decimal(c, *MONEY), "decimal(18,4)") == \
        [Decimal("12345.5000"), Decimal("99999999999.1234")]


def test_ratios_are_exact_for_large_numbers(spark):
    r = random.Random(4)
    rows = [(r.randint(5 * 10**13, 10**15), r.randint(1, 10**4)) for _ in range(3000)] + [(10**17, 3), (10**17, 7), (-5, 2)]
    got = [x[0] for x in spark.createDataFrame(rows, "a bigint, b bigint").select(round_ratio("a", "b")).collect()]
    sign = lambda a: (a > 0) - (a < 0)
    assert got == [sign(a) * ((abs(a) * 200 + b) // (2 * b)) / 100.0 for a, b in rows]


def stored(spark, path):
    return sorted((r["k"], r["v"], r["day"]) for r in spark.read.parquet(path).collect())


def batch(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, day int, load_seq int")


def test_upsert_reduces_every_batch_and_moves_keys(spark, tmp_dir):
    path = tmp_dir + "/t"
    upsert_partitions(spark, path, batch(spark, [(1, "z", 1, 1), (1, "b", 1, 2), (2, "c", 2, 1), (3, "d", 3, 1)]), ["k"], "day")
    assert stored(spark, path) == [(1, "b", 1), (2, "c", 2), (3, "d", 3)]
    upsert_partitions(spark, path, batch(spark, [(2, "z", 3, 1), (2, "a", 3, 2), (4, "e", 1, 1)]), ["k"], "day")
    assert stored(spark, path) == [(1, "b", 1), (2, "a", 3), (3, "d", 3), (4, "e", 1)]
    with pytest.raises(ValueError):
        upsert_partitions(spark, path, batch(spark, [(9, "a", 1, 1), (9, "b", 1, 2)]).drop("load_seq"), ["k"], "day")


def test_upsert_keeps_null_partitions_and_keys(spark, tmp_dir):
    path, schema = tmp_dir + "/t", "k int, v string, day int, load_seq int"
    rows = lambda: sorted(map(tuple, spark.read.parquet(path).select("k", "v", "day").collect()), key=repr)
    put = lambda *r: upsert_partitions(spark, path, spark.createDataFrame(list(r), schema), ["k"], "day")
    put((1, "a", None, 1), (2, "b", None, 1), (3, "c", 1, 1), (None, "n", 2, 1), (7, "g", 2, 1))
    put((2, "B", None, 1), (4, "d", None, 1), (None, "N", 1, 1))  # the null key leaves partition 2
    assert rows() == sorted([(1, "a", None), (2, "B", None), (4, "d", None), (3, "c", 1), (None, "N", 1), (7, "g", 2)], key=repr)
    put((1, "a", 1, 1), (2, "b", 1, 1), (4, "d", 1, 1))  # all leave the null partition
    assert rows() == sorted([(1, "a", 1), (2, "b", 1), (4, "d", 1), (3, "c", 1), (None, "N", 1), (7, "g", 2)], key=repr)


def test_a_failing_read_leaves_the_table_alone(spark, tmp_dir):
    path = tmp_dir + "/t"
    upsert_partitions(spark, path, batch(spark, [(1, "a", 1, 1), (2, "b", 1, 1)]), ["k"], "day")
    before = stored(spark, path)
    with pytest.raises(Exception):
        upsert_partitions(spark, path, batch(spark, [(1, "x", 1, 1)]).withColumn("other", F.lit(1)), ["k"], "day")
    assert stored(spark, path) == before
