"""Z-ordered layout, first of the file, totals of every as-of day, skipped loads."""

import datetime
import glob
import os
import random
from collections import defaultdict

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from adspark.operators.clean import FILE_ORDER, key_dedup_first
from adspark.plans import rollups
from adspark.sources import layout
from adspark.sources.csv import RAW_EVENT_COLUMNS, read_raw

FILES = 64


def facts(spark, n=120_000):
    """A third of the rows are of one campaign, users are spread, time rises."""
    return spark.range(0, n, numPartitions=4).selectExpr(
        "IF(id % 3 = 0, 7, CAST(pmod(xxhash64(id), 1000) AS int)) AS campaign_id", "CAST(pmod(xxhash64(id, 1), 5000) AS int) AS user_id",
        "timestampadd(SECOND, id, TIMESTAMP_NTZ'2024-01-01 00:00:00') AS at", "id")


def files_with(path, column, lo, hi=None):
    """Files whose statistics do not exclude the values from ``lo`` to ``hi``."""
    hi = lo if hi is None else hi
    n = 0
    for f in glob.glob(path + "/*.parquet"):
        meta = pq.read_metadata(f)
        k = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(k).statistics for g in range(meta.num_row_groups)]
        n += any(s.min <= hi and s.max >= lo for s in stats)
    return n


def test_one_campaign_or_one_user_reads_less_than_half_of_the_files(spark, tmp_dir):
    df = facts(spark)
    layout.write_ordered(df, tmp_dir + "/z", ["campaign_id", "user_id", "at"], FILES, ["campaign_id", "user_id"])
    df.repartitionByRange(FILES, "at").sortWithinPartitions("at").write.parquet(tmp_dir + "/t")
    day = datetime.datetime(2024, 1, 1, 3), datetime.datetime(2024, 1, 1, 3, 30)
    z = {c: files_with(tmp_dir + "/z", c, *v) for c, v in {"campaign_id": (321,), "user_id": (4321,), "at": day}.items()}
    t = {c: files_with(tmp_dir + "/t", c, *v) for c, v in {"campaign_id": (321,), "user_id": (4321,), "at": day}.items()}
    assert t["campaign_id"] == t["user_id"] == FILES
    assert z["campaign_id"] <= FILES / 2 and z["user_id"] <= FILES / 2.5 and z["at"] <= FILES / 3
    # the campaign of a third of all rows lies in many files, which its users tell apart
    assert files_with(tmp_dir + "/z", "campaign_id", 7) < FILES
    assert spark.read.parquet(tmp_dir + "/z").exceptAll(df).count() == 0 and spark.read.parquet(tmp_dir + "/z").count() == df.count()
    sizes = [pq.read_metadata(f).num_rows for f in glob.glob(tmp_dir + "/z/*.parquet")]
    assert max(sizes) < 4 * sum(sizes) / len(sizes)


def test_order_of_nulls_constants_and_empty_tables(spark):
    rows = [(None, 1, None), (3, 1, datetime.date(2024, 1, 1)), (2, 1, None), (3, 1, datetime.date(2023, 1, 1))]
    df = spark.createDataFrame(rows, "a int, b int, c date")
    assert sorted(map(tuple, layout.ordered(df, ["a", "b", "c"]).collect()), key=repr) == sorted(rows, key=repr)
    assert layout.ordered(df.limit(0), ["a", "c"]).count() == 0
    z = {r["a"]: r[layout.Z] for r in layout.with_z(spark.range(1000).selectExpr("id AS a"), ["a"], 4).collect()}
    assert all(z[i] <= z[i + 1] for i in range(999)) and set(z.values()) == set(range(16))


def test_the_first_row_of_the_files_stays(spark, tmp_dir):
    r = random.Random(5)
    head = ",".join(RAW_EVENT_COLUMNS)
    line = lambda key, n: ",".join([key, *["x"] * 8, f"v{n}", *["y"] * 8])
    first, n = {}, 0
    for f in ("a-1.csv", "a-10.csv", "b.csv"):
        lines = []
        for _ in range(400):
            key = f"k{r.randrange(150)}"
            first.setdefault(key, f"v{n}")
            lines.append(line(key, n))
            n += 1
        with open(os.path.join(tmp_dir, f), "w") as out:
            out.write("\n".join([head, *lines]) + "\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")  # many splits a file
        raw = read_raw(spark, tmp_dir, RAW_EVENT_COLUMNS, file_order=True)
        got = key_dedup_first(raw)
        assert FILE_ORDER not in got.columns
        assert raw.rdd.getNumPartitions() > 6
        assert {x["EventID"]: x["Location"] for x in got.collect()} == first
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_totals_of_every_as_of_day(spark):
    r = random.Random(2)
    start = datetime.date(2024, 1, 1)
    rows = [(r.choice("abc"), start + datetime.timedelta(r.choice([0, 1, 2, 40, 41, 90, 119])), r.choice([0, 0, 1, 5])) for _ in range(60)]
    rows += [("a", None, 9), (None, start, 3)]
    got = rollups.asof_totals(spark.createDataFrame(rows, "k string, day date, v int"), ["k"], "v")
    want = defaultdict(int)
    last = max(d for _, d, _ in rows if d)
    for k, d, v in rows:
        for i in range(31):
            if d is not None and d + datetime.timedelta(i) <= last:
                want[d + datetime.timedelta(i), k] += v
    assert {(x["as_of"], x["k"]): x["total"] for x in got.collect()} == want
    assert rollups.asof_totals(spark.createDataFrame([], "k string, day date, v int"), ["k"], "v").count() == 0
    top = rollups.top_asof(got, "k", 1).collect()
    assert len(top) == len({d for d, _ in want}) and all(x["total"] == max(v for (d, _), v in want.items() if d == x["as_of"]) for x in top)


def test_unchanged_inputs_are_not_loaded_again(spark, tmp_dir):
    from adspark.plans.catalog import load_csv
    from adspark.sources import bridge
    raw = bridge.raw_inputs(spark, "/root/testdata/sf0.001")
    paths = [f"{tmp_dir}/{n}" for n in ("events", "campaigns", "users")]
    for df, path in zip((raw.ad_events, raw.campaigns, raw.users), paths):
        df.write.option("header", True).csv(path)
    tables, loaded = load_csv(spark, *paths, tmp_dir + "/wh")
    n = tables["ad_impressions"].count()
    again, loaded_again = load_csv(spark, *paths, tmp_dir + "/wh")
    assert loaded and not loaded_again and again["ad_impressions"].count() == n
    raw.ad_events.limit(50).withColumn("EventID", F.concat(F.lit("90000"), "EventID")).write.mode("append").option("header", True).csv(paths[0])
    tables, loaded = load_csv(spark, *paths, tmp_dir + "/wh")
    assert loaded and tables["ad_impressions"].count() == n + 50
