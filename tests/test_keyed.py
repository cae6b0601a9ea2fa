"""Stored keyed tables, counters with a ledger and versioned manifests."""

import json
import os
import random
from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import functions as F

from adspark.sources import keyed, versions
from adspark.sources.sinks import publish_tables, read_published, upsert_partitions

SCHEMA = "k int, part string, v string, seq int"
PARTS = ["01", "02", "1", "a:b", "a/b", "x=y", "", None, "é %", "__HIVE_DEFAULT_PARTITION__"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def last_wins(batches):
    state = {}
    for batch in batches:
        best = {}
        for k, p, v, seq in batch:
            if k not in best or seq >= best[k][2]:
                best[k] = (p, v, seq)
        state |= {k: (p, v) for k, (p, v, _) in best.items()}
    return sorted(((k, p, v) for k, (p, v) in state.items()), key=repr)


def random_batches(seed, n=4):
    r = random.Random(seed)
    return [[(k, r.choice(PARTS), f"{b}-{i}", i) for i, k in enumerate(r.choices([None, *range(25)], k=18))] for b in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_upserts_equal_a_dictionary(spark, tmp_dir, seed):
    batches = random_batches(seed)
    for n, batch in enumerate(batches, 1):
        assert keyed.upsert(spark, tmp_dir, spark.createDataFrame(batch, SCHEMA), ["k"], "part", "seq", buckets=5)
        assert rows(keyed.read(spark, tmp_dir)) == last_wins(batches[:n])
    where = spark.createDataFrame([("01",), (None,)], "p string")
    assert rows(keyed.read(spark, tmp_dir, where)) == [r for r in last_wins(batches) if r[1] in ("01", None)]
    wanted = spark.createDataFrame([(3,), (7,), (99,), (None,)], "k int")
    assert rows(keyed.find(spark, tmp_dir, wanted)) == [r for r in last_wins(batches) if r[0] in (3, 7, None)]


def test_a_moved_key_is_found_without_reading_the_table(spark, tmp_dir):
    first = spark.range(400).selectExpr("CAST(id AS int) AS k", "CONCAT('p', id % 40) AS part", "'a' AS v")
    keyed.upsert(spark, tmp_dir, first, ["k"], "part")
    before = versions.newest(spark, tmp_dir)[1]
    keyed.upsert(spark, tmp_dir, spark.createDataFrame([(7, "p9", "moved")], "k int, part string, v string"), ["k"], "part")
    after = versions.newest(spark, tmp_dir)[1]
    changed = lambda kind: [n for n, p in after[kind].items() if before[kind].get(n) != p]
    assert len(before["slices"]) == 40 and len(changed("slices")) == 2 and len(changed("locator")) == 1
    assert rows(keyed.find(spark, tmp_dir, spark.createDataFrame([(7,)], "k int"))) == [(7, "p9", "moved")]
    assert keyed.read(spark, tmp_dir).count() == 400


def test_an_emptied_slice_leaves_the_manifest(spark, tmp_dir):
    put = lambda p: keyed.upsert(spark, tmp_dir, spark.createDataFrame([(1, p, "a")], "k int, part string, v string"), ["k"], "part")
    put("x"), put("y")
    assert rows(keyed.read(spark, tmp_dir)) == [(1, "y", "a")] and len(versions.newest(spark, tmp_dir)[1]["slices"]) == 1


def test_a_batch_needs_one_row_a_key_and_the_table_s_columns(spark, tmp_dir):
    twice = spark.createDataFrame([(1, "x", "a"), (1, "x", "b")], "k int, part string, v string")
    with pytest.raises(ValueError):
        keyed.upsert(spark, tmp_dir, twice, ["k"], "part")
    keyed.upsert(spark, tmp_dir, twice.limit(1), ["k"], "part")
    with pytest.raises(ValueError):
        keyed.upsert(spark, tmp_dir, twice.limit(1).withColumn("other", F.lit(1)), ["k"], "part")


@pytest.mark.parametrize("dies", ["before the commit", "in the commit"])
def test_a_killed_batch_runs_again_to_the_same_counters(spark, tmp_dir, monkeypatch, dies):
    schema = "campaign_id int, day string, n long"
    a = spark.createDataFrame([(1, "d1", 2), (1, "d1", 3), (2, "d2", 1), (None, None, 4)], schema)
    b = spark.createDataFrame([(1, "d1", 10), (3, "d2", 1), (None, None, 1)], schema)
    add = lambda i, d: keyed.add_counts(spark, tmp_dir, i, d, ["campaign_id", "day"], ["n"], "day")
    assert add("a", a)
    want = rows(keyed.read(spark, tmp_dir))
    real = versions.commit
    with monkeypatch.context() as m:
        if dies == "before the commit":
            m.setattr(versions, "commit", lambda *x: (_ for _ in ()).throw(KeyboardInterrupt))
        else:  # the manifest is cut off
            m.setattr(versions, "json", SimpleNamespace(dumps=lambda *x, **y: '{"schema": ', loads=json.loads))
        try:
            add("b", b)
        except KeyboardInterrupt:
            pass
    assert versions.commit is real and keyed.batches(spark, tmp_dir) == ["a"]
    assert rows(keyed.read(spark, tmp_dir)) == want == sorted([(1, "d1", 5), (2, "d2", 1), (None, None, 4)], key=repr)
    assert add("b", b) and not add("b", b) and not add("a", a)
    assert keyed.batches(spark, tmp_dir) == ["a", "b"]
    assert rows(keyed.read(spark, tmp_dir)) == sorted([(1, "d1", 15), (2, "d2", 1), (3, "d2", 1), (None, None, 5)], key=repr)
    versions.expire(spark, tmp_dir, keep=1)
    assert len(os.listdir(tmp_dir + "/data")) == 1 and keyed.read(spark, tmp_dir).count() == 4


def test_of_two_loads_one_fails(spark, tmp_dir):
    versions.commit(spark, tmp_dir, {"a": 1}, 0)
    number, _ = versions.newest(spark, tmp_dir)
    assert versions.commit(spark, tmp_dir, {"a": 2}, number) == 2
    with pytest.raises(versions.Conflict):
        versions.commit(spark, tmp_dir, {"a": 3}, number)
    assert versions.newest(spark, tmp_dir) == (2, {"a": 2})


def test_expiry_deletes_only_what_no_kept_version_names(spark, tmp_dir):
    for n in range(3):
        publish_tables(spark, {"t": spark.range(n + 1)}, tmp_dir)
    assert len(os.listdir(tmp_dir + "/tables")) == 3
    versions.expire(spark, tmp_dir, keep=2)
    assert len(os.listdir(tmp_dir + "/tables")) == 2 and read_published(spark, tmp_dir)["t"].count() == 3


def test_a_rejected_load_leaves_nothing(spark, tmp_dir):
    publish_tables(spark, {"t": spark.range(2)}, tmp_dir)
    with pytest.raises(ValueError):
        publish_tables(spark, {"t": spark.range(5)}, tmp_dir, checks={"none": lambda w: w["t"].where("id > 3")})
    assert len(os.listdir(tmp_dir + "/tables")) == 1 and read_published(spark, tmp_dir)["t"].count() == 2


def test_plain_folder_keeps_text_partitions(spark, tmp_dir):
    path = tmp_dir + "/t"
    put = lambda *r: upsert_partitions(spark, path, spark.createDataFrame(list(r), "k int, part string, v string"), ["k"], "part")
    got = lambda: rows(spark.read.schema("k int, v string, part string").parquet(path).select("k", "part", "v"))
    put((1, "01", "a"), (2, "02", "a"), (3, "02", "a"), (4, "a:b", "a"), (5, "x=y %", "a"), (6, "", "a"))
    put((2, "01", "b"))
    assert got() == sorted([(1, "01", "a"), (2, "01", "b"), (3, "02", "a"), (4, "a:b", "a"), (5, "x=y %", "a"), (6, None, "a")], key=repr)
    put((4, "01", "b"), (5, "01", "b"), (6, "01", "b"))  # these leave their partitions empty
    assert got() == [(1, "01", "a"), (2, "01", "b"), (3, "02", "a"), (4, "01", "b"), (5, "01", "b"), (6, "01", "b")]


def test_random_batches_against_duckdb(spark, tmp_dir):
    batches = random_batches(9, 3)
    con = duckdb.connect()
    con.execute("CREATE TABLE b (load int, k int, part varchar, v varchar, seq int)")
    for n, batch in enumerate(batches):
        keyed.upsert(spark, tmp_dir, spark.createDataFrame(batch, SCHEMA), ["k"], "part", "seq")
        con.executemany("INSERT INTO b VALUES (?, ?, ?, ?, ?)", [(n, *r) for r in batch])
    want = con.execute("SELECT k, part, v FROM b QUALIFY row_number() OVER (PARTITION BY k ORDER BY load DESC, seq DESC) = 1").fetchall()
    assert rows(keyed.read(spark, tmp_dir)) == sorted(want, key=repr)
