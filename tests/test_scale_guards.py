"""Skew and plan-shape guards: hot keys stay correct and are reduced map-side; no
registered plan uses a Python UDF, a cartesian product or a nested-loop join."""

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as E
from adspark.operators import documents
from adspark.operators.keys import dense_ids, keep_one
from tests.test_documents_rollups import ev, events

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_one_hot_key_is_partial_aggregate(spark):
    n = 30000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                               F.col("id").alias("o"), (F.col("id") * 2).alias("v"))
    out = keep_one(df, ["k"], ["o"], last=True)
    plan = _plan(out)
    assert "partial_max" in plan and "Window" not in plan
    got = {r["k"]: r["v"] for r in out.where("k = 0").collect()}
    assert got == {0: 2 * 29997}
    assert out.count() == 1 + (n - n // 3)


def test_hot_session_is_split_into_buckets(spark):
    rows = [ev(i, 1, "Mobile", 1, i % 600, clicked=(i % 7 == 0)) for i in range(3000)]
    rows += [ev(10000 + i, 2, "Tablet", 2, i) for i in range(5)]
    docs = documents.build_sessions(events(spark, rows), bucket_size=100)
    sizes = [r["n"] for r in docs.where("user_id = 1").select(F.size("impressions").alias("n")).collect()]
    assert len(sizes) == 30 and sum(sizes) == 3000 and max(sizes) < 200
    first = docs.where("user_id = 1").select("session_start", "session_end").distinct().collect()
    assert len(first) == 1 and first[0]["session_start"] == dt.datetime(2024, 1, 1, 10, 0)


def test_dense_ids_with_hot_prefix(spark):
    df = spark.range(20000, numPartitions=5).select((F.col("id") % 2).alias("g"), F.col("id"))
    got = dense_ids(df, ["g", "id"], "rid").where("rid IN (1, 10000, 10001, 20000)").orderBy("rid").collect()
    assert [(r["g"], r["id"], r["rid"]) for r in got] == [(0, 0, 1), (0, 19998, 10000), (1, 1, 10001), (1, 19999, 20000)]


def test_registered_plans_stay_in_the_jvm_and_types_match_oracle(spark):
    import duckdb
    con = duckdb.connect()
    for t in ["nation", "customer", "part", "events", "lineitem", "orders"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    as_duck = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
               "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    bad = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")
    oracle = E._oracle.ORACLE  # the engine's own queries; the training-data operators choose their style
    for name in oracle:
        df = E.queries()[name](spark, SF)
        plan = _plan(df)
        assert not any(b in plan for b in bad), name
        rel = con.sql(oracle[name])
        duck = dict(zip(rel.columns, [str(t) for t in rel.types]))
        ours = {f.name: as_duck.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
        assert ours == duck, name


def test_first_n_equals_ordered_limit(spark):
    from adspark.sources.csv import first_n
    df = spark.range(0, 9000, numPartitions=9).select(((F.col("id") * 7) % 100).alias("t"), F.col("id"))
    got = sorted(tuple(r) for r in first_n(df, 1234, ["t", "id"]).collect())
    want = sorted(tuple(r) for r in df.orderBy("t", "id").limit(1234).collect())
    assert got == want
