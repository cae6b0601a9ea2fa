import math

import duckdb
import numpy as np

from adspark.llm import topk


def brute(rows, k=20):
    by = {}
    for i, e in rows:
        if i is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        v = [math.floor(64 * float(np.float32(x))) for x in e]
        by[i] = min(by.get(i, v), v)
    out = []
    for q, a in by.items():
        if q % 20 == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in by.items() if c != q and len(a) == len(b))[:k]
            out += [(q, n + 1, c, -t) for n, (t, c) in enumerate(s)]
    return sorted(out)


def table(spark, rows):
    rows = [(i, e if e is None else [x if x is None else float(x) for x in e]) for i, e in rows]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS block", "'x' AS v", "2 AS dim")


def test_awkward_vectors(spark):
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=6).tolist()) for i in range(150)]
    rows += [(i, [0.5] * 6) for i in range(200, 330)]                       # many equal vectors: ties by vec_id
    rows += [(400 + i, r.normal(size=3).tolist()) for i in range(10)]       # another length
    rows += [(500, None), (520, []), (521, []), (540, [0.0] * 6), (560, [1.0, None, 0, 0, 0, 0]), (580, [math.nan] + [0.0] * 5),
             (600, [math.inf] + [0.0] * 5), (None, [1.0] * 6), (20, [0.1] * 6), (20, [0.1] * 6), (21, [9.0] * 6), (-20, [-1.0] * 6)]
    got = sorted(map(tuple, topk.op1(table(spark, rows)).collect()))
    assert got == brute(rows)


def test_small_blocks_and_large_values(spark, monkeypatch):
    r = np.random.default_rng(6)
    for name, value in (("BLOCK", 40), ("QUERY_BLOCK", 7), ("BLOCKS_PER_SLICE", 2), ("WAVES", (3, 9)), ("CHUNK", 2)):
        monkeypatch.setattr(topk, name, value)
    rows = [(i, (r.normal(size=4) * 10.0 ** r.integers(-2, 5)).tolist()) for i in range(500)]
    assert sorted(map(tuple, topk.op1(table(spark, rows)).collect())) == brute(rows)


def test_pivots_eliminate():
    r = np.random.default_rng(7)
    v = np.concatenate([r.normal(size=(600, 8)) * 3 + 200, r.normal(size=(600, 8)) * 3 - 200]).round()
    pivots = np.stack([np.zeros(8), v[0], v[-1]])
    row = lambda a, ids: {"dim": 8, "ids": ids.astype("<i8").tobytes(), "vectors": a.astype("<i2").tobytes(), "dtype": "<i2",
                          "table": topk._distances(a, pivots).tobytes()}
    s = topk.Search(topk._Block(row(v[:5], np.arange(5))), 3)
    s.add(topk._Block(row(v[:600], np.arange(600))))
    before = s.score.copy()
    merged = []
    s._merge = lambda *a: merged.append(a)
    s.add(topk._Block(row(v[600:], np.arange(600, 1200))))
    assert not merged and (s.score == before).all()


def test_few_and_empty(spark):
    assert topk.op1(table(spark, [])).count() == 0
    assert sorted(map(tuple, topk.op1(table(spark, [(0, [1.0]), (1, [2.0])])).collect())) == [(0, 1, 1, 64 * 128)]


def test_oracle(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.01/embeddings.parquet'")
    got = [tuple(r) for r in topk.op1(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")).collect()]
    assert len(got) == 500 and sorted(got) == sorted(con.execute(topk.ORACLE).fetchall())
