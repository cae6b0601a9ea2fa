from collections import defaultdict
import zlib

import numpy as np

from adspark.llm import sharding

from .helpers import AWKWARD, docs


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_equals_the_scalar_form():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 2000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for n in (1, 2, 8, 9, 1000):
        assert sharding.jump_hash(keys, n).tolist() == [jump(int(k), n) for k in keys]


def check(rows, table):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "key" and 0 <= r["shard"] < 8 and r["grown_shard"] in (r["shard"], 8)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    place = {}
    for r in rows:
        assert place.setdefault(r["doc_id"], (r["shard"], r["grown_shard"])) == (r["shard"], r["grown_shard"])
    want = sorted(((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in table), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=repr) == want


def test_documents(spark):
    rows = [*AWKWARD, *[(99, "hot", None, None, None)] * 200]
    check(sharding.shard_documents(docs(spark, rows)).collect(), [r[:2] for r in rows])
    assert sharding.shard_documents(docs(spark, [])).count() == 0


def test_table_and_growth(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sharding.shard_documents(table).collect()
    check(got, [(r["doc_id"], r["text"]) for r in table.collect()])
    moved = sum(r["shard"] != r["grown_shard"] for r in got)
    assert 0.5 < moved / (len(got) / 9) < 1.6


def test_write_shards(spark, tmp_dir):
    sharding.write_shards(docs(spark, AWKWARD, extra=False), "doc_id", 4, tmp_dir + "/s")
    assert spark.read.parquet(tmp_dir + "/s").count() == len(AWKWARD)
