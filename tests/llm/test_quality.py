import re
from collections import Counter

import duckdb

from adspark.llm import quality

from .helpers import AWKWARD, docs

ODD = [(20, "a b c a b c a b c d", None, "q", 1), (21, "x\ny\nx\n \nx\n\n", None, "q", 1), (22, "a a a a a", None, "q", 1),
       (23, " ".join(f"w{i}" for i in range(60)), None, "q", 1), (24, " ".join(f"w{i} #" for i in range(60)), None, "q", 1),
       (25, "\n".join(["same line here now"] * 30 + [f"l{i} m{i} n{i}" for i in range(30)]), None, "q", 1),
       (26, "a b", None, "q", 1), (29, "f for fun\x0cf stuff of f\nf\nf", None, "q", 1), (27, "a b c", None, "q", 1), (28, "a b c d\x0be\x0cf\x1cg\xa0h", None, "q", 1)]


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), failed)


def test_measures(spark):
    rows = AWKWARD + ODD
    got = quality.op4(docs(spark, rows)).collect()
    assert sorted((tuple(r)[:7] for r in got), key=repr) == sorted(((r[0], *base(r[1])) for r in rows), key=repr)
    assert not any(r["kept"] for r in got if r["base_failed"])
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert quality.op4(docs(spark, [])).count() == 0
    assert not kept[24] and not kept[25]


def test_host_verdict_needs_evidence(spark):
    good = " ".join(f"w{i}" for i in range(80))
    bad = " ".join(f"w{i} #" for i in range(80))
    rows = [(i, good, None, f"good{i % 20}", None) for i in range(400)]
    rows += [(1000 + i, bad, None, "bad", None) for i in range(60)] + [(2000, good, None, "bad", None)]
    rows += [(3000, bad, None, "tiny", None), (3001, good, None, "tiny", None), (3002, good, None, None, None)]
    kept = {r["doc_id"]: r["kept"] for r in quality.host_quality(docs(spark, rows)).collect()}
    assert all(kept[i] for i in range(400)) and not kept[2000] and not kept[3000] and kept[3001] and kept[3002]
    rates = {r["host"]: r["symbols"] for r in quality.host_rates(quality.measures(docs(spark, rows))).collect()}
    assert 0.5 < rates["bad"] < 60 / 61 and 0.0 < rates["tiny"] < 0.5 and 0 <= rates["good0"] < 0.05


def test_oracle(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    want = con.execute(quality.ORACLE).fetchall()
    got = [tuple(r) for r in quality.op4(spark.read.parquet(path)).collect()]
    assert sorted(got) == sorted(want)
    assert {r[-1] for r in got} == {True, False}
