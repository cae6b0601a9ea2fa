import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from adspark.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top=2000, least=10):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            ws = [w for w in re.split("[ \t]+", piece) if w]
            total[lang] += len(ws)
            for k in (1, 2, 3):
                f.update((lang, tuple(ws[i:i + k])) for i in range(len(ws) - k + 1))
    out = []
    cands = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    for (lang, ws), a in cands.items():
        if any(100 * b >= 50 * a and g == lang and len(v) > len(ws) and any(v[i:i + len(ws)] == ws for i in range(2))
               for (g, v), b in cands.items()):
            continue
        score, k = min((1000000 * a * a // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws)))
        out.append((lang, " ".join(ws), a, f[lang, ws[:k]], f[lang, ws[k:]], total[lang], score))
    result = []
    for lang in total:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        result += [(lang, i, *r[1:]) for i, r in enumerate(mine, 1)]
    return sorted(result)


def table(spark, rows, extra=""):
    return spark.createDataFrame(rows, "lang string, text string").repartition(4).selectExpr("*", *extra.split())


def texts(rng, n):
    words = ["alpha", "BETA", "gámma", "De", "eps", "z\x1cz", "x y", "th"]
    weights = [9, 9, 6, 5, 4, 3, 2, 2]
    seps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?", " \r\n"]
    return [(rng.choice(["en", "fr", None, "und"]), "".join(w + rng.choice(seps) for w in rng.choices(words, weights, k=80)))
            for _ in range(n)]


@pytest.mark.parametrize("settings", [{}, {"sample": 1}, {"sample": 10 ** 9}, {"bits": 8}, {"sample": 3, "sample_count": 40}])
def test_any_sample_gives_the_same_whole_result(spark, settings):
    rows = texts(random.Random(3), 60) + [("en", None), ("en", ""), (None, "  .. ")]
    want = brute(rows)
    assert len({r[0] for r in want}) == 3 and len(want) > 50
    assert sorted(map(tuple, phrases.mine(table(spark, rows), **settings).collect())) == want


@pytest.mark.parametrize("wide", [False, True])
def test_blocks_count_alike(spark, wide):
    rows = [(a or "und", t) for a, t in texts(random.Random(4), 40)]
    full = phrases.Proposals(*[np.full(1 << 20, 255, dtype="uint8")] * 2)
    total = Counter()
    more = " ".join(f"v{i}" for i in range(1 << 21)) if wide else ""  # so many words that three do not fit in 63 bits
    for k in range(0, len(rows), 7):
        for lang in {r[0] for r in rows}:
            block = [t for g, t in rows[k:k + 7] if g == lang]
            for b in phrases._counts(lang, block + [more] * (k == 0), full, None, 1 << 23):
                for phrase, n in zip(b["phrase"].to_pylist(), b["n"].to_pylist()):
                    if not re.search("v[0-9]", phrase):
                        total[lang, phrase] += n
    found = phrases.mine(table(spark, rows)).collect()
    assert found and all(total[r["lang"], r["phrase"]] == r["a"] for r in found)


def test_ties_the_limit_and_products_past_64_bits(spark):
    rows = [("en", ". ".join(["b a", "a b", "c d", "d c"] * 12))]
    got = sorted(map(tuple, phrases.mine(table(spark, rows), top=3).collect()))
    assert got == brute(rows, top=3) and [r[2] for r in got] == ["a b", "b a", "c d"]
    big = 10 ** 12
    found = spark.createDataFrame([("en", "", 4 * big), ("en", "p", 3 * big + 1), ("en", "q", 2 * big), ("en", "p q", big)],
                                  "lang string, phrase string, n long")
    assert phrases.collocations(found).first()["score"] == 1000000 * big * big // ((3 * big + 1) * 2 * big)


def test_whole_table_against_duckdb(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    docs = spark.read.parquet(path).selectExpr("*", "1 AS phrase", "2 AS n", "3 AS w")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}')")
    want = sorted(con.execute(phrases.ORACLE).fetchall())
    assert sorted(map(tuple, phrases.mine(docs).collect())) == want and len(want) > 100


def test_empty(spark):
    assert phrases.mine(table(spark, [])).count() == 0
    assert phrases.mine(table(spark, [("en", None)])).count() == 0
