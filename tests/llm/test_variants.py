import random
import re
import zlib
from collections import Counter, defaultdict

from adspark.llm import variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans(variants._UPPER, variants._LOWER)


def counted(rows):
    seen = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def near_by_strings(words):
    """Near words by masked and shortened strings."""
    masks, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            masks[w[:i] + "*" + w[i + 1:]].add(w)
            v = w[:i] + w[i + 1:]
            if v in words:
                near[w].add(v)
                near[v].add(w)
    for group in masks.values():
        for w in group:
            near[w] |= group - {w}
    return near


def expected(n, near):
    form = {}
    for w in n:
        top = min(near.get(w, ()), key=lambda v: (-n[v], v), default=None)
        form[w] = top if top is not None and n[top] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near.get(w, ())), n[form[w]] if form[w] is not None else None))
    return sorted(out, key=str)


def got(spark, rows, partitions=5):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, variants.group_variants(docs.repartition(partitions)).collect()), key=str)


def test_random_words_against_all_comparisons(spark):
    rng = random.Random(7)
    for _ in range(3):
        stems = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(25)]
        words = set(stems)
        for w in stems:
            for _ in range(4):
                i, c = rng.randrange(len(w) + 1), rng.choice("abéz")
                words.add(rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:]]))
        words = sorted(words)
        rows = [(d, " ".join(rng.choice(words).upper() if d % 7 == 0 else rng.choice(words) for _ in range(60)))
                for d in range(40)]
        rows += [(100, " ".join([words[k]] * 900)) for k in (3, 11)] + [(101, " ".join([words[5]] * 60))]
        n = counted(rows)
        near = {a: {b for b in n if one_apart(a, b)} for a in n}
        assert near == {a: near_by_strings(n).get(a, set()) for a in n}
        assert got(spark, rows) == expected(n, near)


def test_chains_runs_of_equal_letters_and_long_words(spark):
    long = "x" * 3000
    rows = [(1, " ".join(["aaaaaaa"] * 2 + ["aaaaaaab"] * 20 + ["aaaaaaabb"] * 200 + ["aaaaaaabbc"] * 2000)),
            (2, " ".join(["zzzzzzz", "zzzzzzzz"] * 20 + [long, long + "x", long[1:] + "y"] * 2)), (3, None), (None, ""),
            (None, "aaaaaaa À×÷abcd! À×÷abcd"), (4, "1short2 " * 5)]
    n = counted(rows)
    assert len(n) > 6
    result = got(spark, rows)
    assert result == expected(n, near_by_strings(n))
    assert any(r[1] is not None and r[2] != r[1] for r in result)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    n = counted([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    want = expected(n, near_by_strings(n))
    clash = docs.selectExpr("*", "1 AS word", "2 AS n", "3 AS word_id", "4 AS run")
    assert sorted(map(tuple, variants.group_variants(clash).collect()), key=str) == want
    assert sum(r[1] is not None for r in want) > 10


def test_nodes_are_numbered_alike_over_any_partitions(spark):
    words = sorted({w for w in ("abcdefg abcdefh abcxyzz abd b bcdefgh bcdefgi c" * 3).split()})
    table = spark.createDataFrame([(w,) for w in words], "word string")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    try:
        rows = variants.number_nodes(table, "word", "pre", "word_id").orderBy("word_id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert [r["word"] for r in rows] == words
    owner = defaultdict(set)
    for r in rows:
        for depth, node in enumerate(r["pre"], 1):
            owner[node].add(r["word"][:depth])
    assert all(len(x) == 1 for x in owner.values()) and len(set().union(*owner.values())) == len(owner)
    for r in rows:  # as deep as another word goes
        assert len(r["pre"]) == max([variants._common(r["word"], w) for w in words if w != r["word"]], default=0)


def test_empty(spark):
    assert got(spark, [(1, None)]) == [] == got(spark, [])
