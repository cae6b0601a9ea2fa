import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from adspark.llm import secrets

from .helpers import AWKWARD, docs

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ODD = ["password=abcdef", "password=abcde", "xPassWord' : \"hunter2hunter\" é token=aa secret:  zzzzzz",
       "secret=token: abcdef123", "token==abc123 token=token=abcdef", "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + "AKIA",
       "AKIAAKIA" + "Z9" * 10, "é" * 5 + "deadbeef" * 3 + "x" + "a" * 23 + "g" + "0" * 24, "api_key=AKIA" + "0" * 20 + "\n" + "f" * 30,
       "APIKEY = " + "a1" * 20 + "," + "apikey:'" + "b2" * 20 + "'", "password = \n abcdefgh", "token:" + " " * 500 + "abcdefg"]


def base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def listed(spans):
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def corpus(n=60):
    r = random.Random(3)
    words = ["identifier", "configuration", "getElementById", "max_connection_count", "DocumentRoot", "background-color"]
    rows = []
    for i in range(n):
        text = " ".join(r.choice(words) for _ in range(80))
        if i % 3 == 0:
            text += " password=" + "".join(r.choice("abcdefghijkmnpqrstuvwxyzABCDEFGH0123456789") for _ in range(24))
        rows.append((i, text, "en", "s", len(text)))
    return rows


def check(rows, got):
    want = sorted(((d, *(sum(k == n for _, k, _ in base(t or "")) for n in range(3)),
                    hashlib.sha256(listed(base(t or "")).encode()).hexdigest()) for d, t, *_ in rows), key=repr)
    assert sorted((tuple(r)[:5] for r in got), key=repr) == want


def test_base_spans(spark):
    rows = AWKWARD + [(100 + i, t, None, None, None) for i, t in enumerate(ODD)] + \
        [(300 + i, " ".join(random.Random(i).choices(ODD, k=20)), None, None, None) for i in range(10)]
    check(rows, secrets.scan(docs(spark, rows)).collect())


def test_test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check([(r["doc_id"], r["text"]) for r in table.collect()], secrets.scan(table).collect())


def test_models_find_an_unlabelled_random_string(spark):
    key = "q7Gd9xKw2LmZ4pTs8VbN3cRf"
    rows = corpus() + [(900, f"é the value {key} stands alone", "en", "s", 1), (901, "ordinaryIdentifierName max_connection_count_2",
                                                                          "en", "s", 1)]
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(docs(spark, rows)).collect()}
    assert got[900] == f"markov:12:{12 + len(key)}" and got[901] == ""
    assert all(got[i] == listed(base(t)) for i, t, *_ in corpus())


def test_keys_without_a_digit(spark):
    """A random key need not have a digit; long ordinary words and rulers stay."""
    keys = ["qGdvxKwCLmZHpTsBVbNgcRfA", "qGdvxBwHkmEhpCsA"]
    clean = "Donaudampfschifffahrtsgesellschaft internationalization AbstractSingletonProxyFactoryBean 2024-01-01-2024-01-30"
    rows = corpus() + [(900 + i, f"the value {k} stands alone", "en", "s", 1) for i, k in enumerate(keys)] + \
        [(950, f"{clean} {'=' * 30} {'-' * 30} {'_' * 30} " * 20, "en", "s", 1)]
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(docs(spark, rows)).collect()}
    assert [got[900 + i] for i in range(2)] == [f"markov:10:{10 + len(k)}" for k in keys]
    assert got[950] == "" and all(got[i] == listed(base(t)) for i, t, *_ in corpus())


def test_no_sample_adds_nothing(spark):
    assert secrets.scan(docs(spark, [(1, "a1B2" * 10, None, None, None)])).collect()[0]["spans"] == ""
    assert secrets.scan(docs(spark, [])).count() == 0


def test_redact(spark):
    rows = AWKWARD + [(500, "é token=abcdef0123456789abcdef01 and AKIA" + "Q" * 16 + "!", "en", "s", 7)]
    table = docs(spark, rows)
    out = secrets.redact(table)
    assert out.columns == table.columns and out.dtypes == table.dtypes
    got = {(r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()}
    assert (500, "é [secret] and [secret]!", 24) in got
    assert {(r[0], r[1], r[4]) for r in AWKWARD} <= got


def masked(text):
    """The text with what the base kinds find blanked, one kind after another."""
    blank = lambda m: " " * len(m[0])
    text = ASSIGN.sub(lambda m: blank(m) if len(m[2]) >= 6 else m[0], text)
    text = re.sub("AKIA[A-Z0-9]+", lambda m: blank(m) if len(m[0]) >= 20 else m[0], text)
    return re.sub("[0-9a-f]{24,}", blank, text)


def token_class(t):
    return 1 if re.search("[A-Za-z]", t) else 0


def models(texts):
    """The two models and the limits, from every text."""
    seen = (Counter(), Counter())
    for t in texts:
        for v in [m[2] for m in ASSIGN.finditer(t)] + re.findall("AKIA[A-Z0-9]+", t) + re.findall("[0-9a-f]{24,}", t):
            if len(v) >= 8:
                seen[1][v] += 1
        seen[0].update(re.findall("[A-Za-z0-9+/_=-]{8,}", masked(t)))
    pairs, first, second = ([Counter(), Counter()] for _ in range(3))
    for k in (0, 1):
        for t, n in seen[k].items():
            for a, b in zip(t, t[1:]):
                pairs[k][a, b] += n
                first[k][a] += n
                second[k][b] += n

    def log(k, a, b):
        alone = (second[k][b] + 1) / (sum(second[k].values()) + 66)
        return math.log((pairs[k][a, b] + 200 * alone) / (first[k][a] + 200))

    ratio = {}

    def mean(t):
        for p in zip(t, t[1:]):
            if p not in ratio:
                ratio[p] = round(log(1, *p) - log(0, *p), 4)
        return sum(ratio[p] for p in zip(t, t[1:])) / len(t)

    long = {k: {t: n for t, n in seen[k].items() if len(t) >= 16 and re.search("[0-9A-Za-z]", t)} for k in (0, 1)}
    limits = []
    for c in range(2):
        own = {t: n for t, n in long[0].items() if token_class(t) == c}
        random_ones = {t: n for t, n in long[1].items() if token_class(t) == c}
        if sum(long[1].values()) < 20 or (sum(own.values()) < 20 and sum(random_ones.values()) < 20):
            limits.append(math.inf)
            continue
        own = own if sum(own.values()) >= 20 else long[0]
        means = lambda some: [round(mean(t), 2) for t, n in some.items() for _ in range(n)]
        high = np.percentile(means(own), 99.9) + 0.1 if own else 0.1
        limits.append(max(0.1, high))
    return mean, limits


def markov(text, mean, limits):
    return [(m.start(), 3, m.end()) for m in re.finditer("(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}", masked(text))
            if re.search("[0-9A-Za-z]", m[0]) and mean(m[0]) >= limits[token_class(m[0])]]


@pytest.mark.parametrize("where", ["made", "sf0.01"])
def test_ratios_limits_and_spans_against_brute_force(spark, where):
    if where == "made":
        rows = [r[:2] for r in corpus()] + [(900, "q7Gd9xKw2LmZ4pTs8VbN3cRf AND a1B2c3D4e5F6g7H8 " + "1234567890123456 " * 30)]
        table = docs(spark, [(*r, "en", "s", 1) for r in rows])
    else:
        table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
        rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    mean, limits = models([t for _, t in rows])
    got_table, got_limits = secrets.train(table)
    assert got_limits == pytest.approx(limits)
    for a, b in ["ab", "A9", "zq", "__", "07"]:
        assert abs(got_table[ord(a) * 128 + ord(b)] - mean(a + b) * 2) < 1e-6
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(table).collect()}
    assert got == {d: listed(sorted(base(t) + markov(t, mean, limits))) for d, t in rows}
    assert where != "made" or "markov" in got[900]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_ordinary_numbers_stay(spark, sf):
    table = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in table.select("doc_id", "text").collect()}
    spans = [s.split(":") + [r["doc_id"]] for r in secrets.scan(table).collect() for s in r["spans"].split(",") if "markov" in s]
    assert not [s for s in spans if texts[s[3]][int(s[1]):int(s[2])].isdigit()]


def test_models_are_trained_on_every_document(spark):
    """Rows of 12,000 documents: each counts, in the ratios and in the limits."""
    r = random.Random(5)
    word = lambda: "".join(r.choices("abcdefghijklmnopqrstuvwxyz_", k=r.randint(8, 20)))
    rows = [(i, f"{word()} {word()}" + (f" token={word().upper()}{i}" if i % 50 == 0 else "")) for i in range(12_000)]
    mean, limits = models([t for _, t in rows])
    table, least = secrets.train(docs(spark, rows, extra=False))
    assert least == pytest.approx(limits)
    pairs = [a + b for a in "abcxyz_" for b in "abcxyz_"]
    assert [table[ord(a) * 128 + ord(b)] for a, b in pairs] == pytest.approx([2 * mean(p) for p in pairs], abs=2e-4)
