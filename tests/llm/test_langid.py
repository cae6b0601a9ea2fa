import base64
import random
import zlib

import numpy as np

from adspark.llm import langid

from .helpers import AWKWARD, docs


def naive(text):
    gap = "".join(c if c.isalpha() else " " for c in text.lower())
    padded = f" {' '.join(gap.split())} " if gap.split() else " "
    return sum(len(w) for w in gap.split()), sum(max(0, len(padded) - n + 1) for n in (2, 3))


def test_ngrams_over_slices(monkeypatch):
    texts = ["", "a", "Hello, wörld!  x", "日本語 text 123 ...", " ".join(["abc"] * 500), "!!!", "a" * 40]
    whole = [langid.ngram_counts(t) for t in texts]
    for t, (counts, letters) in zip(texts, whole):
        n, grams = naive(t)
        assert letters == n and counts.sum() == n + grams
    for size in (1, 2, 3, 7):
        monkeypatch.setattr(langid, "SLICE", size)
        for t, (counts, letters) in zip(texts, whole):
            got = langid.ngram_counts(t)
            assert got[1] == letters and (got[0] == counts).all()


def test_held_out_accuracy(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = langid.op2(table).join(table.select("doc_id", "lang", "text"), "doc_id").collect()
    out = [r for r in got if r["held_out"] and r["lang"] is not None and r["lang_pred"] != "und"]
    assert len(got) == table.count() and len(out) > 1000
    assert np.mean([r["lang_pred"] == r["lang"] for r in out]) > 0.97
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert sum(r["rejected"] for r in got if r["lang_pred"] != "und") < 0.01 * len(got)


def test_foreign_text_is_rejected(spark):
    rows = [(i, "the quick brown fox jumps over the lazy dog and the cat " * 3, "en", None, None) for i in range(60)]
    rows += [(100 + i, "der schnelle braune fuchs springt über den faulen hund " * 3, "de", None, None) for i in range(60)]
    model = langid.fit(docs(spark, rows))
    pred, score, rejected = model.predict(["the dog and the fox", "быстрая лиса прыгает через ленивую собаку", None, "123", ""])
    assert pred[0] == "en" and not rejected[0] and rejected[1:] == [True] * 4 and pred[2:] == ["und"] * 3
    assert score[2:] == [0.0] * 3 and model.languages == ["de", "en"]


def test_awkward_rows(spark):
    got = langid.op2(docs(spark, AWKWARD)).collect()
    assert sorted((r["doc_id"] for r in got), key=repr) == sorted((r[0] for r in AWKWARD), key=repr)
    by = {r["doc_id"]: r for r in got}
    assert [by[k]["lang_pred"] for k in (1, 2, 3, 8)] == ["und"] * 4
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert langid.op2(docs(spark, [])).count() == 0
    unlabelled = langid.op2(docs(spark, [(1, "some text", None, None, None)])).collect()
    assert [tuple(r) for r in unlabelled] == [(1, False, "und", 0.0, True)]


def naive_vector(text, idf):
    """sqrt(count) x IDF of the hashed grams, of length one, gram by gram."""
    gap = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())
    if not gap:
        return None
    padded = f" {gap} "
    grams = [c for c in gap if c != " "] + [padded[i:i + n] for n in (2, 3) for i in range(len(padded) - n + 1)]
    v = np.zeros(langid.DIMS)
    for g in grams:
        h = len(g)
        for k, c in enumerate(reversed(g)):
            h += ord(c) * 31 ** k
        h = h * 2654435761 & 0xFFFFFFFF
        v[(h ^ h >> 15) & (langid.DIMS - 1)] += 1
    v = np.sqrt(v) * idf
    return v / np.linalg.norm(v)


def test_prediction_against_naive_nearest_centroid(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(table)
    texts = [r["text"] for r in table.limit(300).collect()] + ["Ünïcode Straße ÉCOLE", "x", "", "1 2 3"]
    pred, score, rejected = model.predict(texts)
    for text, p, s, no in zip(texts, pred, score, rejected):
        v = naive_vector(text, model.idf)
        if v is None:
            assert (p, s, no) == ("und", 0.0, True)
            continue
        near = [float(v @ c) for c in model.centroids]
        k = int(np.argmax(near))
        assert abs(s - near[k]) < 1e-4
        top = sorted(near)[-2:]
        assert p == model.languages[model.language[k]] or top[1] - top[0] < 1e-4
        limit = model.limits[model.language[k]] * min(1.0, np.sqrt(sum(c.isalpha() for c in text.lower()) / langid.REJECT_CHARS))
        assert no == (s < limit) or abs(s - limit) < 1e-4


def test_random_and_unlearned_text_is_rejected(spark):
    """Text of the same script that is no learned language: random letters, base64, other languages."""
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.fit(table)
    r = random.Random(1)
    other = [" ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(n)) for n in (100, 500)]
    other += [base64.b64encode(r.randbytes(n)).decode() for n in (500, 3000)]
    other += ["Gallia est omnis divisa in partes tres quarum unam incolunt Belgae aliam Aquitani tertiam qui ipsorum lingua " * 3,
              "Litwo ojczyzno moja ty jestes jak zdrowie ile cie trzeba cenic ten tylko sie dowie kto cie stracil " * 3,
              "Korkma sonmez bu safaklarda yuzen al sancak sonmeden yurdumun ustunde tuten en son ocak " * 3,
              "Mieleni minun tekevi aivoni ajattelevi lahteani laulamahan saa ani sanelemahan sukuvirtta " * 3]
    assert all(model.predict(other)[2])
    texts = [x["text"] for x in table.filter("doc_id % 3 = 0").select("text").collect() if any(c.isalpha() for c in x["text"] or "")]
    assert sum(model.predict(texts)[2]) <= 0.001 * len(texts)


def test_many_languages_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 3)
    rows = [(i, f"text number {i} words", f"l{i % 40 if i > 60 else i % 3}", None, None) for i in range(200)]
    rows += [(900 + i, None if i % 2 else "123", "l99", None, None) for i in range(500)]  # no letter: nothing to learn
    model = langid.fit(docs(spark, rows))
    assert model.languages == ["l0", "l1", "l2"]
