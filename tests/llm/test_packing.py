import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adspark.llm import packing
from adspark.llm.tokens import spaced_words, tokenizer, word_ids

from .helpers import AWKWARD, docs

VOCAB = public_tokenizers.path("byte_bpe_50k.json")
ODD = st.text(alphabet=st.sampled_from(list("ab'sSt ., \n\t\r\x0b\x1c\x85  　é日1２́<|>\U0001f600")), max_size=60)


def whole(text):
    return np.array(tokenizer(VOCAB).encode(text, add_special_tokens=False).ids + [0], dtype="<u4").tobytes()


@settings(max_examples=400, deadline=None)
@given(ODD)
def test_word_cache_equals_the_library(text):
    assert "".join(spaced_words(text)) == text
    assert word_ids(VOCAB).encode([text, "a " + text])[0] + b"\0\0\0\0" == whole(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=0x24F), max_size=40), st.text(st.characters(exclude_categories=["Cs"]), max_size=10))
def test_merging_by_rank_equals_the_library(latin, other):
    words = word_ids(VOCAB)
    words.known.clear()
    for text in (latin, f"a {latin} {other}", f"{latin}<|endoftext|> {latin}"):
        assert words.encode([text])[0] + b"\0\0\0\0" == whole(text)


def test_special_string_inside_text():
    text = "a <|endoftext|>b <|endoftext|> c"
    assert word_ids(VOCAB).encode([text])[0] + b"\0\0\0\0" == whole(text)


def test_cut():
    assert packing.cut(1, 4) == [(0, 1)] and packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_best_fit_takes_the_tightest_and_closes_the_fullest():
    b = packing.BestFit(10, bound=2)
    assert [b.place(6), b.place(7), b.place(3), b.place(4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    b = packing.BestFit(10, bound=2)
    assert [b.place(9), b.place(8), b.place(7), b.place(1), b.place(2)] == [(0, 0), (1, 0), (2, 0), (1, 8), (2, 7)]
    with pytest.raises(ValueError):
        b.place(11)


def check_packed(rows, expected, limit=packing.SEQ_LEN):
    bins = defaultdict(list)
    seen = defaultdict(list)
    for r in rows:
        assert 1 <= r["length"] <= limit
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        seen[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    want = defaultdict(list)
    for doc, ids in expected:
        n = len(ids) // 4
        first = n % limit or min(n, limit)
        marks = [0, *range(first, n + 1, limit)]
        for k, (a, b) in enumerate(zip(marks, marks[1:])):
            want[doc].append((k, a, b - a, zlib.crc32(ids[4 * a:4 * b])))
    assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in want.items()}
    return len(bins)


def test_every_document_is_packed_once(spark):
    rows = packing.best_fit_packing(docs(spark, AWKWARD), VOCAB).collect()
    check_packed(rows, [(r[0], whole(r[1] or "")) for r in AWKWARD])


def test_few_sequences_on_the_test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.best_fit_packing(table, VOCAB).collect()
    n = check_packed(rows, [(r["doc_id"], whole(r["text"] or "")) for r in table.collect()])
    assert n <= 1.02 * sum(r["length"] for r in rows) / packing.SEQ_LEN + 1


def test_empty_table(spark):
    assert packing.best_fit_packing(docs(spark, []), VOCAB).count() == 0
