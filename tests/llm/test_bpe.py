import hashlib

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from adspark.llm import bpe
from adspark.llm.tokens import tokenizer

from .helpers import AWKWARD, docs

VOCAB = public_tokenizers.path("word_bpe_49k.json")
ODD = list("abtheinrS'sdl.,-!#12éÉ日́ \U0001f600ǅßİ<|>")


def ids_of(text):
    return tokenizer(VOCAB).encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(ODD), max_size=300), st.integers(1, 40))
def test_tree_concatenation_equals_the_library(text, leaf):
    assert bpe.encode_long(tokenizer(VOCAB), [text, text[::-1]], leaf) == [ids_of(text), ids_of(text[::-1])]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="thein", min_size=50, max_size=600), st.integers(3, 60))
def test_unsplit_letters(text, leaf):
    assert bpe.encode_long(tokenizer(VOCAB), [text], leaf) == [ids_of(text)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(ODD + list(" \n\t\r\x0b\x85 \x1c")), max_size=80))
def test_codec_equals_the_library(text):
    (ids, decoded), = bpe.codec(VOCAB).encode([text])
    want = ids_of(text)
    assert ids == " ".join(map(str, want))
    assert decoded == tokenizer(VOCAB).decode(want, skip_special_tokens=False)


def test_long_runs():
    for text in ("a" * 10_000, "ab" * 7_001, "<|endoftext|>" * 900, "é" * 4_000, "the" * 5_000 + "!" * 3_000,
                 "x1" * 5_000, "日本" * 3_000):
        assert bpe.codec(VOCAB).encode([text])[0][0] == " ".join(map(str, ids_of(text)))


def test_documents(spark):
    got = bpe.encode_documents(docs(spark, AWKWARD), VOCAB, digests=True).collect()
    want = []
    for doc, text, *_ in AWKWARD:
        ids = ids_of(text or "")
        sha = [hashlib.sha256(s.encode()).hexdigest()
               for s in (" ".join(map(str, ids)), tokenizer(VOCAB).decode(ids, skip_special_tokens=False))]
        want.append((doc, len(ids), *sha))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert bpe.encode_documents(docs(spark, []), VOCAB).columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert bpe.encode_documents(docs(spark, []), VOCAB).count() == 0
