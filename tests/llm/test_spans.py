import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2 as proto

from adspark.llm import spans

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "a", "  a", "a  b ", "▁x▁", "▁▁", "a\x00b", "�", "\U0001f600é \U0001f600", "<s> </s> <unk> <0x41>",
       "\n\n a\t b\r\n", "ｆ ﬁn ¨x 　y", "é é̂ 각", "Ω x  y", "x" * 5000,
       "日本語 文本" * 50, "ΐ̈́ ẛ̣", "   ", "tail   "]


def variant(rule: str, **flags) -> bytes:
    """The public model under another character map and other white space flags."""
    m = proto.ModelProto()
    m.ParseFromString(open(MODEL, "rb").read())
    if rule != "identity":
        spec = proto.NormalizerSpec()
        raw = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
        whole = proto.ModelProto()
        whole.ParseFromString(raw)
        spec.CopyFrom(whole.normalizer_spec)
        m.normalizer_spec.precompiled_charsmap = spec.precompiled_charsmap
        m.normalizer_spec.name = rule
    for k, v in flags.items():
        setattr(m.normalizer_spec, k, v)
    return m.SerializeToString()


CASES = {"own": variant("identity"), "nfkc": variant("nfkc"), "nmt": variant("nmt_nfkc_cf", remove_extra_whitespaces=True),
         "squeezed": variant("identity", remove_extra_whitespaces=True), "bare": variant("nfkc", add_dummy_prefix=False)}
PAIRS = {k: (spans.PieceCodec(m), sentencepiece.SentencePieceProcessor(model_proto=m)) for k, m in CASES.items()}


def same(kind: str, text: str) -> None:
    own, lib = PAIRS[kind]
    ids, begins, ends, listed, decoded = own.encode([text])[0]
    want = lib.encode(text)
    assert ids.tolist() == want and listed == ",".join(map(str, want))
    assert decoded == lib.decode(want)
    pieces = lib.encode(text, return_type="proto").pieces
    assert list(zip(begins.tolist(), ends.tolist())) == [(p.begin, p.end) for p in pieces]


@pytest.mark.parametrize("kind", CASES)
@pytest.mark.parametrize("text", ODD)
def test_odd_texts_equal_the_library(kind, text):
    same(kind, text)


@pytest.mark.parametrize("kind", CASES)
@settings(max_examples=150, deadline=None)
@given(text=st.text(st.characters(exclude_categories=["Cs"]), max_size=40) | st.text("ab ▁é́ﬁ　가가", max_size=30))
def test_random_texts_equal_the_library(kind, text):
    same(kind, text)


def test_a_full_memory_changes_nothing(monkeypatch):
    own, lib = spans.PieceCodec(CASES["own"]), PAIRS["own"][1]
    monkeypatch.setattr(spans, "KNOWN_PARTS", 3)
    for text in ["one two three four", "five six", "one two", "w" * 200 + " one"] * 2:
        assert own.encode([text])[0][0].tolist() == lib.encode(text)


def test_other_models_are_refused():
    m = proto.ModelProto()
    m.ParseFromString(CASES["own"])
    m.trainer_spec.byte_fallback = False
    with pytest.raises(ValueError):
        spans.PieceCodec(m.SerializeToString())


def test_whole_table_against_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lib = PAIRS["own"][1]
    got = {r["doc_id"]: r for r in spans.encode_documents(docs, MODEL, digests=True).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = lib.encode(r["text"])
        g = got[r["doc_id"]]
        assert g["n_tokens"] == len(ids) and g["covered_bytes"] == len(r["text"].encode())
        assert g["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert g["decoded_sha256"] == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


def test_cases(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "a b", "x"), (3, "a b", None), (3, "a b", None)],
                                 "doc_id long, text string, ids_sha256 string")
    got = spans.encode_documents(docs, MODEL)
    rows = sorted(got.collect(), key=str)
    assert len(rows) == 5 and [r["ids"] for r in rows if r["doc_id"] in (1, 2)] == [[], []]
    assert [(r["begins"], r["ends"], r["decoded"]) for r in rows if r["doc_id"] not in (1, 2)] == [([0, 1], [1, 3], "a b")] * 3
    assert spans.encode_documents(docs.limit(0), MODEL).count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    one = spans.encode_documents(docs.filter("doc_id = 1"), MODEL, digests=True).first()
    assert one["ids_sha256"] == one["decoded_sha256"] == empty and one["covered_bytes"] == 0
