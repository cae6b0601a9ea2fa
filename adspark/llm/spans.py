"""SentencePiece encoding and decoding (operator 13) with spans in the original bytes.

Normalisation is done here, by the model's compiled character map: at each place the longest
prefix that the map holds is replaced, any other character stands for itself, and every
normalised character keeps the byte of the text at which the replaced prefix began.  Spaces
become U+2581 and the model's prefix is put before the text.  The normalised text is cut where a
U+2581 follows another character, which no piece of the vocabulary spans (checked when the
model is loaded; else it is not cut), so its pieces are those of the cut parts in order; each
worker keeps the pieces of the parts that it has met (bounded; emptied when full).  The pieces'
lengths in normalised characters then project every piece to its bytes of the text: of a
character that falls back to bytes, the last byte's piece holds the whole span, the ones before
are empty, as in the library.

Cases: null text encodes as empty: no ids, digests of the empty string.  Control symbols'
strings inside a text are ordinary text.  Repeated rows and doc_ids give a row each.  An empty
table gives no rows.  Extra columns are ignored, whatever their names.  A text of any length is
encoded whole; one without a space is a single part.  Models without byte fallback, with
user-defined symbols or of another kind than BPE are refused.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspark.llm.common import map_rows

SPACE = "▁"        # stands for a space in pieces
KNOWN_PARTS = 300_000   # parts kept by a worker; reaching it empties the memory, results do not change
KNOWN_CHARS = 64        # longer parts are encoded each time

_PARTS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class CharMap:
    """A compiled character map: a double-array trie over UTF-8 and the replacements.

    Fixed values of the format: 4 bytes of the trie's size, the trie's 32-bit units, then the
    replacements, each ended by a zero byte.  A unit holds its label in the low 8 bits, whether
    a value follows in bit 8, and the distance to its children from bit 9 on; a value's unit
    holds the replacement's place in its low 31 bits."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4:4 + size], dtype="<u4").tolist()
        self.texts = blob[4 + size:]
        first = bytes(b for b in range(256) if self.units and self._child(self._below(self.units[0]), b) is not None)
        # where a replaced prefix can begin
        self.starts = re.compile(b"[" + re.escape(first) + b"]") if first else None

    @staticmethod
    def _below(unit: int) -> int:
        return (unit >> 10) << (8 if unit & 0x200 else 0)

    def _child(self, at: int, byte: int) -> int | None:
        k = at ^ byte
        return k if k < len(self.units) and self.units[k] & 0x800000FF == byte else None

    def longest(self, data: bytes, at: int) -> tuple[int, str] | None:
        """End of the longest prefix at ``at`` that the map holds, and its replacement."""
        found, node = None, self._below(self.units[0])
        for end in range(at, len(data)):
            k = self._child(node, data[end])
            if k is None:
                break
            node = k ^ self._below(self.units[k])
            if self.units[k] & 0x100:
                found = end + 1, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        place = found[1]
        return found[0], self.texts[place:self.texts.index(b"\0", place)].decode()

    def skip_spaces(self, data: bytes) -> int:
        """Where the prefixes at the beginning that stand for one space each end."""
        at = 0
        while at < len(data):
            end, text = self.longest(data, at) or (at + 1, chr(data[at]))
            if text != " ":
                break
            at = end
        return at

    def rewrite(self, data: bytes) -> tuple[str, list[int]]:
        """The replaced text and the byte at which each of its characters began."""
        out: list[str] = []
        begins: list[int] = []
        at = 0

        def plain(upto: int) -> None:
            out.append(data[at:upto].decode())
            begins.extend(i for i in range(at, upto) if data[i] & 0xC0 != 0x80)

        while at < len(data):
            hit = self.starts.search(data, at) if self.starts else None
            if hit is None:
                plain(len(data))
                break
            plain(hit.start())
            at = hit.start()
            got = self.longest(data, at)
            if got is None:
                end = at + 1
                while end < len(data) and data[end] & 0xC0 == 0x80:
                    end += 1
                plain(end)
                at = end
            else:
                out.append(got[1])
                begins.extend([at] * len(got[1]))
                at = got[0]
        return "".join(out), begins


class Normalizer:
    """Texts as the model sees them, with the byte of the text for every character."""

    def __init__(self, spec):
        self.map = CharMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.prefix, self.squeeze, self.escape = (spec.add_dummy_prefix, spec.remove_extra_whitespaces,
                                                  spec.escape_whitespaces)

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its characters, the byte where what it stands
        for begins; one entry more gives the end."""
        data = text.encode()
        end = len(data)
        if self.map is None:
            begins = np.flatnonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)
        else:
            text, begins = self.map.rewrite(data)
            begins = np.array(begins, dtype=np.int64)
        space = SPACE if self.escape else " "
        if self.squeeze and text:
            # of a run of spaces the first stays, but for the one that begins the text
            keep = [k for k, c in enumerate(text) if c != " " or (k and text[k - 1] != " ")]
            head = self.map.skip_spaces(data) if self.map else begins[keep[0]] if keep else end
            text, begins = "".join([text[k] for k in keep]), begins[keep]
        else:
            head = 0
        if not text:
            return "", np.array([end], dtype=np.int64)
        if self.escape:
            text = text.replace(" ", SPACE)
        if self.prefix:
            text, begins = space + text, np.concatenate(([head], begins))
        if self.squeeze:
            left = len(text.rstrip(space))
            if left < len(text):
                end = int(begins[left])
                text, begins = text[:left], begins[:left]
        return text, np.concatenate((begins, [end]))


class PieceCodec:
    """Pieces, spans and decoded text of whole texts under a SentencePiece BPE model."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(model)
        kinds = proto.ModelProto.SentencePiece
        if spec.trainer_spec.model_type != proto.TrainerSpec.BPE or not spec.trainer_spec.byte_fallback \
                or spec.trainer_spec.treat_whitespace_as_suffix or spec.denormalizer_spec.precompiled_charsmap \
                or any(p.type == kinds.USER_DEFINED for p in spec.pieces):
            raise ValueError("a BPE model with byte fallback and without user-defined symbols is needed")
        self.normalize = Normalizer(spec.normalizer_spec)
        pieces = [p.piece for p in spec.pieces]
        self.alone = pieces.index(SPACE) if SPACE in pieces else -1
        self.cuts = SPACE in pieces and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        bytes_ = np.array([int(p.piece[1:-1], 16) if p.type == kinds.BYTE else -1 for p in spec.pieces])
        self.is_byte, self.continues = bytes_ >= 0, (bytes_ >= 0x80) & (bytes_ < 0xC0)
        self.lengths = np.where(self.is_byte, 0, [len(p) for p in pieces])
        # the library's merges on text that is normalised already
        for flag in ("add_dummy_prefix", "remove_extra_whitespaces", "escape_whitespaces"):
            setattr(spec.normalizer_spec, flag, False)
        spec.normalizer_spec.precompiled_charsmap = b""
        spec.normalizer_spec.name = "identity"
        self.inner = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.upto, self.listed, self.decoded = array("i"), array("q", [0]), [], []

    def _learn(self, parts: list[str]) -> None:
        found = self.inner.encode(parts, num_threads=1)
        n = len(self.listed)
        self.known.update(zip(parts, range(n, n + len(parts))))
        self.decoded += self.inner.decode(found, num_threads=1) if found else []
        for ids in found:
            self.ids.extend(ids)
            self.upto.append(len(self.ids))
            self.listed.append(",".join(map(str, ids)))

    def _split(self, text: str) -> list[str]:
        if not self.cuts:
            return [text] if text else []
        if SPACE * 2 in text or text[:1] != SPACE:
            return _PARTS.findall(text)
        return [SPACE + w for w in text[1:].split(SPACE)]

    def _spans(self, ids: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end byte of each piece."""
        last = np.ones(len(ids), dtype=bool)  # of a character's bytes
        last[:-1] = ~self.continues[ids[1:]]
        upto = np.cumsum(np.where(self.is_byte[ids], last, self.lengths[ids]))
        ends = begins[upto]
        return np.concatenate((begins[:1], ends[:-1]))[:len(ids)], ends

    def _unprefixed(self, ids: np.ndarray, text: str) -> str:
        """The decoded text without the model's prefix: the space that begins the first piece
        (where runs of spaces are dropped, pieces of one space alone go before it)."""
        if not (self.normalize.prefix or self.normalize.squeeze):
            return text
        if self.normalize.squeeze:
            alone = int(np.argmax(ids != self.alone)) if (ids != self.alone).any() else len(ids)
            text = text[alone:]
        return text.removeprefix(" ")

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, str, str]]:
        """``(ids, first bytes, end bytes, ids as text, decoded text)`` of each text."""
        normal = [self.normalize(t) for t in texts]
        split = [self._split(t) for t, _ in normal]
        if len(self.known) > KNOWN_PARTS:
            self._forget()
        self._learn(list(set(chain.from_iterable(split)).difference(self.known)))
        every, upto = np.array(self.ids, dtype=np.int32), np.array(self.upto, dtype=np.int64)
        out = []
        for parts, (_, begins) in zip(split, normal):
            at = list(map(self.known.__getitem__, parts))
            where = np.array(at, dtype=np.int64)
            first, sizes = upto[where], upto[where + 1] - upto[where]
            before = np.cumsum(sizes) - sizes
            ids = every[np.repeat(first - before, sizes) + np.arange(int(sizes.sum()))]
            text = "".join(map(self.decoded.__getitem__, at))
            out.append((ids, *self._spans(ids, begins), ",".join(map(self.listed.__getitem__, at)),
                        self._unprefixed(ids, text)))
        for p in {p for parts in split for p in parts if len(p) > KNOWN_CHARS}:
            del self.known[p]
        return out


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """The codec of the model file at ``path``, loaded once in a worker."""
    if path not in _CODECS:
        with open(path, "rb") as f:
            _CODECS[path] = PieceCodec(f.read())
    return _CODECS[path]


def encode_documents(docs: DataFrame, model: str, digests: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids, begins, ends, decoded`` per row; ``begins`` and ``ends`` are
    the pieces' places in the UTF-8 bytes of the text.  With ``digests`` the ids and the decoded
    text give way to SHA-256 digests, the spans to the bytes they cover and a CRC-32."""
    def run(rows: dict[str, list]) -> dict[str, list]:
        found = codec(model).encode([t or "" for t in rows["text"]])
        out = {"doc_id": rows["doc_id"], "n_tokens": [len(ids) for ids, *_ in found]}
        if not digests:
            return out | {"ids": [x[0] for x in found], "begins": [x[1] for x in found], "ends": [x[2] for x in found],
                          "decoded": [x[4] for x in found]}
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return out | {"ids_sha256": [sha(x[3]) for x in found], "decoded_sha256": [sha(x[4]) for x in found],
                      "covered_bytes": [int((x[2] - x[1]).sum()) for x in found],
                      "spans_crc32": [zlib.crc32(np.stack((x[1], x[2]), 1).astype("<i8").tobytes()) for x in found]}

    kinds = ("ids_sha256 string, decoded_sha256 string, covered_bytes bigint, spans_crc32 bigint" if digests else
             "ids array<int>, begins array<bigint>, ends array<bigint>, decoded string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_rows(rows, run, f"doc_id bigint, n_tokens bigint, {kinds}", 256)
