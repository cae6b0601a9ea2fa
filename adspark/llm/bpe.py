"""BPE encoding and decoding (operator 6) with tree concatenation of long unsplit text.

No piece of the vocabulary's pre-tokenizer spans white space, so a text is the
concatenation of its space-delimited words and a join there agrees at once.  A word longer
than ``LEAF`` characters is unsplit text: it is halved down to leaves, the leaves are
encoded in parallel (one batch call over all leaves of the rows at hand), and neighbours
are joined level by level.  At a join the text around the cut is encoded again in a window
that grows until a run of its tokens agrees exactly (id and place) with the left half and
another with the right half; the left half up to its run, the window's tokens between, and
the right half from its run are then the encoding of the whole: BPE's choice at a border of
two tokens depends on these two alone.  A window that reaches the end of a half replaces it.

Cases: null text encodes as empty: no ids, digests of the empty string.  Special-token
strings inside a text are special tokens, as in the library.  Repeated rows and doc_ids
give a row each.  An empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspark.llm.common import map_rows
from adspark.llm.tokens import CACHE_CHARS, CACHE_WORDS, tokenizer

LEAF = 2048     # longest unsplit text encoded in one piece
WINDOW = 32     # first half-width of a window around a join
AGREE = 2       # tokens in a row that must be equal on a side

_SPACE = re.compile("[ \t\n\r]+")

Token = tuple[int, int, int]  # id, start, end


def _tokens(enc, at: int) -> list[Token]:
    return [(i, at + s, at + e) for i, (s, e) in zip(enc.ids, enc.offsets)]


def _clean(tokens: list[Token], k: int) -> bool:
    """The token covers whole characters: no neighbour shares one with it."""
    _, s, e = tokens[k]
    return e > s and (k == 0 or tokens[k - 1][2] <= s) and (k + 1 == len(tokens) or tokens[k + 1][1] >= e)


def _left_run(left: list[Token], win: list[Token]) -> tuple[int, int] | None:
    """Places in ``left`` and ``win`` just after the first agreeing run."""
    where = {t: i for i, t in enumerate(left)}
    for j in range(AGREE - 1, len(win)):
        i = where.get(win[j])
        if i is not None and i >= AGREE - 1 and left[i - AGREE + 1:i + 1] == win[j - AGREE + 1:j + 1] \
                and _clean(left, i) and _clean(win, j):
            return i + 1, j + 1
    return None


def _right_run(right: list[Token], win: list[Token], after: int) -> tuple[int, int] | None:
    """Places in ``right`` and ``win`` where the last agreeing run begins."""
    where = {t: i for i, t in enumerate(right)}
    for j in range(len(win) - AGREE, after - 1, -1):
        i = where.get(win[j])
        if i is not None and right[i:i + AGREE] == win[j:j + AGREE] and len(right) - i >= AGREE \
                and _clean(right, i) and _clean(win, j):
            return i, j
    return None


def _near(tokens: list[Token], lo: int, hi: int, from_end: bool) -> tuple[list[Token], int]:
    """The tokens of a half that lie inside ``[lo, hi)``, and the number before them."""
    if from_end:
        k = len(tokens)
        while k and tokens[k - 1][2] > lo:
            k -= 1
        return tokens[k:], k
    k = 0
    while k < len(tokens) and tokens[k][1] < hi:
        k += 1
    return tokens[:k], 0


def _join_level(tok, text_of, nodes: list[list]) -> list[list]:
    """One level of joins.  A node is ``[text no, start, end, tokens]``; neighbours of the
    same text are joined in pairs, an odd one goes up as it is."""
    pairs, up, k = [], [], 0
    while k < len(nodes):
        if k + 1 < len(nodes) and nodes[k][0] == nodes[k + 1][0]:
            up.append([nodes[k][0], nodes[k][1], nodes[k + 1][2], None])
            pairs.append((up[-1], nodes[k], nodes[k + 1]))
            k += 2
        else:
            up.append(nodes[k])
            k += 1
    width = WINDOW
    while pairs:
        spans = [(max(l[1], l[2] - width), min(r[2], r[1] + width)) for _, l, r in pairs]
        encs = tok.encode_batch([text_of[l[0]][a:b] for (_, l, _), (a, b) in zip(pairs, spans)],
                                add_special_tokens=False)
        rest = []
        for (out, left, right), (a, b), enc in zip(pairs, spans, encs):
            win = _tokens(enc, a)
            if a <= left[1]:
                head, after = [], 0
            else:
                near, before = _near(left[3], a, b, True)
                got = _left_run(near, win)
                if got is None:
                    rest.append((out, left, right))
                    continue
                head, after = left[3][:before + got[0]], got[1]
            if b >= right[2]:
                tail, upto = [], len(win)
            else:
                near, _ = _near(right[3], a, b, False)
                got = _right_run(near, win, after)
                if got is None:
                    rest.append((out, left, right))
                    continue
                tail, upto = right[3][got[0]:], got[1]
            out[3] = head + win[after:upto] + tail
        pairs = rest
        width *= 2
    return up


def encode_long(tok, texts: list[str], leaf: int = LEAF) -> list[list[int]]:
    """Ids of long unsplit texts by tree concatenation."""
    nodes = []
    for n, text in enumerate(texts):
        size = len(text)
        while size > leaf:
            size = -(-size // 2)
        nodes += [[n, a, min(a + size, len(text)), None] for a in range(0, len(text), max(1, size))]
    for node, enc in zip(nodes, tok.encode_batch([texts[n][a:b] for n, a, b, _ in nodes], add_special_tokens=False)):
        node[3] = _tokens(enc, node[1])
    while len(nodes) > len({n for n, *_ in nodes}):
        nodes = _join_level(tok, texts, nodes)
    by_text = {n: [i for i, _, _ in tokens] for n, _, _, tokens in nodes}
    return [by_text.get(n, []) for n in range(len(texts))]


class Codec:
    """Ids and decoded text of whole texts as space-joined strings."""

    def __init__(self, path: str):
        self.tok = tokenizer(path)
        self.known: dict[str, tuple[str, str]] = {}

    def _pair(self, ids: list[int]) -> tuple[str, str]:
        return " ".join(map(str, ids)), " ".join(map(self.tok.id_to_token, ids))

    def encode(self, texts: list[str]) -> list[tuple[str, str]]:
        """``(ids, decoded)`` of each text."""
        words = [[w for w in _SPACE.split(t) if w] for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        new = [w for w in set().union(*words) if w not in self.known] if words else []
        extra: dict[str, tuple[str, str]] = {}
        plain = [w for w in new if len(w) <= LEAF]
        for w, enc in zip(plain, self.tok.encode_batch_fast(plain, add_special_tokens=False)):
            (self.known if len(w) <= CACHE_CHARS else extra)[w] = self._pair(enc.ids)
        long = [w for w in new if len(w) > LEAF]
        for w, ids in zip(long, encode_long(self.tok, long)):
            extra[w] = self._pair(ids)
        out = []
        for ws in words:
            pairs = [extra[w] if w in extra else self.known[w] for w in ws] if extra else \
                list(map(self.known.__getitem__, ws))
            out.append((" ".join([p[0] for p in pairs if p[0]]), " ".join([p[1] for p in pairs if p[0]])))
        return out


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, vocab: str, digests: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` per row (ids as text joined by a space); with
    ``digests`` SHA-256 digests stand for the two long strings."""
    def run(rows: dict[str, list]) -> dict[str, list]:
        pairs = codec(vocab).encode([t or "" for t in rows["text"]])
        sha = (lambda s: hashlib.sha256(s.encode()).hexdigest()) if digests else (lambda s: s)
        return {"doc_id": rows["doc_id"], "n_tokens": [ids.count(" ") + 1 if ids else 0 for ids, _ in pairs],
                names[0]: [sha(ids) for ids, _ in pairs], names[1]: [sha(d) for _, d in pairs]}

    names = ("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_rows(rows, run, f"doc_id bigint, n_tokens bigint, {names[0]} string, {names[1]} string", 256)
