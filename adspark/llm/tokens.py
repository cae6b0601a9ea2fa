"""Encoding of whole texts with a public ``tokenizers`` vocabulary, word by word.

Both vocabularies split a text before any merge, so a text's ids are the ids of its
space-delimited words in order.  Words repeat, so each worker keeps the ids of the words
it has met (bounded; emptied when full).  The results equal ``Tokenizer.encode`` of the
whole text; ``tests/llm`` compare them on odd Unicode and white space.
"""

from __future__ import annotations

import json
import re
import sys
from array import array

import numpy as np

CACHE_WORDS = 400_000   # words kept by a worker; reaching it empties the cache, results do not change
KEPT_WORDS = 250_000    # the same for ``WordIds``, whose memory outlives a stage in a reused worker
JOINED_WORDS = 1000     # new words encoded together
CACHE_CHARS = 64        # longer words are encoded each time

if array("I").itemsize != 4 or sys.byteorder != "little":
    raise RuntimeError("ids are taken as little-endian 32-bit numbers")

# fixed value: how a byte-level pre-tokenizer cuts a text
BYTE_LEVEL_CUTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# characters of which every Unicode version says the same
_FAST = re.compile("[\x00-\u024f]*").fullmatch

_PAIR = re.compile(r"\s\s|^\s|\s$")
_SAFE = re.compile(r"(?<=\S)(?= \S)")
_TOKENIZERS: dict = {}


def tokenizer(path: str):
    """The tokenizer of ``path``, loaded once in a worker, truncation and padding off."""
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _TOKENIZERS[path] = t
    return _TOKENIZERS[path]


def fast_merges(tok):
    """A faster encoder with the same vocabulary, for ``_FAST`` texts without a special token: where the
    merges of a byte-level BPE come in the order of their ids, merging by rank is the same."""
    import tiktoken

    spec = json.loads(tok.to_str())
    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model.get("merges", [])]
    vocab = model["vocab"]
    first = len(vocab) - len(pairs)
    plain = (model["type"] == "BPE" and not any(model.get(k) for k in (
        "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and spec["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
        and not cut.get("add_prefix_space") and first == 256
        and all(vocab.get(a + b) == first + i for i, (a, b) in enumerate(pairs)))
    if not plain:
        return None
    # the byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(own)))}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items()}
    return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_CUTS, mergeable_ranks=ranks, special_tokens={})


def spaced_words(text: str) -> list[str]:
    """The text cut before single spaces between non-space characters; a cut there is
    always a cut of the byte-level pre-tokenizer.  Joined, the words give the text."""
    if not text:
        return []
    if _PAIR.search(text):
        return _SAFE.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + w for w in rest]]


class WordIds:
    """Little-endian unsigned 32-bit ids of texts under a byte-level vocabulary.

    A text is split at its spaces; the words after a space are kept without it.  Such a
    cut is one of the pre-tokenizer's unless white space stands on both sides of it, which
    shows as an empty word or as one that starts with other white space; those texts are
    split by ``spaced_words`` instead."""

    def __init__(self, path: str):
        self.tok = tokenizer(path)
        self.fast = fast_merges(self.tok)
        self.special = [str(t) for t in self.tok.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}  # by the word after a space
        self.ends = {mark: self._ids([mark])[0] for mark in ",."}
        size = self.tok.get_vocab_size()
        # the byte-level alphabet writes a space as U+0120, and no other byte
        self.spaced = np.array([(self.tok.id_to_token(i) or "").startswith("\u0120") for i in range(size)])

    def _ids(self, pieces: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tok.encode_batch_fast(pieces, add_special_tokens=False)]

    def _learn(self, new: set[str]) -> None:
        """Ids of new words; a last comma or full stop after a letter is a piece of its own."""
        known = self.known
        stems = {w[:-1] if w[-1] in self.ends and w[-2:-1].isalpha() else w for w in new}
        stems = [w for w in stems if w not in known]
        odd = {w for w in stems if not w.isascii() and not _FAST(w)}
        stems = [w for w in stems if w not in odd]
        n_fast = len(stems)
        stems += odd
        for at in (*range(0, n_fast, JOINED_WORDS), *range(n_fast, len(stems), JOINED_WORDS)):
            part = stems[at:min(at + JOINED_WORDS, n_fast if at < n_fast else len(stems))]
            # encoded as one text; a word begins at each id that begins with a space
            text = " " + " ".join(part)
            ids = np.array(self.fast.encode_ordinary(text)
                           if self.fast and at < n_fast and not any(t in text for t in self.special) else
                           self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4")
            starts = (4 * np.flatnonzero(self.spaced[ids])).tolist()
            if len(starts) == len(part):
                data = ids.tobytes()
                known.update(zip(part, [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)])]))
            else:
                known.update(zip(part, self._ids([" " + w for w in part])))
        for w in new:
            if w not in known:
                known[w] = known[w[:-1]] + self.ends[w[-1]]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        known = self.known
        split = [t.split(" ") for t in texts]
        seen = set().union(*(ws[1:] for ws in split))
        new = seen.difference(known)
        odd = {w for w in new if not w or w[0].isspace()}  # never kept
        plain = [not odd or odd.isdisjoint(ws[1:]) for ws in split]
        self._learn(new - odd)
        first = self._ids([ws[0] for ws in split])
        out = [head + b"".join(map(known.__getitem__, ws[1:])) if ok else b"".join(self._ids(spaced_words(t)))
               for head, ws, ok, t in zip(first, split, plain, texts)]
        for w in new:
            if len(w) > CACHE_CHARS:
                known.pop(w, None)
        return out


_WORD_IDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _WORD_IDS:
        _WORD_IDS[path] = WordIds(path)
    return _WORD_IDS[path]
