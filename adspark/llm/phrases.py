"""Phrase collocation mining (operator 12) by a sample and its negative border.

A sample of the documents proposes the words and word pairs that may be frequent.  One pass
over all documents then counts exactly: every word, every pair of proposed words and every
triple whose two pairs are proposed; of these the proposals are one part and their negative
border (not proposed themselves, though all their parts are) the other.  Frequent phrases of
the border are failures of the sample: they join the proposals, and a further pass counts the
pairs and triples that this admits, until a pass finds none.  Then every frequent phrase has
been counted over all documents, whatever the sample was.

Proposals are kept as bitmaps over a hash (``FILTER_BITS`` bits each, so what is broadcast
has a fixed size).  A false positive only makes a pass count more; what an earlier pass has
counted is decided by the same bitmaps, so nothing counts twice.

A task counts with numpy over blocks of about ``BLOCK_CHARS`` characters (a longer text is a
block of its own) and sends each distinct phrase of a block once; Spark adds these up, so a
phrase or language with a third of all words arrives as one row a block.

Cases: null text is empty; null lang is ``und`` (with a stated ``und``).  Repeated rows count
each time, doc_ids are not read.  Ties as stated in ``collocations``.  Texts of any length
are counted whole.  An empty table gives no rows.  Extra columns are ignored, whatever their
names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adspark.llm.common import materialize

LEAST_COUNT = 10       # occurrences of a frequent phrase
MOST_WORDS = 3         # of a phrase
TOP = 2000             # phrases reported for a language
SAMPLE = 16            # one document in so many proposes
SAMPLE_COUNT = 2       # occurrences there that propose a phrase
FILTER_BITS = 1 << 26  # bits of a bitmap of proposals (8 MB)
BLOCK_CHARS = 8_000_000

BREAK = b"."           # stands for any of the characters that end a piece
# fixed values: A-Z to a-z, tab to space, the ends of pieces to one of them
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 9 else ord(BREAK) if chr(c) in ".,;:!?\n\x0b\x0c\r" else c
               for c in range(256))
_PAIR = 1_000_003      # a pair's hash: the first word's times this, plus the second's

_COUNTS = "lang string, phrase string, n bigint"
_COUNTS_ARROW = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    return (bits[h >> 3] >> (h & 7).astype(np.uint8)) & 1 != 0


class Proposals:
    """Bitmaps of proposed words and pairs."""

    def __init__(self, words: np.ndarray, pairs: np.ndarray):
        self.words, self.pairs = words, pairs

    def __or__(self, other: Proposals) -> Proposals:
        return Proposals(self.words | other.words, self.pairs | other.pairs)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Proposals) and np.array_equal(self.words, other.words) \
            and np.array_equal(self.pairs, other.pairs)


def bitmap(rows: DataFrame, h: str, bits: int) -> np.ndarray:
    """The bitmap of the hash values ``h`` of ``rows``; at most ``bits`` / 8 bytes."""
    parts = (rows.select(F.expr(f"({h}) % {bits} + 1").alias("h"))
             .groupBy(F.expr("bitmap_bucket_number(h)").alias("part"))
             .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(h))").alias("bits")).collect())
    out = np.zeros(max(bits // 8, 4096), dtype=np.uint8)
    for r in parts:
        at = (r["part"] - 1) * 4096
        out[at:at + 4096] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return out


def propose(frequent: DataFrame, bits: int) -> Proposals:
    """The words and pairs among ``frequent (lang, phrase)``."""
    word = "crc32(CAST(concat(lang, '\\n', {0}) AS binary))"
    rows = frequent.withColumn("w", F.split("phrase", " "))
    pair = f"{word.format('w[0]')} * {_PAIR} + {word.format('w[1]')}"
    return Proposals(bitmap(rows.filter("size(w) = 1 AND phrase <> ''"), word.format("w[0]"), bits),
                     bitmap(rows.filter("size(w) = 2"), pair, bits))


def _words(texts: list[str]) -> tuple[np.ndarray, pa.Array]:
    """The words of texts in order as numbers, and the words; the end of a piece is ``BREAK``."""
    data = np.frombuffer(("\n".join(texts) + "\n").encode().translate(_TABLE), dtype=np.uint8)
    word, end = data != 32, data == ord(BREAK)
    begins = word.copy()
    begins[1:] &= ~word[:-1] | end[:-1] | end[1:]
    places = np.cumsum(word, dtype=np.int64)[begins] - 1  # among the bytes without spaces
    places = np.append(places, word.sum()).astype(np.int64)
    kind, width = (pa.string(), np.int32) if len(data) < 1 << 31 else (pa.large_string(), np.int64)
    found = pa.Array.from_buffers(kind, len(places) - 1, [None, pa.py_buffer(places.astype(width)),
                                                          pa.py_buffer(data[word].tobytes())]).dictionary_encode()
    return found.indices.to_numpy().astype(np.int64), found.dictionary.cast(pa.string())


def _distinct(lang: str, phrases: list[pa.Array], n: np.ndarray) -> pa.RecordBatch:
    phrase = pc.binary_join_element_wise(*phrases, " ") if len(phrases) > 1 else phrases[0]
    return pa.RecordBatch.from_arrays([pa.array([lang], pa.string()).take(pa.array(np.zeros(len(n), np.int32))), phrase,
                                       pa.array(n, pa.int64())], schema=_COUNTS_ARROW)


def _counts(lang: str, texts: list[str], now: Proposals | None, before: Proposals | None,
            bits: int) -> Iterator[pa.RecordBatch]:
    """Counts in a block's texts of what ``now`` admits and ``before`` did not; with no
    proposals at all, of every word and pair.  The empty phrase counts a language's words."""
    code, words = _words(texts)
    stop = words.index(BREAK.decode()).as_py()
    real = code != stop
    if before is None:
        one = np.bincount(code[real], minlength=len(words))
        at = np.flatnonzero(one)
        if len(at):
            yield _distinct(lang, [words.take(pa.array(at))], one[at])
            yield _distinct(lang, [pa.array([""])], np.array([real.sum()]))
    both = real[:-1] & real[1:]
    if now is None:
        pair, triple = both, None
    else:
        seed = zlib.crc32(f"{lang}\n".encode())
        h = np.array([zlib.crc32(w, seed) for w in words.cast(pa.binary()).to_pylist()], dtype=np.int64)
        hashed = h[code]
        joint = (hashed[:-1] * _PAIR + hashed[1:]) % bits
        del hashed

        def admitted(p: Proposals) -> tuple[np.ndarray, np.ndarray]:
            word = _has(p.words, h % bits)[code]
            two = both & _has(p.pairs, joint)
            return both & word[:-1] & word[1:], two[:-1] & two[1:]

        pair, triple = admitted(now)
        if before is not None:
            old_pair, old_triple = admitted(before)
            pair, triple = pair & ~old_pair, triple & ~old_triple
        del joint
    shift = len(words).bit_length()  # two words fit in 62 bits
    mask = (1 << shift) - 1
    named = lambda numbers: words.take(pa.array(numbers))
    at = np.flatnonzero(pair)
    if len(at):
        found, n = np.unique((code[at] << shift) | code[at + 1], return_counts=True)
        yield _distinct(lang, [named(found >> shift), named(found & mask)], n)
    at = np.flatnonzero(triple) if triple is not None else []
    if len(at):
        first = (code[at] << shift) | code[at + 1]
        heads = None
        if 3 * shift > 63:  # pairs are numbered first
            heads, first = np.unique(first, return_inverse=True)
        found, n = np.unique((first << shift) | code[at + 2], return_counts=True)
        head = found >> shift if heads is None else heads[found >> shift]
        yield _distinct(lang, [named(head >> shift), named(head & mask), named(found & mask)], n)


def count_phrases(docs: DataFrame, now: Proposals | None, before: Proposals | None, least: int,
                  bits: int) -> DataFrame:
    """``lang, phrase, n`` of the phrases of ``docs (lang, text)`` that ``now`` admits and
    ``before`` did not, with at least ``least`` occurrences, and of the empty phrase."""
    shared = docs.sparkSession.sparkContext.broadcast((now, before))  # 4 bitmaps at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: dict[str, list[str]] = {}
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256).to_pydict()
                for lang, text in zip(part["lang"], part["text"]):
                    block.setdefault(lang, []).append(text)
                    size += len(text)
                if size >= BLOCK_CHARS:
                    for lang, texts in block.items():
                        yield from _counts(lang, texts, *shared.value, bits)
                    block, size = {}, 0
        for lang, texts in block.items():
            yield from _counts(lang, texts, *shared.value, bits)

    # a block's phrases are distinct already: no second summing before the shuffle
    return materialize(docs.mapInArrow(run, _COUNTS).repartition("lang", "phrase")
                       .groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
                       .filter(F.expr(f"n >= {least} OR phrase = ''")))


def frequent_phrases(docs: DataFrame, least: int = LEAST_COUNT, sample: int = SAMPLE, sample_count: int = SAMPLE_COUNT,
                     bits: int = FILTER_BITS) -> DataFrame:
    """``lang, phrase, n`` of every phrase of one to three words of ``docs (lang, text)`` with
    at least ``least`` occurrences, exactly; the empty phrase has a language's words."""
    chosen = docs.filter(F.pmod(F.xxhash64("text", "lang"), F.lit(sample)) == 0)
    now = propose(count_phrases(chosen, None, None, sample_count, bits), bits)
    before, found = None, None
    while True:
        counted = count_phrases(docs, now, before, least, bits)
        found = counted if found is None else found.union(counted)
        more = now | propose(counted, bits)
        if more == now:
            return found
        now, before = more, now


def collocations(found: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language by score, from ``frequent_phrases``.

    A phrase's score is that of its lowest-scoring cut (ties: after fewer words); a phrase
    inside a longer one that has at least half of its occurrences is dropped.  Order: score,
    then occurrences, both descending, then the phrase in byte order."""
    found = materialize(found.withColumn("w", F.split("phrase", " ")))
    parts = found.filter("phrase <> ''").select("lang", "phrase", "n")
    phrases = found.filter("size(w) > 1").select("lang", "phrase", F.col("n").alias("a"), "w")
    cuts = phrases.select("lang", "phrase", "a", F.explode(F.expr(
        "transform(sequence(1, size(w) - 1), k -> named_struct('k', k, 'left', array_join(slice(w, 1, k), ' '), "
        "'right', array_join(slice(w, k + 1, size(w) - k), ' ')))")).alias("c")).select("lang", "phrase", "a", "c.*")
    part = lambda key, n: parts.select("lang", F.col("phrase").alias(key), F.col("n").alias(n))
    scored = (cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
              .withColumn("score", F.expr("(CAST(1000000 AS decimal(7,0)) * CAST(a AS decimal(15,0)) * "
                                          "CAST(a AS decimal(15,0))) div (CAST(l AS decimal(18,0)) * "
                                          "CAST(r AS decimal(18,0)))"))
              .groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("x"))
              .select("lang", "phrase", "x.*"))
    inside = (phrases.filter("size(w) = 3")
              .select("lang", "a", F.explode(F.expr("array(concat(w[0], ' ', w[1]), concat(w[1], ' ', w[2]))")).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = scored.join(inside, ["lang", "phrase"], "left").filter("longer IS NULL OR 100 * longer < 50 * a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    words = found.filter("phrase = ''").select("lang", "n")
    return best.join(words, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame, top: int = TOP, **settings: int) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of ``docs (lang, text)``."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return collocations(frequent_phrases(rows, **settings), top)


ORACLE = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, unnest(ws) AS phrase, 1 AS k FROM w
      UNION ALL SELECT lang, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])), 2 FROM w
      UNION ALL SELECT lang, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])), 3 FROM w),
f AS (SELECT lang, phrase, k, count(*) AS n FROM g GROUP BY ALL),
total AS (SELECT lang, sum(n) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, phrase, k AS words, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND n >= 10),
cut AS (SELECT lang, phrase, words, a, ws, unnest(range(1, words)) AS k FROM c),
part AS (SELECT lang, phrase, words, a, k, array_to_string(ws[1:k], ' ') AS lp, array_to_string(ws[k + 1:words], ' ') AS rp FROM cut),
s AS (SELECT part.lang, part.phrase, part.words, a, part.k, x.n AS l, y.n AS r,
             (1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n) AS score
      FROM part JOIN f x ON x.lang = part.lang AND x.phrase = lp JOIN f y ON y.lang = part.lang AND y.phrase = rp),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, phrase, max(a) AS longer FROM (
             SELECT lang, a, ws[1] || ' ' || ws[2] AS phrase FROM c WHERE words = 3
             UNION ALL SELECT lang, a, ws[2] || ' ' || ws[3] FROM c WHERE words = 3) GROUP BY ALL),
kept AS (SELECT m.* FROM m LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT o.lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, CAST(total.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM o JOIN total USING (lang) WHERE rank <= 2000
"""
