"""Best-fit packing (operator 3): bounded-space online best fit.

A document is its ids followed by the end id; one longer than a sequence is cut into
full-length pieces, the first taking the remainder.  Pieces are packed online: a fixed
number of open sequences is kept in a bitset keyed by free space; a piece goes to the
open sequence with the least room that still holds it; when a new sequence would exceed
the number, the fullest closes first.

Spark deals the pieces (a few numbers each, no text) to groups of bounded size by a hash
of the row, so no group grows with the input, whatever the sources or lengths; each
group is packed on its own.  Pieces are materialised in the shared folder once: tokenizing
is the costly step and must not run again when an executor is lost.

Cases: null text packs as an empty text (the end id alone).  Every input row is packed,
repeated rows and null or repeated doc_ids included.  An empty table gives no rows.  Extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspark.llm.common import arrow_rows, arrow_schema, map_rows, materialize
from adspark.llm.tokens import word_ids

SEQ_LEN = 2048
END_ID = 0
OPEN_SEQUENCES = 1024          # open sequences a packing group keeps
GROUP_TOKENS = 8192 * SEQ_LEN  # tokens and pieces that a packing group holds on average
GROUP_PIECES = 100_000

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, row_no bigint"
PACKED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


def cut(n: int, limit: int = SEQ_LEN) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` ids: as few as possible, the first short."""
    first = n % limit or min(n, limit)
    return [(0, first)] + [(s, limit) for s in range(first, n, limit)]


def pieces(docs: DataFrame, vocab: str, limit: int = SEQ_LEN) -> DataFrame:
    """One row per piece of every document, with the crc32 of its ids."""
    def run(rows: dict[str, list]) -> dict[str, list]:
        out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "row_no")}
        end = np.array([END_ID], dtype="<u4").tobytes()
        for doc, row_no, ids in zip(rows["doc_id"], rows["row_no"],
                                    word_ids(vocab).encode([t or "" for t in rows["text"]])):
            ids += end
            for k, (start, length) in enumerate(cut(len(ids) // 4, limit)):
                for name, value in (("doc_id", doc), ("piece", k), ("start", start), ("length", length),
                                    ("ids_crc32", zlib.crc32(ids[4 * start:4 * (start + length)])),
                                    ("row_no", row_no)):
                    out[name].append(value)
        return out

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       F.monotonically_increasing_id().alias("row_no"))
    return map_rows(rows, run, PIECE)


class BestFit:
    """Online best fit over a bounded number of open sequences.

    ``open[f]`` lists the open sequences with ``f`` free places; bit ``f`` of ``mask`` is
    set while that list has entries, so the best fit is the lowest set bit at or above the
    length, and the fullest sequence is the lowest set bit of all."""

    def __init__(self, limit: int = SEQ_LEN, bound: int = OPEN_SEQUENCES):
        self.limit, self.bound = limit, bound
        self.open: list[list[int]] = [[] for _ in range(limit + 1)]
        self.mask = 0
        self.n_open = 0
        self.n = 0

    def _take(self, free: int) -> int:
        seq = self.open[free].pop()
        if not self.open[free]:
            self.mask &= ~(1 << free)
        self.n_open -= 1
        return seq

    def place(self, length: int) -> tuple[int, int]:
        """``(sequence, offset)`` of a piece."""
        if not 0 < length <= self.limit:
            raise ValueError(f"a piece of {length} ids does not fit in {self.limit}")
        fits = self.mask >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            seq = self._take(free)
        else:
            free, seq = self.limit, self.n
            self.n += 1
        left = free - length
        if left:
            if self.n_open >= self.bound:
                self._take((self.mask & -self.mask).bit_length() - 1)
            self.open[left].append(seq)
            self.mask |= 1 << left
            self.n_open += 1
        return seq, self.limit - free


def pack(items: DataFrame, limit: int = SEQ_LEN, bound: int = OPEN_SEQUENCES) -> DataFrame:
    """Pack materialised pieces; sequence ids are unique over all groups."""
    n, tokens = items.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    groups = max(1, -(-int(tokens) // GROUP_TOKENS), -(-n // GROUP_PIECES))
    target = arrow_schema(PACKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, bins = None, None
        for batch in batches:
            rows = batch.to_pydict()
            seq, offset = [], []
            for group, length in zip(rows["group"], rows["length"]):
                if group != at:
                    at, bins = group, BestFit(limit, bound)
                s, o = bins.place(length)
                seq.append((group << 32) | s)
                offset.append(o)
            yield pa.RecordBatch.from_pydict(
                {**{k: rows[k] for k in ("doc_id", "piece", "start", "length", "ids_crc32")},
                 "sequence_id": seq, "offset": offset}, schema=target)

    # the order inside a group is a hash of the row, fixed whatever order the shuffle delivers; full pieces
    # need no partner
    mix = F.xxhash64("doc_id", "row_no", "piece", "ids_crc32")
    dealt = (items.withColumn("mix", mix).withColumn("group", F.pmod("mix", F.lit(groups)))
             .repartition("group")
             .sortWithinPartitions("group", F.xxhash64("mix"), "row_no", "piece"))
    return dealt.drop("mix", "row_no").mapInArrow(run, PACKED)


def best_fit_packing(docs: DataFrame, vocab: str, limit: int = SEQ_LEN, bound: int = OPEN_SEQUENCES) -> DataFrame:
    """Packed pieces of ``docs (doc_id, text)``: one row per piece with its place."""
    with arrow_rows(docs.sparkSession):
        cut_up = materialize(pieces(docs, vocab, limit))
    return pack(cut_up, limit, bound)
