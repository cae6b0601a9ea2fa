"""Exact top-k search by pivot-table elimination (operator 1).

Vectors become integers, floor(64 x) per component; the score is the integer inner product.
For a pivot p the triangle inequality gives |q - x| >= |d(q, p) - d(x, p)|; the largest of
these over all pivots is a lower bound of the distance, and with the norms an upper bound of
the score: (|q|^2 + |x|^2 - bound^2) / 2.  The origin is a pivot too, which adds the bound
|q| |x|.  The distances of every vector to the pivots are computed once, when vectors are
packed into blocks.  A query takes a block's candidates in waves in the order of their
bounds; it stops when the next bound is below its k-th best score, which is exact.

Work is dealt as (query block, slice of candidate blocks): a task holds one query block and
streams the candidate blocks of its slice, the k-th best carried along, so memory is one
block of each whatever the size.  Blocks are chosen by a hash of vec_id, so equal vectors
spread.  Only k rows per query and slice meet in the last, ordinary top-k.

Pivots come from at most ``PIVOT_SAMPLE`` vectors (by hash of vec_id), farthest first; they
decide how much is skipped, never the result.

Cases: vectors that are null or hold null or non-finite components, and null vec_ids, take
no part.  A vec_id that repeats counts once, with the smallest of its vectors.  Only vectors
of the same length are compared.  Ties go to the smaller vec_id.  Fewer than k candidates:
all.  Scores beyond 2^53 are refused with an error.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adspark.llm.common import arrow_schema, materialize

SCALE = 64
PIVOTS = 16
PIVOT_SAMPLE = 1024
BLOCK = 2048            # candidates of a block, about
QUERY_BLOCK = 4096      # queries of a block, about
BLOCKS_PER_SLICE = 8    # least candidate blocks of a slice
MOST_SLICES = 64
CHUNK = 256             # queries whose bounds are computed at a time
WAVES = (64, 512)       # candidates, in bound order, evaluated before the next look at the bounds

PACKED = "dim int, block bigint, kind int, dtype string, ids binary, vectors binary, table binary"
FOUND = "query_id bigint, vec_id bigint, score bigint"


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, v (array<bigint>)``, one row per vec_id."""
    return (embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
            .filter("vec_id IS NOT NULL AND e IS NOT NULL")
            .filter("forall(e, x -> x IS NOT NULL AND abs(x) < double('Infinity'))")
            .select("vec_id", F.expr(f"transform(e, x -> floor({SCALE} * x))").alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS, sample: int = PIVOT_SAMPLE) -> dict[int, np.ndarray]:
    """Pivots of each vector length: the origin, then vectors far from those chosen."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    out = {}
    for dim in sorted({len(r["v"]) for r in rows}):
        same = [r["v"] for r in rows if len(r["v"]) == dim]
        v = np.array(same, dtype=np.float64).reshape(len(same), dim)
        chosen = [np.zeros(dim)]
        far = np.linalg.norm(v, axis=1)
        while len(chosen) <= min(pivots, len(v)) and far.max(initial=0.0) > 0:
            chosen.append(v[int(far.argmax())])
            far = np.minimum(far, np.linalg.norm(v - chosen[-1], axis=1))
        out[dim] = np.stack(chosen)
    return out


def _distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.linalg.norm(v - p, axis=1) for p in pivots], axis=1).astype("<f4")


def pack(vectors: DataFrame, blocks: int, kind: int, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Blocks of vectors with their distances to the pivots, one row each."""
    target = arrow_schema(PACKED)

    def one(dim: int, block: int, ids: list[np.ndarray], values: list[np.ndarray]) -> pa.RecordBatch:
        v = np.concatenate(values).reshape(sum(map(len, ids)), dim)
        reach = int(np.abs(v).max(initial=0))
        dtype = next(t for t, most in (("<i1", 127), ("<i2", 32767), ("<i4", 2**31 - 1), ("<i8", 2**63 - 1)) if reach <= most)
        table = _distances(v.astype(np.float64), pivots.get(dim, np.zeros((1, dim))))
        row = [dim, block, kind, dtype, np.concatenate(ids).astype("<i8").tobytes(), v.astype(dtype).tobytes(), table.tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip(row, target)], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            dims, at = batch.column("dim").to_numpy(), batch.column("block").to_numpy()
            marks = np.flatnonzero((np.diff(dims) != 0) | (np.diff(at) != 0)) + 1
            for a, b in zip([0, *marks], [*marks, batch.num_rows]):
                part = batch.slice(a, b - a)
                key = (int(dims[a]), int(at[a]))
                if held and held[0] != key:
                    yield one(*held[0], held[1], held[2])
                    held = None
                held = held or (key, [], [])
                held[1].append(part.column("vec_id").to_numpy())
                held[2].append(part.column("v").flatten().to_numpy())
        if held:
            yield one(*held[0], held[1], held[2])

    keyed = vectors.select(F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"), "vec_id", "v")
    return keyed.repartition("dim", "block").sortWithinPartitions("dim", "block", "vec_id").mapInArrow(run, PACKED)


class _Block:
    """A packed block, unpacked."""

    def __init__(self, row: dict):
        self.dim = row["dim"]
        self.ids = np.frombuffer(row["ids"], dtype="<i8")
        v = np.frombuffer(row["vectors"], dtype=row["dtype"]).reshape(len(self.ids), self.dim)
        self.v = v.astype(np.float64)
        self.table = np.frombuffer(row["table"], dtype="<f4").reshape(len(self.ids), -1)
        self.square = (self.v * self.v).sum(axis=1)


class Search:
    """The k best candidates of a block of queries, over candidate blocks as they come."""

    def __init__(self, queries: _Block, k: int):
        self.q, self.k = queries, k
        self.score = np.full((len(queries.ids), k), -np.inf)
        self.id = np.full((len(queries.ids), k), np.iinfo(np.int64).max)

    def _merge(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, live: np.ndarray) -> None:
        for n in np.flatnonzero(live.any(axis=1)):
            r, pick = rows[n], live[n]
            s, i = np.concatenate([self.score[r], scores[n, pick]]), np.concatenate([self.id[r], ids[n, pick]])
            order = np.lexsort((i, -s))[:self.k]
            self.score[r], self.id[r] = s[order], i[order]

    def add(self, x: _Block) -> None:
        q = self.q
        reach = np.sqrt(q.square.max(initial=0.0) * x.square.max(initial=0.0))
        if reach >= 2.0**53:
            raise ValueError("scores beyond 2^53 are not exact")
        kind = np.float32 if reach < 2.0**24 else np.float64
        qv, xv = q.v.astype(kind), x.v.astype(kind)
        # distances are stored in 32 bits: the bound is loosened by what that can be wrong
        slack = 1e-6 * (q.table.max(initial=0.0) + x.table.max(initial=0.0))
        n = len(x.ids)
        cuts = [c for c in WAVES if c < n]
        for a in range(0, len(q.ids), CHUNK):
            rows = np.arange(a, min(a + CHUNK, len(q.ids)))
            low = np.zeros((len(rows), n), dtype=np.float32)
            for p in range(q.table.shape[1]):
                np.maximum(low, np.abs(q.table[rows, p, None] - x.table[None, :, p]), out=low)
            low = np.maximum(low.astype(np.float64) - slack, 0.0)
            bound = (q.square[rows, None] + x.square[None, :] - low * low) / 2 + 1e-3
            order = np.argpartition(-bound, cuts, axis=1) if cuts else np.broadcast_to(np.arange(n), bound.shape)
            dense = None
            for lo, hi in zip([0, *cuts], [*cuts, n]):
                idx = order[:, lo:hi]
                worst = self.score[rows, -1]
                live = np.take_along_axis(bound, idx, axis=1) >= worst[:, None]
                if not live.any():
                    break  # every later bound is lower still
                if lo == 0 and cuts:
                    scores = np.einsum("qd,qwd->qw", qv[rows], xv[idx]).astype(np.float64)
                else:
                    if dense is None:
                        dense = (qv[rows] @ xv.T).astype(np.float64)
                    scores = np.take_along_axis(dense, idx, axis=1)
                ids = x.ids[idx]
                live &= (ids != q.ids[rows, None]) & (scores >= worst[:, None])
                self._merge(rows, ids, scores, live)

    def found(self) -> dict[str, np.ndarray]:
        real = np.isfinite(self.score)
        return {"query_id": np.repeat(self.q.ids, self.k).reshape(real.shape)[real], "vec_id": self.id[real],
                "score": self.score[real].astype(np.int64)}


def top_k(embeddings: DataFrame, is_query: str, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the rows that the SQL condition ``is_query`` (on
    vec_id) picks, against all others."""
    vectors = materialize(integer_vectors(embeddings))
    n, m = vectors.agg(F.count(F.lit(1)), F.count_if(F.expr(is_query))).first()
    pivots = choose_pivots(vectors)
    blocks, query_blocks = max(1, -(-n // BLOCK)), max(1, -(-m // QUERY_BLOCK))
    slices = max(1, min(MOST_SLICES, blocks // BLOCKS_PER_SLICE))
    candidates = pack(vectors, blocks, 1, pivots).withColumn("slice", (F.col("block") % slices).cast("int")) \
        .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    queries = pack(vectors.filter(is_query), query_blocks, 0, pivots) \
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))) \
        .withColumn("query_block", F.col("block").cast("int"))
    target = arrow_schema(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, search = None, None
        for batch in batches:
            for n_row in range(batch.num_rows):
                row = {name: batch.column(name)[n_row].as_py() for name in batch.schema.names}
                at = (row["dim"], row["query_block"], row["slice"])
                if at != key:
                    if search:
                        yield pa.RecordBatch.from_pydict(search.found(), schema=target)
                    key, search = at, None
                if row["kind"] == 0:
                    search = Search(_Block(row), k)
                elif search:
                    search.add(_Block(row))
        if search:
            yield pa.RecordBatch.from_pydict(search.found(), schema=target)

    dealt = (queries.unionByName(candidates).repartition("dim", "query_block", "slice")
             .sortWithinPartitions("dim", "query_block", "slice", "kind", "block"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (dealt.mapInArrow(run, FOUND).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op1(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, "vec_id % 20 = 0", 20)


ORACLE = """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE)))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20
"""
