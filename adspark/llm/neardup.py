"""N-gram Jaccard join by a MinHash LSH forest (operator 10).

Texts are words between white space; their shingles are runs of ``SHINGLE`` words (a shorter
text is one shingle).  Texts with the same words are copies and collapse to one class first.
Every class gets ``TREES`` MinHash signatures of ``DEPTH`` values; a tree's trie is the
order of its signatures, and classes under a common prefix are candidates.  Prefixes start
at full depth and are shortened by one value at a time until the estimated recall reaches
``TARGET``: each candidate pair found stands for 1 / p(s) pairs, p(s) being the chance that
a pair of its (signature-estimated) similarity s shares a prefix of that depth in any tree.

Candidates are never listed as pairs.  Under a prefix every class points to the smallest
(a star, by an aggregate that combines map-side); connected components of the stars gather
candidates, and each component is verified whole: its members are cut into blocks of bounded
size, and block pairs are dealt to tasks, where exact Jaccard similarities of all pairs come
from products of class x shingle incidence matrices.  A block pair returns a row per member
(how many documents and texts it links to, and the smallest member that its links inside
the block pair connect it with), so neither pairs nor a group's members meet in one place
and no connection is lost.  A last components run over these rows gives the classes of near
duplicates.

The result has a row per input row: ``doc_id, class_id`` (smallest doc_id that the links
connect, copies included), ``copy_id`` (smallest doc_id of equal words), ``n_links`` (other
documents of similarity ``THRESHOLD`` or more, copies included), ``n_texts`` (other texts).

Cases: a null text, or one without a word, links to nothing and is its own class.  Repeated
rows are copies.  A null doc_id is grouped and counted; class_id is null if all its group's
ids are.  An empty table gives no rows.  Extra columns are ignored.  Equality of texts is by
128-bit digests, of shingles by 64-bit ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspark.llm.common import arrow_rows, arrow_schema, connected_components, map_rows, materialize, release, small_enough, sorted_runs

SHINGLE = 5
THRESHOLD = 0.8
TREES = 16
DEPTH = 6
LEAST_DEPTH = 3          # a pair at the threshold is missed here with chance 2e-5
TARGET = 0.9999
BLOCK_TEXTS = 2048       # texts and characters of a block of members, about
BLOCK_CHARS = 8 << 20
COLUMNS = 1 << 12        # shingles multiplied at a time

_WS = "' \\t\\n\\u000B\\u000C\\r'"


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: near inputs get unrelated outputs."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


KEPT_WORDS = 100_000     # word hashes a worker keeps
_WORDS: dict[str, int] = {}


def _word_hashes(words: list[str]) -> np.ndarray:
    import xxhash

    known = _WORDS
    if len(known) > KEPT_WORDS:
        known.clear()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh64_intdigest(w)
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def shingles(words: list[str]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``SHINGLE`` words."""
    h = _word_hashes(words)
    if len(h) < SHINGLE:
        return _mix(np.array([_fold(h)], dtype=np.uint64)) if len(h) else h
    acc = np.zeros(len(h) - SHINGLE + 1, dtype=np.uint64)
    for k in range(SHINGLE):
        acc = _mix(acc + h[k:k + len(acc)] + np.uint64(k + 1))
    return np.unique(acc)


def _fold(h: np.ndarray) -> np.uint64:
    acc = np.zeros(1, dtype=np.uint64)
    for k, x in enumerate(h):
        acc = _mix(acc + x + np.uint64(1000 + k))
    return acc[0]


_SALTS = _mix(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_A, _B, _C = ((_SALTS >> np.uint64(32)).astype(np.uint32) | np.uint32(1), _SALTS.astype(np.uint32) | np.uint32(1),
              np.roll(_SALTS, 1).astype(np.uint32))


def signature(sh: np.ndarray) -> np.ndarray:
    """TREES x DEPTH MinHash values (32 bits) of a shingle set: keyed multiplications of its
    halves, mixed; the least over the set is kept."""
    out = np.full(TREES * DEPTH, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(sh), 1024):
        part = sh[at:at + 1024]
        x = part.astype(np.uint32)[None, :] * _A[:, None]
        x ^= (part >> np.uint64(32)).astype(np.uint32)[None, :] * _B[:, None] + _C[:, None]
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x ^= x >> np.uint32(13)
        np.minimum(out, x.min(axis=1), out=out)
    return out


def words_column(text: str = "text") -> F.Column:
    """The words of a text joined by one space; null where there is none."""
    return F.expr(f"nullif(btrim(regexp_replace(`{text}`, '[ \\\\t-\\\\r]+', ' ')), '')")


def key_column(words: str = "words") -> F.Column:
    return F.unhex(F.md5(F.col(words).cast("binary")))


def signed(rows: DataFrame) -> DataFrame:
    """``doc_id, key, size, sig`` of rows ``doc_id, key, words``; null where there are no words."""
    def run(cols: dict[str, list]) -> dict[str, list]:
        return {"doc_id": cols["doc_id"], "key": cols["key"], "size": [w and len(w) for w in cols["words"]],
                "sig": [w and signature(shingles(w.split(" "))).astype(">u4").tobytes() for w in cols["words"]]}

    return map_rows(rows.select("doc_id", "key", "words"), run, "doc_id bigint, key binary, size bigint, sig binary")


def chance(s: float, depth: int) -> float:
    """That a pair of similarity s shares a prefix of this depth in some tree."""
    return 1.0 - (1.0 - s ** depth) ** TREES


def stars(sigs: DataFrame, depth: int) -> DataFrame:
    """``a, b, same``: each class (by node number) under a prefix with the smallest one
    there, and how many of their signature values are equal."""
    width = 4 * DEPTH
    buckets = F.expr(f"transform(sequence(0, {TREES - 1}), t -> xxhash64(t, substring(sig, t * {width} + 1, {4 * depth})))")
    under = sigs.select("node", F.explode(buckets).alias("prefix"))
    least = under.groupBy("prefix").agg(F.min("node").alias("b"), F.max("node").alias("most")).filter("b < most")
    pairs = (under.join(least.select("prefix", "b"), "prefix").filter("node <> b")
             .select(F.col("node").alias("a"), "b").distinct())
    both = (pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b"))
    same = F.expr(f"size(filter(sequence(0, {TREES * DEPTH - 1}), i -> "
                  "substring(sa, 4 * i + 1, 4) = substring(sb, 4 * i + 1, 4)))")
    return both.select("a", "b", same.alias("same"))


def candidate_stars(sigs: DataFrame, threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """Stars at the longest prefix whose estimated recall reaches the target."""
    for depth in range(DEPTH, LEAST_DEPTH - 1, -1):
        found = materialize(stars(sigs, depth))
        release(found.sparkSession)
        if depth == LEAST_DEPTH:
            return found
        got = stands = 0.0
        for r in found.groupBy("same").count().collect():  # at most TREES x DEPTH rows
            s = r["same"] / (TREES * DEPTH)
            if s >= threshold:
                got += r["count"]
                stands += r["count"] / chance(s, depth)
        if got >= target * stands:
            return found
    return found


def _incidence(sets: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of shingle sets, by products of incidence
    matrices over the shingles that occur on both sides, ``COLUMNS`` at a time."""
    left, right = np.concatenate(sets), np.concatenate(others)
    both = np.intersect1d(left, right)
    out = np.zeros((len(sets), len(others)), dtype=np.float32)

    def coded(values, lists):
        at = np.searchsorted(both, values)
        at[at == len(both)] = 0
        hit = both[at] == values if len(both) else np.zeros(len(values), dtype=bool)
        return np.repeat(np.arange(len(lists)), [len(x) for x in lists])[hit], at[hit]

    if not len(both):
        return out
    (lr, lc), (rr, rc) = coded(left, sets), coded(right, others)
    for a in range(0, len(both), COLUMNS):
        m, n = np.zeros((len(sets), COLUMNS), np.float32), np.zeros((len(others), COLUMNS), np.float32)
        pick = (lc >= a) & (lc < a + COLUMNS)
        m[lr[pick], lc[pick] - a] = 1
        pick = (rc >= a) & (rc < a + COLUMNS)
        n[rr[pick], rc[pick] - a] = 1
        out += m @ n.T
    return out


LINKED = "key binary, docs bigint, texts bigint, root binary"


def _components(link: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """Component numbers of the rows and columns of a link matrix, which are the same members
    ``inside`` a block; -1 without a link.  Every row and column is read once."""
    of_row, of_col = np.full(link.shape[0], -1), np.full(link.shape[1], -1)
    if inside:
        of_col = of_row
    for start in np.flatnonzero(link.any(axis=1)):
        if of_row[start] >= 0:
            continue
        of_row[start], rows = start, np.array([start])
        while len(rows):
            cols = np.flatnonzero(link[rows].any(axis=0) & (of_col < 0))
            of_col[cols] = start
            if inside:
                rows = cols
            else:
                rows = np.flatnonzero(link[:, cols].any(axis=1) & (of_row < 0))
                of_row[rows] = start
    return of_row, of_col


def _linked(run: list[dict], threshold: float) -> Iterator[tuple]:
    """Links inside a block pair: ``(key, documents, texts, smallest key of its component)``."""
    low, high = [r for r in run if not r["side"]], [r for r in run if r["side"]]
    sets = {r["key"]: shingles(r["words"].split(" ")) for r in run}
    inside = run[0]["low"] == run[0]["high"]
    other = low if inside else high
    if not low or not other:
        return
    a, b = [sets[r["key"]] for r in low], [sets[r["key"]] for r in other]
    inter = _incidence(a, b).astype(np.float64)
    union = np.array([len(x) for x in a])[:, None] + np.array([len(x) for x in b])[None, :] - inter
    link = inter >= threshold * union - 1e-9
    if inside:
        np.fill_diagonal(link, False)
    copies_a, copies_b = np.array([r["copies"] for r in low]), np.array([r["copies"] for r in other])
    of_a, of_b = _components(link, inside)
    sides = ((low, of_a, link, copies_b), (other, of_b, link.T, copies_a))[:1 if inside else 2]
    least: dict[int, bytes] = {}
    for rows, of, _, _ in sides:
        for r, c in zip(rows, of.tolist()):
            if c >= 0:
                least[c] = min(least.get(c, r["key"]), r["key"])
    for rows, of, hits, copies in sides:
        texts, docs = hits.sum(axis=1), hits @ copies
        for k in np.flatnonzero(texts):
            yield rows[k]["key"], int(docs[k]), int(texts[k]), least[int(of[k])]


def verified_links(components: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """``key, docs, texts, root`` of every member and block pair with links.  ``components``
    are ``key, size, copies, root``; ``texts`` are ``key, words``."""
    blocks = components.groupBy("root").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS), F.ceil(F.sum("size") / BLOCK_CHARS)).cast("int").alias("n"))
    placed = components.join(blocks, "root").withColumn("at", F.pmod(F.xxhash64("key"), F.col("n")).cast("int"))
    pairs = F.expr("transform(sequence(0, n - 1), j -> struct(least(at, j) AS low, greatest(at, j) AS high, at > j AS side))")
    dealt = (placed.join(texts, "key").select("root", "key", "copies", "words", F.explode(pairs).alias("p"))
             .select("root", "p.low", "p.high", "p.side", "key", "copies", "words"))
    target = arrow_schema(LINKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for group in sorted_runs(batches, ["root", "low", "high"]):
            out += _linked(group, threshold)
            if len(out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), target)], schema=target)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), target)], schema=target)

    return (dealt.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high", "side", "key")
            .mapInArrow(run, LINKED))


def _rows(docs: DataFrame) -> DataFrame:
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), words_column().alias("words"))
            .withColumn("key", key_column()))


def classify(docs: DataFrame, threshold: float = THRESHOLD, target: float = TARGET) -> tuple[DataFrame, DataFrame]:
    """Materialised rows ``doc_id, key`` and classes of equal words ``key, root, copies,
    copy_id, docs, texts``; ``root`` names the class of near duplicates."""
    rows = _rows(docs)
    with arrow_rows(docs.sparkSession):
        light = materialize(signed(rows))
    classes = materialize(light.filter("key IS NOT NULL").groupBy("key", "size", "sig")
                          .agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("copy_id"))
                          .withColumn("node", F.xxhash64("key")))
    groups = connected_components(candidate_stars(classes.select("node", "sig"), threshold, target).select("a", "b"))
    components = materialize(classes.select("node", "key", "size", "copies").join(groups, "node").drop("node"))
    # the words of the candidates alone, one text of equal ones, read again from the table
    wanted = components.select("key")
    if small_enough(wanted, F.lit(16), max_rows=300_000):
        wanted = F.broadcast(wanted)
    texts = rows.join(wanted, "key", "left_semi").groupBy("key").agg(F.first("words").alias("words"))
    with arrow_rows(docs.sparkSession):
        links = materialize(verified_links(components, texts, threshold))
    release(links.sparkSession)
    roots = connected_components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("key").agg(F.sum("docs").alias("docs"), F.sum("texts").alias("texts"))
    of = (classes.select("key", "copies", "copy_id").join(counts, "key", "left")
          .join(roots.select(F.col("node").alias("key"), "root"), "key", "left"))
    return light.select("doc_id", "key"), materialize(of.withColumn("root", F.coalesce("root", "key")))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """One row per input row with its class and its numbers of links."""
    light, of = classify(docs, threshold, target)
    least = of.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    known = of.join(least, "root").select("key", "class_id", "copy_id", "copies", "docs", "texts")
    alone = F.col("key").isNull()
    return light.join(known, "key", "left").select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        (F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("docs", F.lit(0))).alias("n_links"),
        F.coalesce("texts", F.lit(0)).alias("n_texts"))


def keep_one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class of near duplicates: the one with the smallest
    doc_id (rows without one last), of equal rows any.  Rows without a word all stay."""
    columns = docs.columns
    light, of = classify(docs, threshold)
    rows = (light.filter("key IS NOT NULL").groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("n"))
            .join(of.select("key", "root"), "key"))
    me = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    stays = rows.groupBy("root").agg(F.min(me).alias("s"))
    marked = (rows.join(stays, "root").withColumn("goes", ~F.col("s").eqNullSafe(me)).filter("goes OR n > 1")
              .select(F.col("key").alias("__key"), F.col("doc_id").alias("__id"), F.col("goes").alias("__goes")))
    marked = materialize(marked)
    if small_enough(marked, F.lit(32), max_rows=300_000):
        marked = F.broadcast(marked)
    keyed = docs.withColumn("__words", words_column()).withColumn("__k", key_column("__words")).drop("__words")
    out = (keyed.join(marked, (F.col("__k") == F.col("__key")) & F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")),
                      "left").filter("__goes IS NULL OR NOT __goes"))
    # only rows that repeat with their doc_id are compared with each other
    repeated = out.filter("__goes IS NOT NULL").dropDuplicates(["__k", "__id"])
    return out.filter("__goes IS NULL").unionByName(repeated).select(*[F.col(f"`{c}`") for c in columns])
