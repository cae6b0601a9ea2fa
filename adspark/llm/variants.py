"""Spelling variant grouping (operator 11) with a dictionary of trie-node pairs.

The distinct words, sorted, are the leaves of a trie; its nodes (prefixes) are numbered in the
order in which the sorted words reach them, and so are the nodes of the trie of the reversed
words (suffixes).  A word without the character at a place is the integer pair (prefix node,
suffix node) around that place; a word cut at a place is such a pair too.  Two words that share
a pair around a skipped character differ by a replaced one; a word whose skipped pair is another
word's cut has one character more.  So one grouping of the pairs gives all exact neighbours.

A pair names one prefix and one suffix, so its group holds at most one word for each letter of
the alphabet and the one word that is cut there: ``LETTERS + 1`` rows, whatever the data.  Of
equal letters in a row only the first is skipped to reach a shorter word, so every neighbour
counts once.  A prefix or suffix that a single word has cannot be shared; its pairs are never
made.

Numbering is distributed: words are range-partitioned and sorted, each partition reports its
first and last word and how many nodes it adds (one row a partition), and from these every
partition continues the numbering where the one before stops.

A word's form is its commonest neighbour, where that is ``FACTOR`` times as common; roots follow
forms by pointer doubling (a chain has at most 19 words, as counts grow tenfold along it).

Cases: null text has no words; a null doc_id reads as an empty string in the hash that chooses
where a character is lost.  Repeated rows count each time.  Ties go to the smallest word in
code-point order.  Words of any length take part.  An empty table gives no rows.  Extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adspark.llm.common import arrow_schema, map_rows, materialize

LEAST_LENGTH = 7    # code points of a word
LEAST_COUNT = 2     # occurrences of a word
FACTOR = 10         # a form is that many times as common
LOSES = 31          # one occurrence in so many loses a character
LETTERS = 90        # a-z and U+00C0 to U+00FF, what runs are made of after lower-casing

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n`` of the words that count: letter runs in lower case, some without the
    character that their hash picks."""
    # a shorter run stays shorter, so it is not even extracted
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(F.expr(
        f"regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}', 0)")).alias("run"))
    runs = runs.withColumn("run", F.translate("run", _UPPER, _LOWER))
    runs = runs.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
    word = F.expr(f"CASE WHEN h % {LOSES} = 0 THEN concat(substring(run, 1, CAST(h % length(run) AS int)), "
                  "substring(run, CAST(h % length(run) AS int) + 2)) ELSE run END")
    return (runs.select(word.alias("word")).filter(F.length("word") >= LEAST_LENGTH)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT))


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    least = min(len(a), len(b))
    if a[:least] == b[:least]:
        return least
    return next(i for i in range(least) if a[i] != b[i])


class _Path:
    """The numbered nodes on the way to the last of a run of sorted keys."""

    def __init__(self, key: str | None = None, nodes: list[int] | None = None, made: int = 0):
        self.key, self.nodes, self.made = key, list(nodes or []), made

    def go(self, key: str) -> int:
        """On to the next key; the length of what it shares with the one before."""
        shared = 0 if self.key is None else _common(self.key, key)
        new = len(key) - shared
        self.nodes[shared:] = range(self.made + 1, self.made + new + 1)
        self.key, self.made = key, self.made + new
        return shared


_ENDS = pa.schema([("part", pa.int32()), ("rows", pa.int64()), ("made", pa.int64()), ("first", pa.string()),
                   ("last", pa.string()), ("nodes", pa.list_(pa.int64()))])
_ENDS_TYPE = "part int, rows bigint, made bigint, first string, last string, nodes array<bigint>"


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for a partition: what the next one has to know."""
    path, rows, first, part = _Path(), 0, None, 0
    for batch in batches:
        for key, part in zip(batch.column("key").to_pylist(), batch.column("part").to_pylist()):
            first = key if first is None else first
            path.go(key)
            rows += 1
    if rows:
        yield pa.RecordBatch.from_pylist([{"part": part, "rows": rows, "made": path.made, "first": first,
                                           "last": path.key, "nodes": path.nodes}], schema=_ENDS)


def _starts(ends: list) -> dict[int, tuple]:
    """For each partition the rows before it, the path to the last key before it and the
    first key after it."""
    out, rows, path = {}, 0, _Path()
    for end, after in zip(ends, [*ends[1:], None]):
        out[end["part"]] = (rows, path.key, path.nodes, path.made, after and after["first"])
        shared = 0 if path.key is None else _common(path.key, end["first"])
        # the first nodes that the partition made are those that it shares with the one before
        nodes = [path.nodes[x - 1] if x <= shared else path.made + x - shared for x in end["nodes"]]
        path = _Path(end["last"], nodes, path.made + end["made"] - shared)
        rows += end["rows"]
    return out


def number_nodes(table: DataFrame, key: str, nodes: str, row: str) -> DataFrame:
    """``table`` with its rows numbered in the order of the distinct strings ``key`` (``row``)
    and the numbers of the trie nodes on the way to each key (``nodes``), as far as another key
    shares them."""
    rest = [c for c in table.columns if c != key]
    placed = materialize(table.withColumnRenamed(key, "key").repartitionByRange("key").sortWithinPartitions("key"))
    placed = placed.withColumn("part", F.spark_partition_id())
    # one row a partition: a partition's first and last key
    starts = _starts(placed.select("key", "part").mapInArrow(_ends, _ENDS_TYPE).orderBy("part").collect())
    kinds = dict(table.dtypes)
    schema = ", ".join([f"{key} string", *[f"{c} {kinds[c]}" for c in rest], f"{row} bigint", f"{nodes} array<bigint>"])
    return placed.mapInArrow(_numberer(starts, rest, key, nodes, row, arrow_schema(schema)), schema)


def _numberer(starts: dict, rest: list[str], key: str, nodes: str, row: str, target: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, at, after, held = None, 0, None, None  # held: the last row, until its follower is known
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = batch.to_pydict()
            if path is None:
                at, last, nums, made, after = starts[cols["part"][0]]
                path = _Path(last, nums, made)
            out = {name: [] for name in target.names}

            def put(row_values: tuple, shared: int) -> None:
                values, k, before, numbers = row_values
                for name, value in zip(target.names, (*values, k, numbers[:max(before, shared)])):
                    out[name].append(value)

            for values in zip(cols["key"], *[cols[c] for c in rest]):
                before = path.go(values[0])
                if held:
                    put(held, before)
                held = values, at, before, list(path.nodes)
                at += 1
            yield pa.RecordBatch.from_pydict(out, schema=target)
        if held:
            out = {name: [] for name in target.names}
            values, k, before, numbers = held
            shared = max(before, _common(values[0], after) if after is not None else 0)
            yield pa.RecordBatch.from_pydict({name: [v] for name, v in zip(target.names, (*values, k, numbers[:shared]))},
                                             schema=target)

    return run


_PAIR = "p bigint, s bigint, cut boolean, first boolean, n bigint, word_id bigint"


def _pairs(rows: dict[str, list]) -> dict[str, list]:
    """The pairs of each word that another word may share."""
    out = {k: [] for k in ("p", "s", "cut", "first", "n", "word_id")}
    for word, n, word_id, pre, suf in zip(rows["word"], rows["n"], rows["word_id"], rows["pre"], rows["suf"]):
        size = len(word)
        for skip in (1, 0):
            for i in range(max(0, size - skip - len(suf)), min(size - skip, len(pre)) + 1):
                out["p"].append(pre[i - 1] if i else 0)
                left = size - skip - i
                out["s"].append(suf[left - 1] if left else 0)
                out["cut"].append(not skip)
                out["first"].append(bool(skip) and (i == 0 or word[i - 1] != word[i]))
                out["n"].append(n)
                out["word_id"].append(word_id)
    return out


def neighbours(words: DataFrame) -> DataFrame:
    """``word_id, n_near, near_n, near_id`` of the words that have a near word; ``words`` has
    ``word_id, word, n, pre, suf``, word ids in the order of the words.  ``near_id`` is the
    commonest near word."""
    pairs = map_rows(words.select("word", "n", "word_id", "pre", "suf"), _pairs, _PAIR, 4096)
    # at most LETTERS + 1 rows a pair: skipped ones first, the commonest first
    order = Window.partitionBy("p", "s").orderBy("cut", F.desc("n"), "word_id")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pairs = pairs.withColumn("me", F.expr("struct(n, -word_id AS id)"))
    grouped = pairs.select(
        "cut", "first", "me", "word_id", F.count(F.lit(1)).over(whole).alias("rows"),
        F.row_number().over(order).alias("k"), F.count(F.expr("CASE WHEN NOT cut THEN 1 END")).over(whole).alias("skips"),
        F.first("me").over(whole).alias("best"), F.lead("me").over(order).alias("next"),
        F.last(F.expr("CASE WHEN cut THEN me END")).over(whole).alias("shorter"),
        F.count(F.expr("CASE WHEN first THEN 1 END")).over(whole).alias("longer"),
        F.first(F.expr("CASE WHEN first THEN me END"), ignorenulls=True).over(whole).alias("best_longer"))
    other = "CASE WHEN k > 1 THEN best WHEN skips > 1 THEN next END"
    found = grouped.filter("rows > 1").selectExpr(
        "word_id", "CASE WHEN cut THEN longer ELSE skips - 1 + IF(first AND shorter IS NOT NULL, 1, 0) END AS near",
        f"CASE WHEN cut THEN best_longer ELSE greatest({other}, CASE WHEN first THEN shorter END) END AS top")
    return (found.filter("near > 0").groupBy("word_id").agg(F.sum("near").alias("n_near"), F.max("top").alias("top"))
            .selectExpr("word_id", "n_near", "top.n AS near_n", "-top.id AS near_id"))


def _roots(links: DataFrame) -> DataFrame:
    """``id, root``: the end of each chain of ``links (id, up)``."""
    at = materialize(links)
    while True:
        far = at.select(F.col("id").alias("up"), F.col("up").alias("upper"))
        at = materialize(at.join(far, "up", "left").select("id", F.coalesce("upper", "up").alias("up"),
                                                           F.col("upper").isNotNull().alias("moved")))
        if at.filter("moved").isEmpty():
            return at.select("id", F.col("up").alias("root"))
        at = at.select("id", "up")


def group_variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``docs (doc_id, text)``."""
    forward = materialize(number_nodes(count_words(docs), "word", "pre", "word_id"))
    backward = number_nodes(forward.select(F.reverse("word").alias("drow"), "word_id"), "drow", "suf", "place")
    words = forward.join(backward.select("word_id", "suf"), "word_id")
    near = materialize(neighbours(words))
    named = forward.select("word_id", "word", "n")
    rows = materialize(named.join(near, "word_id", "left").selectExpr(
        "word_id", "word", "n", "coalesce(n_near, 0) AS n_near", f"IF(near_n >= {FACTOR} * n, near_id, NULL) AS form_id",
        f"IF(near_n >= {FACTOR} * n, near_n, NULL) AS form_n"))
    links = rows.filter("form_id IS NOT NULL")
    ends = _roots(links.select(F.col("word_id").alias("id"), F.col("form_id").alias("up")))
    called = lambda name, key: named.select(F.col("word_id").alias(key), F.col("word").alias(name))
    formed = (links.join(called("form", "form_id"), "form_id")
              .join(ends.withColumnRenamed("id", "word_id"), "word_id")
              .join(called("root_word", "root"), "root")
              .select("word", "form", F.col("root_word").alias("root"), "n", "n_near", "form_n"))
    alone = rows.filter("form_id IS NULL").select("word", F.lit(None).cast("string").alias("form"),
                                                  F.col("word").alias("root"), "n", "n_near", "form_n")
    return alone.union(formed)
