"""Site-relative line dedup (operator 5), DataFrame functions only.

Pages (documents) are grouped by host (``source``).  For every line, trimmed, the number of
the host's pages that contain it is divided by the host's page total; lines above ``RATIO``
that stand on at least ``MIN_PAGES`` pages are boilerplate and go from the host's pages,
whatever share of a page they are.  Only a page without any other line is a copy of other
pages, not a page in a frame; it stays whole, for copy removal to handle.

Only 64-bit line hashes travel: distinct per page first, counted by (host, line) with
map-side combine, so a hot host is spread over its lines.  A host has at most (lines per
page / RATIO) boilerplate lines; they go back as one short list per host, broadcast where
the lists' measured size is small and otherwise joined on (host, salt), the salt splitting a
hot host's pages.

Cases: null text stays null.  Pages without a host are left alone.  Blank lines neither
count nor go.  Repeated rows and doc_ids are pages of their own.  An empty table gives no
rows.  All columns of the input stay, whatever their names; ``n_chars`` of a changed text follows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspark.llm.common import materialize, small_enough

RATIO = 0.1
MIN_PAGES = 5
SALTS = 64

_WS = "' \\t\\n\\u000B\\u000C\\r'"
_SQL_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def boilerplate(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, hashes``: the boilerplate lines of each host that has some."""
    hashes = (f"array_distinct(transform(filter(split(text, '\\n'), x -> btrim(x, {_WS}) <> ''), "
              f"x -> xxhash64(btrim(x, {_WS}))))")
    pages = docs.select(F.col("source").alias("host"), "text").filter("host IS NOT NULL")
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    lines = (pages.select("host", F.explode(F.expr(hashes)).alias("line"))
             .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages))
    return (lines.join(totals, "host").filter(F.col("n") > F.lit(ratio) * F.col("pages"))
            .groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("hashes")))


def drop_site_lines(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES,
                    counts: bool = False) -> DataFrame:
    """``docs`` with the boilerplate lines of their hosts gone from ``text``; ``counts``
    adds ``n_lines`` (lines with a word) and ``n_dropped``."""
    columns = docs.columns
    listed = materialize(boilerplate(docs, ratio, min_pages).withColumnsRenamed({"host": "__host", "hashes": "__drop"}))
    if small_enough(listed, F.octet_length("__host") + 8 * F.size("__drop") + 32):
        joined = docs.join(F.broadcast(listed), F.col("source") == F.col("__host"), "left")
    else:
        salted = listed.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = (docs.withColumn("__of", F.floor(F.rand(23) * SALTS).cast("int"))
                  .join(salted, (F.col("source") == F.col("__host")) & (F.col("__of") == F.col("__salt")), "left"))
    blank = f"btrim(x, {_WS}) = ''"
    kept = F.expr(f"CASE WHEN __drop IS NOT NULL THEN array_join(filter(split(text, '\\n'), x -> {blank} OR "
                  f"NOT array_contains(__drop, xxhash64(btrim(x, {_WS})))), '\\n') ELSE text END")
    out = joined.withColumn("__cut", kept).withColumn(
        "__text", F.when(F.expr(f"btrim(__cut, {_WS}) = ''"), F.col("text")).otherwise(F.col("__cut")))
    n_lines = f"size(filter(split(%s, '\\n'), x -> NOT {blank}))"
    if counts:
        out = (out.withColumn("__n", F.coalesce(F.expr(n_lines % "text"), F.lit(0)).cast("bigint"))
               .withColumn("__m", F.coalesce(F.expr(n_lines % "__text"), F.lit(0)).cast("bigint")))
    extra = [F.col("__n").alias("n_lines"), (F.col("__n") - F.col("__m")).alias("n_dropped")] if counts else []
    changed = ~F.col("__text").eqNullSafe(F.col("text"))
    return out.select(*[
        F.col("__text").alias(c) if c == "text" else
        F.when(changed, F.length("__text").cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c == "n_chars" else
        F.col(f"`{c}`") for c in columns], *extra)


def op5(docs: DataFrame) -> DataFrame:
    light = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "source")
    return drop_site_lines(light, counts=True).select("doc_id", "source", "n_lines", "n_dropped", "text")


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
ln AS (
  SELECT r, doc_id, source, unnest(string_split(text, chr(10))) AS x,
    unnest(range(len(string_split(text, chr(10))))) AS p FROM d),
t AS (SELECT r, source, x, p, trim(x, {_SQL_WS}) AS k FROM ln),
n AS (SELECT source, k, count(DISTINCT r) AS n FROM t WHERE k <> '' AND source IS NOT NULL GROUP BY ALL),
tot AS (SELECT source, count(*) AS pages FROM d GROUP BY source),
bad AS (SELECT source, k FROM n JOIN tot USING (source) WHERE n >= {MIN_PAGES} AND n > CAST({RATIO} AS DOUBLE) * pages),
c AS (
  SELECT t.r, count(*) FILTER (WHERE t.k <> '') AS n_lines,
    count(*) FILTER (WHERE t.k <> '' AND bad.k IS NULL) AS m,
    coalesce(string_agg(t.x, chr(10) ORDER BY t.p) FILTER (WHERE bad.k IS NULL), '') AS cut
  FROM t LEFT JOIN bad ON t.source = bad.source AND t.k = bad.k GROUP BY t.r),
e AS (SELECT d.*, n_lines, m, cut, coalesce(m, 0) = 0 AS whole FROM d LEFT JOIN c USING (r))
SELECT doc_id, source, coalesce(n_lines, 0) AS n_lines, CASE WHEN whole THEN 0 ELSE n_lines - m END AS n_dropped,
  CASE WHEN whole THEN text ELSE cut END AS text FROM e
"""
