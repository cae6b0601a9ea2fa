"""Quality rules with host verdicts (operator 4), DataFrame functions only.

Every whole text is measured inside its row; only the measures travel.  Rule failures are
then summed by host (``source``) with map-side combine, the hosts' failure rates are shrunk
towards the corpus by an empirical beta prior (method of moments over hosts), and the
verdicts of failing hosts go back to their documents.  A document stays when it passes the
base rules and its own rules and its host passes: a host fails when the shrunk rate of any
rule is above ``HOST_LIMIT``, so a host with few documents is not judged by them alone.

Cases: null text counts as empty (no words: the base rules fail).  A null host is a host of
its own.  Repeated rows and doc_ids are rows of their own and count as such.  An empty
table gives no rows.  Equality of three-word windows is by 64-bit hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspark.llm.common import WS, materialize, small_enough, sql_lit

MIN_WORDS = 50
REPEAT_PERCENT = 50      # words in repeated three-word windows
SYMBOL_PERCENT = 20      # symbols to words
DUP_LINE_PERCENT = 30    # repeated lines to lines with a word
MIN_DUP_LINES = 5
WORD_LENGTH = (2, 15)    # mean word length outside fails
HOST_LIMIT = 0.5
PRIOR_RANGE = (1.0, 1000.0)  # weight of the prior in documents

_WS = "' \\t\\n\\u000B\\u000C\\r'"
_SYMBOLS = "'#*$%&|<>'"
RULES = {
    "short": f"n_words < {MIN_WORDS}",
    "repeats": f"100 * n_repeat_words > {REPEAT_PERCENT} * n_words",
    "symbols": f"100 * n_symbols > {SYMBOL_PERCENT} * n_words",
    "lines": f"n_dup_lines >= {MIN_DUP_LINES} AND 100 * n_dup_lines > {DUP_LINE_PERCENT} * n_lines",
    "lengths": f"n_words > 0 AND (word_chars < {WORD_LENGTH[0]} * n_words OR word_chars > {WORD_LENGTH[1]} * n_words)",
}
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _repeat_words(words: str) -> str:
    """Words inside three-word windows that occur twice or more.  Hashes of the windows are
    sorted with their places, equal neighbours marked, and the marked windows' places
    walked in order, each adding the words that the one before did not cover."""
    windows = f"transform(sequence(0, size({words}) - 3), i -> xxhash64({words}[i], {words}[i + 1], {words}[i + 2]))"
    marked = _let("array_sort(transform(h, (x, i) -> named_struct('x', x, 'i', i)))", "t",
                  "array_sort(transform(filter(t, (s, j) -> s.x <=> get(t, j - 1).x OR s.x <=> get(t, j + 1).x), "
                  "s -> s.i))")
    covered = (f"aggregate({marked}, named_struct('last', -3, 'n', 0L), "
               "(a, p) -> named_struct('last', p, 'n', a.n + least(3, p - a.last)), a -> a.n)")
    some = _let(windows, "h", f"CASE WHEN size(array_distinct(h)) = size(h) THEN 0L ELSE {covered} END")
    return f"CASE WHEN size({words}) < 4 THEN 0L ELSE {some} END"


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id, host`` and the measures of every text."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").alias("host"),
                       F.coalesce("text", F.lit("")).alias("text"))
    bare = f"btrim(text, {_WS})"
    words = f"CASE WHEN {bare} = '' THEN CAST(array() AS array<string>) ELSE split({bare}, '[ \\t-\\r]+') END"
    counts = _let(words, "w", f"named_struct('n_words', CAST(size(w) AS bigint), 'n_repeat_words', {_repeat_words('w')})")
    lines = _let(f"filter(split(text, '\\n'), x -> btrim(x, {_WS}) <> '')", "l",
                 "named_struct('n_lines', CAST(size(l) AS bigint), 'n_dup_lines', "
                 "CAST(size(l) - size(array_distinct(l)) AS bigint))")
    return rows.selectExpr(
        "doc_id", "host", f"{counts} AS c", f"{lines} AS l",
        f"CAST(length(translate(text, {_WS}, '')) AS bigint) AS word_chars",
        f"CAST(length(text) - length(translate(text, {_SYMBOLS}, '')) AS bigint) AS n_symbols",
    ).selectExpr("doc_id", "host", "c.n_words", "word_chars", "n_symbols", "l.n_lines", "l.n_dup_lines",
                 "c.n_repeat_words")


def host_rates(rows: DataFrame) -> DataFrame:
    """``host, n`` and each rule's failure rate, shrunk by a beta prior that the hosts'
    spread gives: mean m and variance v of the rates (weighted by documents) make a prior
    of weight m (1 - m) / v - 1."""
    hosts = rows.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.expr(rule)).alias(f"f_{name}") for name, rule in RULES.items()])
    total = hosts.agg(F.sum("n").alias("t_n"), *[(F.sum(f"f_{r}") / F.sum("n")).alias(f"m_{r}") for r in RULES])
    mean = total.first()  # one row
    if not mean["t_n"]:
        return hosts.select("host", "n", *[F.lit(0.0).alias(r) for r in RULES])
    spread = hosts.agg(*[(F.sum(F.col("n") * F.pow(F.col(f"f_{r}") / F.col("n") - mean[f"m_{r}"], 2)) / mean["t_n"])
                         .alias(r) for r in RULES]).first()  # one row
    out = []
    for r in RULES:
        m, v = mean[f"m_{r}"], spread[r]
        weight = PRIOR_RANGE[1] if v <= 0 else min(max(m * (1 - m) / v - 1, PRIOR_RANGE[0]), PRIOR_RANGE[1])
        out.append(((F.col(f"f_{r}") + m * weight) / (F.col("n") + weight)).alias(r))
    return hosts.select("host", "n", *out)


def judge(rows: DataFrame) -> DataFrame:
    """``rows`` (materialised measures) with ``base_failed, rule_failed, host_failed, kept``."""
    failing = materialize(host_rates(rows).filter(" OR ".join(f"{r} > {HOST_LIMIT}" for r in RULES))
                          .select(F.col("host").alias("_host"), F.lit(True).alias("_bad")))
    if small_enough(failing, F.octet_length(F.coalesce("_host", F.lit("")))):
        failing = F.broadcast(failing)
    return (rows.join(failing, F.col("host").eqNullSafe(F.col("_host")), "left")
            .withColumn("base_failed", F.expr(f"({RULES['short']}) OR ({RULES['repeats']})"))
            .withColumn("rule_failed", F.expr(" OR ".join(f"({x})" for x in RULES.values())))
            .withColumn("host_failed", F.coalesce("_bad", F.lit(False)))
            .withColumn("kept", F.expr("NOT base_failed AND NOT rule_failed AND NOT host_failed"))
            .drop("_host", "_bad"))


def host_quality(docs: DataFrame) -> DataFrame:
    """One row per document with its measures and verdicts."""
    return judge(materialize(measures(docs)))


def op4(docs: DataFrame) -> DataFrame:
    return host_quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                     "base_failed", "kept")


_SQL_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_SQL_RULES = ", ".join(f"sum(CASE WHEN {rule} THEN 1 ELSE 0 END) AS f_{name}" for name, rule in RULES.items())
ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, doc_id, host, text, list_filter(regexp_split_to_array(text, '[ \\t-\\r]+'), lambda x: x <> '') AS w,
    list_filter(string_split(text, chr(10)), lambda x: trim(x, {_SQL_WS}) <> '') AS l FROM d),
win AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS p, unnest(list_transform(range(1, len(w) - 1),
    lambda i: w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2])) AS s FROM w WHERE len(w) >= 3),
rep AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, s) AS n FROM win) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT p + k) AS n FROM rep, (VALUES (0), (1), (2)) t(k) GROUP BY r),
m AS (
  SELECT w.r, doc_id, host, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN cov USING (r)),
h AS (SELECT host, count(*) AS n, {_SQL_RULES} FROM m GROUP BY host),
mu AS (SELECT {", ".join(f"sum(f_{r}) / sum(n) AS m_{r}" for r in RULES)} FROM h),
va AS (SELECT {", ".join(f"sum(n * pow(f_{r} / n - m_{r}, 2)) / sum(n) AS v_{r}" for r in RULES)} FROM h, mu),
pr AS (SELECT {", ".join(
    f"m_{r}, CASE WHEN v_{r} <= 0 THEN {PRIOR_RANGE[1]} ELSE least(greatest(m_{r} * (1 - m_{r}) / v_{r} - 1, "
    f"{PRIOR_RANGE[0]}), {PRIOR_RANGE[1]}) END AS w_{r}" for r in RULES)} FROM mu, va),
bad AS (SELECT host, {" OR ".join(f"(f_{r} + m_{r} * w_{r}) / (n + w_{r}) > {HOST_LIMIT}" for r in RULES)} AS bad FROM h, pr)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  ({RULES['short']}) OR ({RULES['repeats']}) AS base_failed,
  NOT ({" OR ".join(f"({x})" for x in RULES.values())}) AND NOT bad AS kept
FROM m JOIN bad ON m.host IS NOT DISTINCT FROM bad.host
"""
