"""Secret scan (operator 8), DataFrame functions only.

Base kinds are fixed patterns (assignments, access keys, hex runs).  The method adds spans
by two character Markov models, of random strings and of ordinary identifiers: the log of a
token's probability under the one less that under the other must be high per character.
Both are trained on every document: values that the base patterns found (random) and the
other tokens of the texts (ordinary), by bigram counts.  The models decide on every token with
a letter or digit; rulers (``====``) are none.  The least ratio is set on the same tokens for
each class of them (without a letter, with one): ``MARGIN`` above that of
all but ``ORDINARY_SHARE`` of the class's ordinary long tokens, and ``MARGIN`` at least.  A
class with fewer than ``LEAST_TOKENS`` of those takes the limit of all ordinary long tokens if
it has as many random ones, and else adds no span; with fewer than ``LEAST_TOKENS`` random ones
in all, no class does.  So numbers, which the base patterns hardly label, are found only where
they are less likely among ordinary numbers than nearly all of these.

What the models cannot tell from ordinary tokens stays: with those of sf0.1, of random keys of
16 to 40 characters 86 to 97 % are found in base 62, 56-58 % of mixed-case letters alone, at
most 15 % of one case, and next to none of digits alone.

Positions come from the pieces between matches: a pattern's matches and the text split at
them interleave, so the running sum of lengths gives every start in code points.

Cases: null text counts as empty.  Repeated rows and doc_ids are rows of their own.  An
empty table gives no rows.  Extra columns are ignored (``scan``) or kept (``redact``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adspark.llm.common import materialize

# fixed values: the base patterns and the least lengths of what they must find
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20
KINDS = ("assign", "access", "hex", "markov")

TOKEN = "[A-Za-z0-9+/_=-]"
MIN_TOKEN = 16          # candidate tokens are this long at least
LEAST_TOKENS = 20       # labelled tokens that a limit is set by
ORDINARY_SHARE = 0.001  # of a class's ordinary long tokens may lie above the limit less the margin
MARGIN = 0.1            # nats a character
LETTERS = 66            # characters that tokens are made of
PRIOR = 200.0           # weight of the character's own frequency
MARK = "[secret]"

# the class of a token t
CLASS = "IF(t RLIKE '[A-Za-z]', 1, 0)"

_SPANS = "array<struct<start:int,stop:int>>"


def _quoted(regex: str) -> str:
    return "'" + regex.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _found(text: str, regex: str, test: str, when: str) -> str:
    """Matches, the pieces between them and which matches hold, where ``when`` (a cheap
    test that no text with a match fails) is true; else null."""
    q = _quoted(regex)
    return (f"CASE WHEN {when} THEN transform(array(named_struct('m', regexp_extract_all({text}, {q}, 0), "
            f"'p', split({text}, {q}, -1), 'v', {test})), s -> s)[0] END")


def _starts(found: str) -> str:
    """Spans of the matches that hold."""
    return (f"CASE WHEN {found} IS NULL OR size({found}.m) = 0 THEN CAST(array() AS {_SPANS}) ELSE "
            f"aggregate(sequence(0, size({found}.m) - 1), named_struct('at', 0, 'o', CAST(array() AS {_SPANS})), "
            f"(a, i) -> named_struct('at', a.at + length({found}.p[i]) + length({found}.m[i]), 'o', "
            f"CASE WHEN {found}.v[i] THEN array_append(a.o, named_struct('start', a.at + length({found}.p[i]), "
            f"'stop', a.at + length({found}.p[i]) + length({found}.m[i]))) ELSE a.o END), a -> a.o) END")


def _blanked(text: str, found: str) -> str:
    """The text with the matches that hold replaced by spaces, lengths kept."""
    return (f"CASE WHEN {found} IS NULL OR size({found}.m) = 0 THEN {text} ELSE concat(array_join(transform({found}.m, "
            f"(m, i) -> concat({found}.p[i], if({found}.v[i], repeat(' ', length(m)), m))), ''), "
            f"{found}.p[size({found}.m)]) END")


def _base(text: str) -> dict[str, str]:
    """The base kinds' matches in a text column."""
    q = _quoted(ASSIGN)
    return {
        "assign": _found(text, ASSIGN, f"transform(regexp_extract_all({text}, {q}, 2), x -> length(x) >= {ASSIGN_VALUE})",
                         f"{text} RLIKE '(?i)passw|secret|token|api_?key'"),
        "access": _found(text, ACCESS, f"transform(regexp_extract_all({text}, {_quoted(ACCESS)}, 0), "
                                       f"x -> length(x) >= {ACCESS_LENGTH})", f"contains({text}, 'AKIA')"),
        "hex": _found(text, HEX, f"transform(regexp_extract_all({text}, {_quoted(HEX)}, 0), x -> true)",
                      f"{text} RLIKE '(?<![0-9a-f])[0-9a-f]{{24}}'"),
    }


def _scanned(rows: DataFrame) -> DataFrame:
    """``rows`` with ``__text`` and the base matches ``__assign, __access, __hex``."""
    out = rows.withColumn("__text", F.coalesce("text", F.lit("")))
    for kind, found in _base("__text").items():
        out = out.withColumn(f"__{kind}", F.expr(found))
    return out


def _masked(rows: DataFrame) -> DataFrame:
    """``__rest``: the text without what the base kinds found.  The patterns are run again
    on what is left, so that no base span is found by two kinds."""
    out = rows.withColumn("__r1", F.expr(_blanked("__text", "__assign")))
    out = out.withColumn("__a2", F.expr(_base("__r1")["access"])).withColumn("__r2", F.expr(_blanked("__r1", "__a2")))
    return out.withColumn("__h2", F.expr(_base("__r2")["hex"])).withColumn("__rest", F.expr(_blanked("__r2", "__h2")))


def train(docs: DataFrame) -> tuple[list[float], list[float]]:
    """Log ratios of the two models by (character, next character), 128 x 128, and for each
    class the least ratio a character of a random token (infinite: none is), from all of ``docs``."""
    rows = _masked(_scanned(docs.select("text")))
    random = "concat(coalesce(regexp_extract_all(array_join(coalesce(__assign.m, array()), '\\n'), " \
             f"{_quoted(ASSIGN)}, 2), array()), coalesce(__access.m, array()), coalesce(__hex.m, array()))"
    ordinary = f"regexp_extract_all(__rest, '{TOKEN}{{8,}}', 0)"
    tokens = materialize(rows.select(F.explode(F.expr(f"array(named_struct('label', 1, 't', filter({random}, x -> length(x) >= 8)), "
                                          f"named_struct('label', 0, 't', {ordinary}))")).alias("x")) \
        .select("x.label", F.explode("x.t").alias("t")).groupBy("label", "t").agg(F.count(F.lit(1)).alias("n")))
    pairs = tokens.select("label", "n", F.explode(F.expr(
        "transform(array(split(t, '')), c -> transform(sequence(0, size(c) - 2), i -> "
        "ascii(c[i]) * 128 + ascii(c[i + 1])))[0]")).alias("pair")) \
        .groupBy("label", "pair").agg(F.sum("n").alias("n")).collect()  # at most 2 x LETTERS^2 rows
    counts = ({}, {})
    first, second = ([0] * 128, [0] * 128), ([0] * 128, [0] * 128)
    for r in pairs:
        counts[r["label"]][r["pair"]] = r["n"]
        first[r["label"]][r["pair"] // 128] += r["n"]
        second[r["label"]][r["pair"] % 128] += r["n"]

    total = [sum(x) for x in second]

    def log(label: int, pair: int) -> float:
        """A character after another, smoothed by how common it is in all."""
        a, b = divmod(pair, 128)
        alone = (second[label][b] + 1) / (total[label] + LETTERS)
        return math.log((counts[label].get(pair, 0) + PRIOR * alone) / (first[label][a] + PRIOR))

    table = [round(log(1, p) - log(0, p), 4) for p in range(128 * 128)]
    long = (tokens.filter(f"length(t) >= {MIN_TOKEN} AND t RLIKE '[0-9A-Za-z]'")
            # rounded, so that the exact percentile holds few values
            .select("label", "n", F.expr(CLASS).alias("class"), F.expr(f"round({_score('t', table)} / length(t), 2)").alias("mean")))
    seen = {(r["class"], r["label"]): r for r in long.cube("class", "label").agg(
        F.sum("n").alias("n"), F.expr(f"percentile(mean, {1 - ORDINARY_SHARE}, n)").alias("high")).collect()}  # 9 rows at most
    enough = lambda *key: key in seen and seen[key]["n"] >= LEAST_TOKENS

    def limit(kind: int) -> float:
        own = enough(kind, 0)
        if not enough(None, 1) or not (own or enough(kind, 1)):
            return math.inf
        ordinary = seen.get((kind if own else None, 0))
        return MARGIN if ordinary is None else max(MARGIN, ordinary["high"] + MARGIN)

    return table, [limit(kind) for kind in range(2)]


def _score(token: str, table: list[float]) -> str:
    """The log ratio of a token."""
    # one constant array, folded by the optimizer
    ratios = f"CAST(split('{','.join(f'{x:g}' for x in table)}', ',') AS array<double>)"
    return (f"transform(array(transform(split({token}, ''), c -> ascii(c))), c -> aggregate(sequence(1, size(c) - 1), 0D, "
            f"(a, i) -> a + get({ratios}, c[i - 1] * 128 + c[i])))[0]")


def _markov(table: list[float], least: list[float]) -> str:
    """Candidate tokens of ``__rest`` and which of them the models call random."""
    regex = f"(?<!{TOKEN}){TOKEN}{{{MIN_TOKEN},}}"
    limit = f"get(array({', '.join('CAST(NULL AS double)' if x == math.inf else f'{x!r}D' for x in least)}), {CLASS})"
    test = (f"transform(regexp_extract_all(__rest, {_quoted(regex)}, 0), t -> t RLIKE '[0-9A-Za-z]' AND "
            f"coalesce({_score('t', table)} >= {limit} * length(t), false))")
    return _found("__rest", regex, test, f"__rest RLIKE {_quoted(f'(?<!{TOKEN}){TOKEN}{{{MIN_TOKEN}}}')}")


def find_spans(docs: DataFrame, table: list[float], least: list[float]) -> DataFrame:
    """``docs`` with ``__spans``: array of (start, kind number, stop), by start then kind."""
    rows = _masked(_scanned(docs)).withColumn("__markov", F.expr(_markov(table, least)))
    every = ", ".join(f"transform({_starts(f'__{k}')}, s -> named_struct('start', s.start, 'kind', {n}, 'stop', s.stop))"
                      for n, k in enumerate(KINDS))
    return rows.withColumn("__spans", F.expr(f"array_sort(concat({every}))"))


def _listed(spans: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, s -> concat(elt(s.kind + 1, {names}), ':', s.start, ':', s.stop)), ',')"


def scan(docs: DataFrame) -> DataFrame:
    """One row per document with its counts of base kinds and all spans."""
    count = "CAST(size(filter(__spans, s -> s.kind = {0})) AS bigint) AS n_{1}"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return find_spans(rows, *train(rows)).selectExpr("doc_id", "__spans").selectExpr(
        "doc_id", *[count.format(n, k) for n, k in enumerate(KINDS[:3])],
        f"sha2({_listed('filter(__spans, s -> s.kind < 3)')}, 256) AS base_sha256", f"{_listed('__spans')} AS spans")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``MARK`` (overlapping spans by one);
    ``n_chars``, where there is one, follows.  Texts without a span stay as they are."""
    columns = docs.columns
    rows = find_spans(docs, *train(docs)).select(*[F.col(f"`{c}`") for c in columns], "__spans")
    cut = (f"aggregate(__spans, named_struct('at', 0, 'o', CAST(array() AS array<string>)), (a, s) -> named_struct("
           "'at', greatest(a.at, s.stop), 'o', CASE WHEN s.start >= a.at THEN concat(a.o, array(substring(text, a.at + 1, "
           f"s.start - a.at), '{MARK}')) ELSE a.o END), a -> concat(array_join(a.o, ''), substring(text, a.at + 1)))")
    rows = rows.withColumn("__new", F.expr(f"CASE WHEN size(__spans) = 0 THEN text ELSE {cut} END"))
    return rows.select(*[F.col("__new").alias(c) if c == "text" else
                         F.when(F.size("__spans") > 0, F.length("__new").cast(docs.schema[c].dataType))
                         .otherwise(F.col(c)).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in columns])
