"""Language identification by nearest centroids (operator 2).

A text is lower-cased, everything but letters counts as a gap, and its character 1-, 2- and
3-grams are hashed into ``DIMS`` counters; the vector is sqrt(count) x IDF, of length one.
Each language has several centroids (spherical k-means over its labelled texts).  A text
gets the language of the centroid with the highest cosine; it is rejected when that cosine
is below the language's limit.  The limit comes from the language's own labelled texts: a
little below what nearly all of them reach, and at most half of what they usually reach, so
that a language with copies of few texts alone does not reject all others.

The fit uses a bounded sample: the ``MOST_LANGUAGES`` commonest values of ``lang`` are learned,
from ``SAMPLE_DOCS`` labelled documents with a letter in all, divided evenly (though at least
``LEAST_PER_LANGUAGE`` each) and chosen by a hash of doc_id, never of the text's length.  Only
these vectors reach the driver.  Prediction is one pass over whole texts with no shuffle,
texts in slices of bounded length.

Cases: null text, or text without a letter: ``und``, score 0, rejected.  Rows with a null
doc_id are not held out and not learned from.  With no labelled text everything is ``und``.
Repeated rows and doc_ids get a row each; a repeated doc_id is sampled once a language.  An
empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from adspark.llm.common import arrow_schema

DIMS = 2048
SAMPLE_DOCS = 2400
LEAST_PER_LANGUAGE = 20
MOST_LANGUAGES = 200
CENTROIDS = 4
ROUNDS = 10
SLICE = 1 << 18          # characters of a text handled at once
REJECT_QUANTILE = 0.005  # of a language's labelled texts; a text is rejected below ...
REJECT_EASE = 0.8        # ... this share of the cosine that the others reach, or ...
REJECT_SHARE = 0.5       # ... this share of their median, whichever is less ...
REJECT_CHARS = 80        # ... eased for texts with fewer letters than this
UNKNOWN = "und"

_LETTERS: list = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        table = np.zeros(0x110000, dtype=bool)
        table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
        _LETTERS.append(table)
    return _LETTERS[0]


def ngram_counts(text: str) -> tuple[np.ndarray, int]:
    """Hashed 1- to 3-gram counts of the letters of a text, and its number of letters."""
    counts = np.zeros(DIMS, dtype=np.int64)
    n_letters = 0
    carry = np.array([32], dtype=np.uint32)  # the last two codes before a slice
    text = text.lower()
    for at in range(0, max(1, len(text)), SLICE):
        codes = np.frombuffer(text[at:at + SLICE].encode("utf-32-le", "surrogatepass"), dtype="<u4")
        is_letter = _letters()[codes]
        n_letters += int(is_letter.sum())
        codes = np.where(is_letter, codes, 32).astype(np.uint32)
        if at + SLICE >= len(text):
            codes = np.append(codes, np.uint32(32))
        codes = codes[(codes != 32) | (np.concatenate([carry[-1:], codes[:-1]]) != 32)]  # one space a gap
        c, k = np.concatenate([carry, codes]), carry.size
        m = max(k, 2)
        two = c[k - 1:-1] * np.uint32(31) + c[k:] if codes.size else codes
        three = c[m - 2:-2] * np.uint32(961) + c[m - 1:-1] * np.uint32(31) + c[m:] if c.size > m else codes[:0]
        mixed = np.concatenate([codes[codes != 32] + np.uint32(1), two + np.uint32(2), three + np.uint32(3)])
        mixed = mixed * np.uint32(2654435761)
        counts += np.bincount((mixed ^ (mixed >> np.uint32(15))) & np.uint32(DIMS - 1), minlength=DIMS)
        carry = c[-2:]
    return counts, n_letters


def vectors(texts: list[str | None], idf: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (rows of zeros for texts with no letter) and letters of each text."""
    out = np.zeros((len(texts), DIMS), dtype=np.float32)
    letters = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        if text:
            counts, letters[i] = ngram_counts(text)
            if letters[i]:
                out[i] = np.sqrt(counts)
    if idf is not None:
        out *= idf
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1), letters


def _ease(letters: np.ndarray) -> np.ndarray:
    """How much of a whole text's cosine a text with so many letters is held to."""
    return np.minimum(1.0, np.sqrt(letters / REJECT_CHARS))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray    # all languages' centroids, a row each
    language: np.ndarray     # of each centroid
    limits: np.ndarray       # of each language

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        vec, letters = vectors(texts, self.idf)
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        near = vec @ self.centroids.T
        best = near.argmax(axis=1)
        lang, score = self.language[best], near[np.arange(len(texts)), best]
        eased = self.limits[lang] * _ease(letters)
        known = letters > 0
        return ([self.languages[k] if ok else UNKNOWN for k, ok in zip(lang, known)],
                [float(min(1.0, max(0.0, s))) if ok else 0.0 for s, ok in zip(score, known)],
                [not ok or bool(s < e) for s, e, ok in zip(score, eased, known)])


def _cluster(rows: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means, seeded by farthest points from the mean's nearest row."""
    chosen = [int((rows @ rows.mean(axis=0)).argmax())]
    while len(chosen) < min(k, len(rows)):
        chosen.append(int((rows @ rows[chosen].T).max(axis=1).argmin()))
    centers = rows[chosen]
    for _ in range(ROUNDS):
        of = (rows @ centers.T).argmax(axis=1)
        sums = np.stack([rows[of == j].sum(axis=0) if (of == j).any() else centers[j] for j in range(len(centers))])
        centers = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centers


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame) -> Model:
    """The model of the labelled documents that are not held out."""
    usable = docs.select("doc_id", "lang", "text").filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text RLIKE '\\\\p{L}'")
    labelled = usable.filter(~held_out()).select("doc_id", "lang").distinct()
    common = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("_rows")).orderBy(F.desc("_rows"), "lang") \
        .limit(MOST_LANGUAGES).collect()
    if not common:
        return Model([], np.ones(DIMS, np.float32), np.zeros((0, DIMS), np.float32), np.zeros(0, int), np.zeros(0))
    each = max(LEAST_PER_LANGUAGE, SAMPLE_DOCS // len(common))
    # of a language with many rows only those with small hashes, several times as many as wanted, are ranked
    share = docs.sparkSession.createDataFrame([(r["lang"], 4.0 * each / r["_rows"]) for r in common], "lang string, _share double")
    order = Window.partitionBy("lang").orderBy("_h", "doc_id")
    chosen = (labelled.withColumn("_h", F.xxhash64("doc_id")).join(F.broadcast(share), "lang")
              .filter(F.pmod("_h", F.lit(1 << 30)) < F.col("_share") * F.lit(1 << 30))
              .withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= each).select("doc_id", "lang"))
    texts = (usable.join(F.broadcast(chosen), ["doc_id", "lang"])  # at most ``each`` rows a language
             .groupBy("doc_id", "lang").agg(F.max("text").alias("text")))

    schema = "doc_id bigint, lang string, letters bigint, vec binary"
    target = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            rows = batch.to_pydict()
            for at in range(0, len(rows["text"]), 64):
                vec, letters = vectors(rows["text"][at:at + 64], None)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": rows["doc_id"][at:at + 64], "lang": rows["lang"][at:at + 64], "letters": letters,
                     "vec": [v.astype("<f4").tobytes() if n else None for v, n in zip(vec, letters)]},
                    schema=target)

    got = texts.mapInArrow(run, schema).filter("vec IS NOT NULL").collect()
    got.sort(key=lambda r: (r["lang"], r["doc_id"]))
    if not got:
        return Model([], np.ones(DIMS, np.float32), np.zeros((0, DIMS), np.float32), np.zeros(0, int), np.zeros(0))
    vec = np.stack([np.frombuffer(r["vec"], dtype="<f4") for r in got])
    lang = np.array([r["lang"] for r in got])
    idf = (np.log((1 + len(vec)) / (1 + (vec > 0).sum(axis=0))) + 1).astype(np.float32)
    vec = vec * idf
    vec /= np.linalg.norm(vec, axis=1, keepdims=True)
    languages = sorted({r["lang"] for r in got})
    centers = [_cluster(vec[lang == name], CENTROIDS) for name in languages]
    letters = np.array([r["letters"] for r in got])
    limits = []
    for name, c in zip(languages, centers):
        near = (vec[lang == name] @ c.T).max(axis=1)
        low = np.quantile(near / _ease(letters[lang == name]), REJECT_QUANTILE)
        limits.append(min(REJECT_EASE * low, REJECT_SHARE * np.median(near)))
    return Model(languages, idf, np.concatenate(centers).astype(np.float32),
                 np.repeat(np.arange(len(languages)), [len(c) for c in centers]), np.array(limits))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred, score, rejected`` in front; names of the input that clash
    with these are left out."""
    added = "lang_pred string, score double, rejected boolean"
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = arrow_schema(added)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                pred, score, rejected = model.predict(part.column(keep.index("text")).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=f.type) for v, f in zip((pred, score, rejected), schema)] + part.columns,
                    names=["lang_pred", "score", "rejected", *keep])

    return rows.mapInArrow(run, StructType(_parse_datatype_string(added).fields + rows.schema.fields))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows that the model rejects; the columns stay as they are."""
    @F.pandas_udf("boolean")
    def ok(text: pd.Series) -> pd.Series:
        texts = [t if isinstance(t, str) else None for t in text]
        return pd.Series([not r for at in range(0, len(texts), 64) for r in model.predict(texts[at:at + 64])[2]], dtype=bool)

    return docs.filter(ok(F.col("text")))


def op2(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")
    named = identify(rows.select("doc_id", "text"), fit(rows))
    return named.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
