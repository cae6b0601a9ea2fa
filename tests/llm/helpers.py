"""Small tables with every awkward row, shared by the operator tests."""

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
AWKWARD = [
    (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n ", None, None, 4), (None, "null id text", "fr", "b", 12),
    (4, "one", "en", "a", 3), (4, "one", "en", "a", 3), (4, "other text same id", "en", "b", 18),
    (5, "x" * 9000, "de", "a", 9000), (6, "word " * 3000, "de", "c", 15000),
    (7, "Üñï çødé \U0001f600 é   tab\there\nline\r\nend", "es", "c", 40), (8, "12345 !!! ###", None, "c", 13),
]


def docs(spark, rows, extra=True):
    """A documents table; ``extra`` adds columns whose names clash with internal ones."""
    df = spark.createDataFrame([tuple(r) + (None,) * (5 - len(r)) for r in rows], DOC_SCHEMA)
    if extra:
        for name in ("shard", "slot", "group", "key", "node", "n_words", "row_no", "size", "line", "spans", "id", "ids"):
            df = df.selectExpr("*", f"'clash' AS {name}")
    return df


def simple(spark, texts):
    return docs(spark, [(i, t, None, "s", None) for i, t in enumerate(texts)], extra=False)
