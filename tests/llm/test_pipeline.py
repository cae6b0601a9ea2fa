import pytest

import corpus_pipeline
from adspark.llm import langid

from .helpers import AWKWARD, docs
from .test_linededup import brute as brute_lines
from .test_neardup import brute as brute_near
from .test_packing import VOCAB, check_packed, whole
from .test_secrets import ASSIGN, base


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_duplicates", "secret_scan", "packing"]


def redacted(text):
    out, at = [], 0
    for start, _, stop in base(text):
        if start >= at:
            out += [text[at:start], "[secret]"]
        at = max(at, stop)
    return "".join(out) + text[at:]


def test_every_stage_against_brute_force(spark, tmp_dir):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    now, steps = table, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, "unused").write.parquet(f"{tmp_dir}/{name}")
        before, now = now, spark.read.parquet(f"{tmp_dir}/{name}")
        steps[name] = (before.collect(), now.collect())
        if name != "packing":
            assert now.columns == table.columns and now.dtypes == table.dtypes
    rows = lambda table: [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in table]

    before, after = steps["language_id"]
    rejected = langid.fit(table).predict([r["text"] for r in before])[2]
    assert sorted(rows(after)) == sorted(r for r, no in zip(rows(before), rejected) if not no)
    before, after = steps["line_dedup"]
    assert sorted((r["doc_id"], r["text"]) for r in after) == sorted(brute_lines(rows(before), 0.1, 5))
    assert all(r["n_chars"] == len(r["text"]) for r in after)
    before, after = steps["near_duplicates"]
    stay = [r for r, b in zip(rows(before), brute_near([r[:2] for r in rows(before)])) if b[0] == b[1]]
    assert sorted(rows(after)) == sorted(stay) and len(after) < len(before)
    before, after = steps["secret_scan"]
    got = {r["doc_id"]: r["text"] for r in after}
    assert len(after) == len(before) and any("[secret]" in t for t in got.values())
    for r in before:
        if base(r["text"]):
            assert not [m for m in ASSIGN.finditer(got[r["doc_id"]]) if len(m[2]) >= 6]
        elif got[r["doc_id"]] != r["text"]:
            assert "[secret]" in got[r["doc_id"]]
    assert sum(got[r["doc_id"]] == redacted(r["text"]) for r in before) > 0.99 * len(before)
    before, after = steps["packing"]
    check_packed(after, [(r["doc_id"], whole(r["text"])) for r in before])


@pytest.mark.parametrize("rows", [[], AWKWARD])
def test_awkward_tables(spark, tmp_dir, rows):
    docs(spark, rows).write.parquet(f"{tmp_dir}/documents.parquet")
    out = corpus_pipeline.run(spark, tmp_dir).collect()
    assert len(out) >= (1 if rows else 0) and {r["doc_id"] for r in out} <= {r[0] for r in rows}
    assert VOCAB == corpus_pipeline.BYTE_VOCAB
