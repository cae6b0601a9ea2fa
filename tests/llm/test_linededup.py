from collections import Counter, defaultdict

import duckdb
import pytest

from adspark.llm import linededup

from .helpers import AWKWARD, docs

WS = " \t\n\x0b\x0c\r"


def brute(rows, ratio, min_pages):
    total, pages = Counter(), defaultdict(Counter)
    for _, text, _, host, *_ in rows:
        if host is not None:
            total[host] += 1
            pages[host].update({x.strip(WS) for x in (text or "").split("\n")} - {""})
    out = []
    for doc, text, _, host, *_ in rows:
        if text is None:
            out.append((doc, None))
            continue
        bad = {k for k, n in pages[host].items() if n >= min_pages and n > ratio * total[host]} if host is not None else ()
        cut = "\n".join(x for x in text.split("\n") if not x.strip(WS) or x.strip(WS) not in bad)
        out.append((doc, cut if cut.strip(WS) else text))  # a page of nothing else is a copy
    return out


def site(n=30):
    rows = [(i, f"Home | About \nunique text of page {i} which is long enough to stay\n\n{'Terms apply' if i % 3 else 'x'}", None,
             "h", None) for i in range(n)]
    rows += [(100 + i, "a copied page\nwith two lines", None, "h", None) for i in range(n // 2)]
    return rows + [(200 + i, f"Home | About\npage {i} of another host", None, None, None) for i in range(9)]


def test_boilerplate_goes_and_copies_stay(spark):
    rows = site() + AWKWARD
    for ratio, least in ((0.1, 5), (0.5, 5), (0.3, 1)):
        got = linededup.drop_site_lines(docs(spark, rows), ratio, least).collect()
        assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == sorted(brute(rows, ratio, least), key=repr)
    table = docs(spark, rows)
    out = linededup.drop_site_lines(table)
    assert out.columns == table.columns and {r["slot"] for r in out.collect()} == {"clash"}


def test_frames_go_from_short_pages_too(spark):
    frame = "Home | About | Contact | a frame that is much longer than the pages in it"
    rows = [(i, f"{frame}\npage {i}\n{frame} ", None, "h", None) for i in range(20)]
    rows += [(100 + i, f"{frame}\n\n", None, "h", None) for i in range(5)]  # nothing of their own: copies
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in linededup.op5(docs(spark, rows)).collect()}
    assert got == {i: (f"page {i}", 3, 2) if i < 100 else (t, 1, 0) for i, t, *_ in rows}


def test_salted_join(spark, monkeypatch):
    rows = site() + AWKWARD
    want = sorted(map(tuple, linededup.op5(docs(spark, rows)).collect()), key=repr)
    monkeypatch.setattr(linededup, "small_enough", lambda *a: False)
    assert sorted(map(tuple, linededup.op5(docs(spark, rows)).collect()), key=repr) == want
    assert sum(r[3] for r in want) > 30


def test_empty(spark):
    assert linededup.op5(docs(spark, [])).count() == 0


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_oracle(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '/root/testdata/{sf}/documents.parquet'")
    got = [tuple(r) for r in linededup.op5(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")).collect()]
    want = con.execute(linededup.ORACLE).fetchall()
    assert sorted(got) == sorted(want)
    assert any(2 * len(r[4]) < n for r, n in zip(sorted(want), [x for _, x in sorted(con.execute(
        "SELECT doc_id, length(text) FROM documents").fetchall())])) or sf == "sf0.01"  # pages that are mostly frame
