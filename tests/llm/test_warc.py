import glob
import hashlib

import zstandard
from pyspark.sql import functions as F

from adspark.llm import warc

LONG = "<p>" + "shared payload " * 100
ROWS = [(1, "http://a/1", LONG), (2, "http://a/2", LONG), (3, None, LONG), (4, "http://a/é\r\nX: y", "short"),
        (5, "http://a/5", "short"), (6, "http://a/6", None), (None, "http://a/7", LONG), (8, "http://a/%41 b", "x" * 200_000),
        (9, "u", "é" * 500), (10, "u", "é" * 500), (10, "u", "é" * 500)]


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("frame", F.lit("clash")) \
        .withColumn("archive", F.lit(1))


def expected(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        first = max(same) if same and len(data) >= 1000 else None
        refers = first if first is not None and first != page else None
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def test_round_trip(spark):
    got = warc.archive_round_trip(spark, table(spark, ROWS)).collect()
    assert sorted(map(tuple, got), key=repr) == expected(ROWS)


def test_payloads_and_urls_come_back(spark, tmp_dir):
    warc.write_warc(table(spark, ROWS), tmp_dir + "/w")
    got = warc.read_warc(spark, tmp_dir + "/w").collect()
    by_page = {r["page_id"]: r for r in got}
    assert by_page[8]["payload"].decode() == "x" * 200_000 and by_page[8]["target_uri"] == "http://a/%41 b"
    assert by_page[4]["target_uri"] == "http://a/é\r\nX: y" and by_page[3]["target_uri"] is None
    assert by_page[1]["payload"] is None and by_page[1]["refers_to"] == 3


def test_files_are_plain_zstandard_with_a_leading_dictionary(spark, tmp_dir):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").coalesce(1)
    warc.write_warc(pages, tmp_dir + "/w")
    n = 0
    for name in glob.glob(tmp_dir + "/w/*/part-*"):
        data = open(name, "rb").read()
        (magic, start, end), *rest = warc.frames(data)
        assert magic == warc.DICT_MAGIC and rest[-1][2] == len(data)
        d = zstandard.ZstdCompressionDict(data[start + 8:end])
        assert d.dict_id() != 0
        for m, a, b in rest:
            if not warc.SKIP_MAGIC <= m < warc.SKIP_MAGIC + 16:
                n += zstandard.ZstdDecompressor(dict_data=d).decompress(data[a:b]).startswith(b"WARC/1.1\r\n")
    assert n == 250


def test_archives_roll(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(warc, "ROLL_BYTES", 20_000)
    data = [warc.record(i, "u", bytes(str(i), "ascii") * 9, None) for i in range(5)]
    assert [warc.parse(d)["page_id"] for d in data] == list(range(5))


def test_empty(spark):
    assert warc.archive_round_trip(spark, table(spark, [])).count() == 0
    assert warc.archive_round_trip(spark, table(spark, [(None, None, None)])).collect()[0]["record_type"] == "response"
