"""Dictionary-compressed WARC archives (operator 7).

Each archive is a ``.warc.zst`` stream: a leading skippable frame (magic 0x184D2A5D) holds
a Zstandard dictionary built from the archive's first records, then every record is one
frame compressed with it.  A writer task fills archives of at most ``ROLL_BYTES``
compressed bytes, so a reader never needs more than one archive in memory.  Spark's text
writer commits the files (safe under retries and lost executors, on any store); the
separator it puts after a row is an empty skippable frame, which every reader skips.

Payloads of at least ``MIN_SHARED`` bytes that occur more than once are stored once: the
page with the largest page_id is the ``response``, the others are ``revisit`` records that
name it.  Only the digests that repeat travel to the join, with an aggregate that combines
map-side, so one payload on a third of the pages is no hot task.

Cases: null html is an empty payload.  Rows that repeat the largest page_id of an equal
payload are responses too.  A null page_id counts as smallest; if all are null, all are
responses.  A null url leaves the target out; control and non-ASCII characters in a url
are percent-encoded.  An empty table writes no archive and reads back no rows.  Extra
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adspark.llm.common import arrow_schema, fresh_path, materialize, small_enough

MIN_SHARED = 1000            # smaller equal payloads are stored each time
DICT_BYTES = 64 << 10
SAMPLE_BYTES = 1 << 20       # records at the head of a task that its dictionary is built from
ROLL_BYTES = 32 << 20        # compressed bytes of an archive
LEVEL = 3

# fixed values of the formats
DICT_MAGIC = 0x184D2A5D      # skippable frame that carries the dictionary
SKIP_MAGIC = 0x184D2A50      # first of the 16 skippable-frame numbers
SEPARATOR = "P*M\x18\x00\x00\x00\x00"  # an empty skippable frame, 0x184D2A50, as text
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
          "target_uri string, payload binary")


def _urn(page_id) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page(urn: str | None):
    value = (urn or "").strip("<>").rpartition(":")[2]
    return None if value in ("", "null") else int(value)


def record(page_id, url, payload: bytes, refers_to) -> bytes:
    """The bytes of a response or (``refers_to`` given) a revisit record."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
            .encode())
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_urn(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))).replace('%', ''))}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of a record; the digest of a stored payload is checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stored = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind, size = fields["WARC-Type"], int(stored["Content-Length"])
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    uri = fields.get("WARC-Target-URI")
    return {"page_id": _page(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest,
            "record_type": kind, "refers_to": _page(fields.get("WARC-Refers-To")),
            "target_uri": None if uri is None else unquote(uri), "payload": payload if kind == "response" else None}


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or nothing where the records are too few to train one."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def frames(data: bytes) -> Iterator[tuple[int, int, int]]:
    """``(magic, start, end)`` of the frames of an archive, from the frame format alone."""
    at = 0
    while at < len(data):
        magic, = struct.unpack_from("<I", data, at)
        if SKIP_MAGIC <= magic < SKIP_MAGIC + 16:
            end = at + 8 + struct.unpack_from("<I", data, at + 4)[0]
        else:
            end = at + zstandard.frame_header_size(data[at:at + 18])
            last = False
            while not last:
                block = int.from_bytes(data[end:end + 3], "little")
                last, kind = bool(block & 1), (block >> 1) & 3
                end += 3 + (1 if kind == 1 else block >> 3)
            end += 4 if data[at + 4] & 4 else 0
        yield magic, at, end
        at = end


def read_archive(data: bytes) -> Iterator[dict]:
    """The records of one archive."""
    d = None
    for magic, start, end in frames(data):
        if magic == DICT_MAGIC:
            d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[start + 8:end]))
        elif not SKIP_MAGIC <= magic < SKIP_MAGIC + 16:
            yield parse((d or zstandard.ZstdDecompressor()).decompress(data[start:end]))


def mark_revisits(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, refers_to``: who repeats whose payload."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url",
                        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload"))
    key = F.when(F.col("size") >= MIN_SHARED, F.sha2("payload", 256))
    shared = materialize(rows.select("page_id", key.alias("sha")).filter("sha IS NOT NULL")
                         .groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("first"))
                         .filter("n > 1 AND first IS NOT NULL").select("sha", "first"))
    if small_enough(shared, F.lit(96)):
        shared = F.broadcast(shared)
    return (rows.withColumn("sha", key).join(shared, "sha", "left")
            .select("page_id", "url", "payload",
                    F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")))


def write_warc(pages: DataFrame, path: str) -> None:
    """Write all pages as archives under ``path/archive=.../``."""
    schema = "archive string, no int, frame binary"
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held: list[bytes] = []
        state = {"dict": None, "zstd": None, "archive": 0, "no": 0, "bytes": 0}

        def out(rows: list[tuple]) -> pa.RecordBatch:
            a, n, f = zip(*rows)
            return pa.RecordBatch.from_pydict({"archive": a, "no": n, "frame": f}, schema=target)

        def put(records: list[bytes]) -> Iterator[pa.RecordBatch]:
            if state["zstd"] is None:
                state["dict"] = build_dictionary(records)
                d = zstandard.ZstdCompressionDict(state["dict"]) if state["dict"] else None
                state["zstd"] = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=True)
            rows = []
            for data in records:
                if state["bytes"] >= ROLL_BYTES:
                    state.update(archive=state["archive"] + 1, no=0, bytes=0)
                if state["no"] == 0 and state["dict"]:
                    rows.append((f"{task:06d}-{state['archive']:04d}", 0,
                                 struct.pack("<II", DICT_MAGIC, len(state["dict"])) + state["dict"]))
                frame = state["zstd"].compress(data)
                state["no"] += 1
                state["bytes"] += len(frame)
                rows.append((f"{task:06d}-{state['archive']:04d}", state["no"], frame))
            if rows:
                yield out(rows)

        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256).to_pydict()
                records = [record(*r) for r in zip(rows["page_id"], rows["url"], rows["payload"], rows["refers_to"])]
                if state["zstd"] is None:
                    held += records
                    size += sum(map(len, records))
                    if size < SAMPLE_BYTES:
                        continue
                    records, held = held, []
                yield from put(records)
        if held:
            yield from put(held)

    (mark_revisits(pages).mapInArrow(run, schema)
     .sortWithinPartitions("archive", "no")  # the order of the rows; the writer asks for it by archive
     .select("archive", F.col("frame").cast("string").alias("value"))
     .write.mode("overwrite").partitionBy("archive").option("lineSep", SEPARATOR).text(path))


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """All records under ``path``."""
    target = arrow_schema(RECORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: list[dict] = []
                for row in read_archive(content.as_py()):
                    rows.append(row if payload else {**row, "payload": None})
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_pylist(rows, schema=target)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=target)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").schema(
        "path string, modificationTime timestamp, length bigint, content binary").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def archive_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages to a new folder in the shared checkpoint folder and read them back."""
    path = fresh_path(spark, "warc")
    write_warc(pages, path)
    return read_warc(spark, path, payload=False).drop("payload", "target_uri")


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT *, CAST(strlen(h) AS BIGINT) AS payload_bytes, max(page_id) OVER (PARTITION BY h) AS m FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= {MIN_SHARED} AND m IS DISTINCT FROM page_id THEN m END AS refers_to FROM q)
SELECT page_id, payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM r
"""
