"""Web archives: an index first, then the records it names by coalesced reads.

Archives are plain WARC files, one per task that writes. An index of them has
the file, offset, length, address and digest of every record; it is made by
going from header to header. Readers then fetch byte ranges, never a whole
archive for a few records.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stored, whole_text

LEAST_REVISIT = 1_000  # bytes from which equal payloads are stored once
SCAN_BYTES = 4 << 20  # read at a time while an index is made
READ_BYTES = 8 << 20  # ranges are joined up to this size
TASK_BYTES = 4 * READ_BYTES  # and a task reads about this much
READ_GAP = 64 << 10  # and over gaps up to this one
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _described(pages: DataFrame, repeated: DataFrame) -> DataFrame:
    """`pages` (page_id, url, digest, bytes) with type and headers of each record."""
    typed = pages.join(repeated, ["digest", "bytes"], "left")
    revisits = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    address = F.regexp_replace("url", "[\r\n]+", "%0A")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"), F.lit(END),
    )
    common = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: "), _urn(F.col("page_id")), F.lit(f"\r\nWARC-Date: {DATE}"),
        F.when(address.isNotNull(), F.concat(F.lit("\r\nWARC-Target-URI: "), address)).otherwise(""),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit("\r\nX-Payload-Length: "), F.col("bytes").cast("string"),
        F.lit("\r\nContent-Type: application/http; msgtype=response"),
    )
    revisit = F.concat(
        common, F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "),
        _urn(F.col("response_id")), F.lit("\r\nContent-Length: 0" + END),
    )
    response = F.concat(
        common, F.lit("\r\nContent-Length: "),
        (F.octet_length(http) + F.col("bytes")).cast("string"), F.lit(END), http,
    )
    is_revisit = F.col("record_type") == "revisit"
    return (
        typed.withColumn("record_type", F.when(revisits, "revisit").otherwise("response"))
        .withColumn("head", F.when(is_revisit, revisit).otherwise(response))
    )


def write_archives(pages: DataFrame, path: str, least_revisit: int = LEAST_REVISIT) -> DataFrame:
    """Write `pages` (page_id, url, html) as WARC archives below `path`; gives their index.

    Of equal payloads of at least `least_revisit` bytes the one with the
    largest page_id is a response, the others revisit it. Rows that repeat
    that very page_id are responses too. NULL html is an empty payload, a NULL
    url gives no address, NULL page_ids are never the largest; where a group
    has no other, all are responses. No rows give an empty index.

    Payloads are written where they are read; only digests are exchanged, and
    the payloads too where the repeated digests are too many to broadcast. The
    text sink ends every record as the format asks.
    """
    payload = whole_text("html")
    facts = [
        F.col("page_id"), F.col("url").cast("string").alias("url"),
        F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"),
    ]
    repeated = stored(
        pages.select(*facts).filter(F.col("bytes") >= least_revisit).groupBy("digest", "bytes")
        .agg(F.max("page_id").alias("response_id"), F.count("*").alias("copies"))
        .filter("copies > 1").drop("copies"),
        "warc-repeated",
    )
    record = F.concat("head", F.when(F.col("record_type") == "revisit", "").otherwise(F.col("payload")))
    (
        _described(pages.select(*facts, payload.alias("payload")), repeated)
        .select(record.alias("value"))
        .write.option("lineSep", END).text(f"{path}/archives")
    )
    return index_archives(pages.sparkSession, path)


INDEX = (
    "path string, offset long, length long, page_id long, url string, digest string, "
    "record_type string"
)
_INDEX = pa.schema([
    ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()),
    ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string()),
])


def index_archives(spark: SparkSession, path: str) -> DataFrame:
    """The index of the archives below `path`, stored under `path`/index."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/archives")
        .select("path", "length").filter("length > 0")
    )
    # a task takes whole files, each of which one task has written
    spread = files.repartition(max(1, files.count()), "path")
    indexed = spread.mapInArrow(_indexed, INDEX)
    indexed.write.parquet(f"{path}/index")
    return spark.read.schema(INDEX).parquet(f"{path}/index")


def _open(path: str):
    from pyarrow import fs

    # Spark writes a local path as file:/x, the reader wants file:///x
    uri = "file:///" + path[6:].lstrip("/") if path.startswith("file:/") else path
    system, name = fs.FileSystem.from_uri(uri)
    return system.open_input_file(name)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows = []
            with _open(path) as stream:
                for offset, length, fields in headers(stream, size):
                    rows.append({"path": path, "offset": offset, "length": length, **_named(fields)})
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=_INDEX)
                        rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=_INDEX)


def headers(stream, size: int) -> Iterator[tuple[int, int, dict[str, str]]]:
    """Offset, length and header fields of the records of an archive, one after the other.

    Blocks are passed over by their length; what is read at a time is bounded
    by SCAN_BYTES or the longest header.
    """
    at, begin, data = 0, 0, b""
    while at < size:
        end = data.find(b"\r\n\r\n", at - begin) if begin <= at < begin + len(data) else -1
        if end < 0:
            wanted = SCAN_BYTES if begin != at else 2 * max(len(data), SCAN_BYTES // 2)
            if begin == at and begin + len(data) >= size:
                raise ValueError(f"no record begins at byte {at}")
            begin, data = at, stream.read_at(min(wanted, size - at), at)
            continue
        fields, block = _headers(data[at - begin:end + 4])
        length = block + int(fields["Content-Length"]) + len(END)
        yield at, length, fields
        at += length


def _headers(record: bytes) -> tuple[dict[str, str], int]:
    """The named fields of a record and where its block begins."""
    end = record.index(b"\r\n\r\n")
    lines = record[:end].decode("utf-8").split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines), end + 4


READ = (
    "page_id long, record_type string, url string, digest string, bytes long, "
    "refers_to long, payload binary"
)
_READ = pa.schema([
    ("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()),
    ("digest", pa.string()), ("bytes", pa.int64()), ("refers_to", pa.int64()),
    ("payload", pa.binary()),
])


def _number(urn: str | None) -> int | None:
    text = (urn or "none").removeprefix("<urn:page:").removesuffix(">")
    return None if text == "none" else int(text)


def _named(fields: dict[str, str]) -> dict:
    return {
        "page_id": _number(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"],
        "url": fields.get("WARC-Target-URI"),
        "digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
    }


def _parsed(record: bytes) -> dict:
    fields, begin = _headers(record)
    payload = None
    if fields["WARC-Type"] == "response":
        block = record[begin:begin + int(fields["Content-Length"])]
        payload = block[block.index(b"\r\n\r\n") + 4:]
    return _named(fields) | {
        "bytes": int(fields["X-Payload-Length"]),
        "refers_to": _number(fields.get("WARC-Refers-To")), "payload": payload,
    }


def coalesced(ranges: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Reads (path, offset, length, records within) for sorted (path, offset, length)."""
    path, begin, end, inside = None, 0, 0, []
    for file, offset, length in ranges:
        joins = file == path and offset - end <= READ_GAP and offset + length - begin <= READ_BYTES
        if not joins:
            if inside:
                yield path, begin, end - begin, inside
            path, begin, end, inside = file, offset, offset, []
        inside.append((offset - begin, length))
        end = max(end, offset + length)
    if inside:
        yield path, begin, end - begin, inside


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def ranges():
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(3)))

    opened, stream = None, None
    for path, offset, length, inside in coalesced(ranges()):
        if path != opened:
            opened, stream = path, _open(path)
        data = stream.read_at(length, offset)
        rows = [_parsed(data[at:at + size]) for at, size in inside]
        yield pa.RecordBatch.from_pylist(rows, schema=_READ)


def read_records(index: DataFrame) -> DataFrame:
    """The records that the rows of `index` (path, offset, length) name.

    Columns: page_id, record_type, url, digest, bytes (of the full payload),
    refers_to (of a revisit), payload (NULL for a revisit). Ranges are sorted
    by file and offset and near ones read together. There is a task for every
    few reads, told by the bytes to read and not by the size of the index.
    """
    tasks = (index.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES + 1
    return (
        index.select("path", "offset", "length")
        .withColumn("stretch", F.expr(f"offset div {TASK_BYTES}"))
        .repartition(tasks, "path", "stretch").sortWithinPartitions("path", "offset")
        .select("path", "offset", "length")
        .mapInArrow(_read, READ)
    )


def archived(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write `pages` to archives (by default in the shared folder) and read all of it back."""
    return read_records(write_archives(pages, path or scratch_path(pages.sparkSession, "warc")))
