"""Archives by an exact round trip."""

import hashlib
import random
from pathlib import Path

import pytest

from tallyweave.llm import warc
from tallyweave.llm.warc import READ_GAP, archived, coalesced, read_records, write_archives

SCHEMA = "page_id long, url string, html string, digest string, archive string"


def sample():
    pick = random.Random(15)
    bodies = ["ü" * 500, "x" * 999, "y" * 1000, "a\r\n\r\nb" * 300, "", "<p>\x00 \U0001d518</p>" * 90]
    data = [(i, f"https://e.org/{i}\n", pick.choice(bodies) + ("" if i % 3 else str(i)), "d", "a") for i in range(300)]
    return [*data, (500, None, None, None, None), (501, "u", "long " * 200_000, "d", "a"),
            (None, "n", "y" * 1000, "d", "a"), (None, "n", "alone" * 400, "d", "a"), (None, "m", "alone" * 400, "d", "a")]


def expected(data):
    groups = {}
    for page_id, _, html, *_ in data:
        groups.setdefault(html or "", []).append(page_id)
    out = []
    for page_id, url, html, *_ in data:
        html = html or ""
        body = html.encode()
        top = max((i for i in groups[html] if i is not None), default=None)
        revisit = len(body) >= 1000 and len(groups[html]) > 1 and top is not None and page_id != top
        out.append((page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response",
                    top if revisit else None, None if revisit else body, url and url.replace("\n", "%0A")))
    return sorted(map(str, out))


def got(df):
    return sorted(str((r.page_id, r.bytes, r.digest, r.record_type, r.refers_to,
                       None if r.payload is None else bytes(r.payload), r.url)) for r in df.collect())


def test_round_trip(spark, tmp_path):
    index = write_archives(spark.createDataFrame(sample(), SCHEMA).repartition(3), str(tmp_path / "warc"))
    assert got(read_records(index)) == expected(sample())
    some = index.filter("page_id % 7 = 0")
    left = {str(r.page_id) for r in read_records(some).collect()}
    assert left == {str(row[0]) for row in sample() if row[0] is not None and row[0] % 7 == 0}


def test_files_follow_the_format(spark, tmp_path):
    index = write_archives(spark.createDataFrame(sample(), SCHEMA).coalesce(1), str(tmp_path / "warc"))
    (file,) = Path(tmp_path).glob("warc/archives/part-*.txt")
    data = file.read_bytes()
    rows = index.collect()
    assert sum(row.length for row in rows) == len(data) and len(rows) == len(sample())
    for row in rows:
        record = data[row.offset:row.offset + row.length]
        head, _, rest = record.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert len(rest) == int(fields["Content-Length"]) + 4


@pytest.mark.parametrize("size", [40, 1_000, 4 << 20])
def test_headers(spark, tmp_path, monkeypatch, size):
    index = write_archives(spark.createDataFrame(sample(), SCHEMA).coalesce(1), str(tmp_path / "warc"))
    (file,) = Path(tmp_path).glob("warc/archives/part-*.txt")
    monkeypatch.setattr(warc, "SCAN_BYTES", size)
    with warc._open(str(file)) as stream:
        found = [(at, length) for at, length, _ in warc.headers(stream, file.stat().st_size)]
    assert found == sorted((row.offset, row.length) for row in index.collect())


def test_rows(spark):
    assert archived(spark.createDataFrame([], SCHEMA)).count() == 0
    twice = [(1, "u", "z" * 2000, "d", "a")] * 2
    assert {r.record_type for r in archived(spark.createDataFrame(twice, SCHEMA)).collect()} == {"response"}


def test_coalesced():
    ranges = [("a", 0, 10), ("a", 10, 5), ("a", 15 + READ_GAP, 5), ("a", 21 + 2 * READ_GAP, 5), ("b", 0, 3)]
    reads = list(coalesced(iter(ranges)))
    assert [(p, o, n) for p, o, n, _ in reads] == [("a", 0, 20 + READ_GAP), ("a", 21 + 2 * READ_GAP, 5), ("b", 0, 3)]
    assert [len(inside) for *_, inside in reads] == [3, 1, 1]
