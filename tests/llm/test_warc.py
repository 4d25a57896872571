"""WARC archives: round trips, and the files as other readers see them."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
from collections import Counter, defaultdict
from pathlib import Path

import pytest

from textloom.llm.warc import Inflated, WarcConfig, archive_pages, normalise_archives, read_archives, record_at, rewrite

SCHEMA = "page_id long, url string, html string, digest string, key string, payload string, bytes string"
LONG = "<p>" + "é\r\n\r\nWARC/1.1\r\n" * 200
PAGES = [
    (1, "http://a/ b?q=ü\n", LONG), (7, "http://a/7", LONG), (7, "http://a/7", LONG), (3, None, LONG), (None, "http://n", LONG),
    (4, "http://x", "x" * 999), (5, "http://x", "x" * 999), (6, "http://y", "y" * 1000), (-8, "http://y", "y" * 1000),
    (9, "", None), (10, "http://e", ""), (11, "http://big", "0123456789" * 300_000), (None, None, "z" * 5000), (None, "u", "z" * 5000),
    (12, "http://w", "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"),
]


def table(spark, pages):
    return spark.createDataFrame([(*p, *"abcd") for p in pages], SCHEMA).repartition(3)


def wanted(pages) -> Counter:
    same = defaultdict(list)
    for i, _, html in pages:
        if len((html or "").encode()) >= 1000 and i is not None:
            same[html].append(i)
    out = Counter()
    for i, _, html in pages:
        payload = (html or "").encode()
        keeper = max(same[html]) if same.get(html) else i
        revisit = keeper != i
        out[i, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None] += 1
    return out


@pytest.mark.parametrize("file_bytes", [64 << 20, 3_000])
def test_round_trip(spark, tmp_path, file_bytes):
    config = WarcConfig(file_bytes=file_bytes, task_bytes=2_000)
    got = archive_pages(table(spark, PAGES), folder=str(tmp_path), config=config)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(tuple(r) for r in got.collect()) == wanted(PAGES)
    payloads = Counter(bytes(r.payload) for r in read_archives(spark, f"{tmp_path}/members", 10_000, config, with_payload=True).collect() if r.record_type == "response")
    assert payloads == Counter((html or "").encode() for i, _, html in PAGES if html != LONG or i == 7 or i is None) - Counter({LONG.encode(): 1, b"y" * 1000: 1})
    monolithic, members = (sorted((tmp_path / d).glob("*.warc.gz")) for d in ("monolithic", "members"))
    assert len(monolithic) == len(members) >= (3 if file_bytes < 10_000 else 1)
    for whole, cut in zip(monolithic, members, strict=True):
        assert gzip.decompress(whole.read_bytes()) == gzip.decompress(cut.read_bytes())
        lines = [json.loads(line) for line in Path(str(cut).replace(".warc.gz", ".cdxj")).read_text().splitlines()]
        assert [x["offset"] for x in lines[1:]] == [x["offset"] + x["length"] for x in lines[:-1]]
        data = cut.read_bytes()
        assert lines[-1]["offset"] + lines[-1]["length"] == len(data)
        for x in lines:
            record = gzip.decompress(data[x["offset"] : x["offset"] + x["length"]])
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n") and x["id"].encode() in record
    assert not list(tmp_path.rglob("*attempt*"))


def test_written_again(spark, tmp_path):
    """A repeated run replaces its files."""
    for _ in range(2):
        rows = archive_pages(table(spark, PAGES).coalesce(1), folder=str(tmp_path)).count()
    assert rows == len(PAGES)


def test_empty(spark, tmp_path):
    got = archive_pages(table(spark, PAGES).limit(0), folder=str(tmp_path))
    assert got.collect() == [] and dict(got.dtypes) == {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"}


def test_text_ids(spark, tmp_path):
    pages = spark.createDataFrame([("a:+ %é", "u", "x" * 2000), ("B", "u", "x" * 2000)], "page_id string, url string, html string")
    assert {(r.page_id, r.refers_to) for r in archive_pages(pages, folder=str(tmp_path)).collect()} == {("a:+ %é", None), ("B", "a:+ %é")}


def record(body: bytes, kind: bytes = b"resource", extra: bytes = b"") -> bytes:
    return b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\n" + extra + b"Content-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"


def test_foreign_archives(spark, tmp_path):
    """Other writers' records: no ids, folded headers, members of several records, zeros at the end."""
    (tmp_path / "in").mkdir()
    some = [record(b"one"), record(b""), record(b"x" * 3_000_000, b"metadata", b"X-Long: a\r\n b\r\n")]
    path = tmp_path / "in" / "other.warc.gz"
    path.write_bytes(gzip.compress(some[0] + some[1]) + gzip.compress(some[2][:100]) + gzip.compress(some[2][100:]) + b"\0" * 512)
    files = spark.createDataFrame([(str(path),)], "path string")
    (made,) = normalise_archives(files, str(tmp_path / "out")).collect()
    assert made.records == 3
    lines = [json.loads(line) for line in (tmp_path / "out" / "other.cdxj").read_text().splitlines()]
    assert [x["type"] for x in lines] == ["resource", "resource", "metadata"]
    with open(made.path, "rb") as source:
        fields, _, payload = record_at(source, lines[2]["offset"], lines[2]["length"])
    assert fields["x-long"] == "a b" and payload == b"x" * 3_000_000
    assert sorted(r.payload_bytes for r in read_archives(spark, str(tmp_path / "out"), made.bytes).collect()) == [0, 3, 3_000_000]


@pytest.mark.parametrize("cut", [lambda d: d[:-9], lambda d: gzip.compress(gzip.decompress(d)[:-40]), lambda d: gzip.compress(b"GET / HTTP/1.1\r\n\r\n")])
def test_damaged(tmp_path, cut):
    path = tmp_path / "a.warc.gz"
    path.write_bytes(cut(gzip.compress(record(b"x" * 100))))
    with pytest.raises((EOFError, ValueError)):
        rewrite(str(path), str(tmp_path / "b.warc.gz"), WarcConfig())
    assert not (tmp_path / "b.warc.gz").exists()


def test_wrong_digest(spark, tmp_path):
    archive_pages(table(spark, [(1, "u", "abc")]), folder=str(tmp_path))
    (whole,) = (tmp_path / "monolithic").glob("*.gz")
    whole.write_bytes(gzip.compress(gzip.decompress(whole.read_bytes()).replace(b"\r\n\r\nabc", b"\r\n\r\nabd")))
    made = normalise_archives(spark.createDataFrame([(str(whole),)], "path string"), str(tmp_path / "again"))
    with pytest.raises(Exception, match="another payload"):
        read_archives(spark, str(tmp_path / "again"), made.first().bytes).collect()


def test_inflates_in_pieces():
    data = record(b"y" * 5_000_000) * 3
    inflated = Inflated(io.BytesIO(gzip.compress(data)))
    most = total = 0
    while inflated.header():
        for piece in inflated.pieces(5_000_000):
            total += len(piece)
            most = max(most, len(inflated.held))
        inflated.end_of_record()
    assert total == 15_000_000 and most < 3 << 20
