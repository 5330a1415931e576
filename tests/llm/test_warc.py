import gzip
import hashlib
import os
import re
import zlib

import pytest
from pyspark.sql import functions as F

from visitwise.llm import warc

PAGE = "page_id long, url string, html string"


@pytest.fixture
def pages(spark):
    def run(rows):
        return spark.createDataFrame(rows, PAGE).repartition(3)
    return run


BIG = "<p>é</p>" * 40
ROWS = [(5, "http://a/1", BIG), (3, "http://a/2", BIG), (9, "http://a/\r\n3", BIG), (7, None, None), (8, "http://b", ""),
        (1, "http://c", "short"), (2, "http://c", "short"), (11, "http://d", "x" * 3_000_000), (3, "http://a/2", BIG),
        (None, "http://e", BIG), (None, "http://f", "only without an id " * 20), (12, "http://g", "ü" * 50),
        (10, "http://g", "ü" * 50), (13, "h", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9)]


def brute(rows):
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        ids = [k for k, _, h in rows if h == html and k is not None]
        first = min(ids, default=None) if len(body) >= 100 else None
        again = first is not None and i != first
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response",
                    first if again else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("id", "payload_bytes", "payload_digest", "record_type", "refers_to")
                   .collect()), key=str)


def test_round_trip_matches_brute_force(spark, pages, tmp_path):
    df = pages(ROWS)
    for c in ("key", "uri", "body", "digest", "first", "a.b", "record_type"):
        df = df.withColumn(c, F.lit("x"))
    assert got(warc.archive_and_read(df, str(tmp_path / "w"))) == brute(ROWS)
    back = {r["record_id"]: r for r in warc.read_warc(spark, str(tmp_path / "w")).collect()}
    kinds = [r["record_type"] for r in back.values()]
    assert set(kinds) == {"warcinfo", "response", "revisit"}
    for r in back.values():
        if r["record_type"] == "response":
            assert r["payload_digest"] == "sha256:" + hashlib.sha256(r["payload"]).hexdigest()
        if r["record_type"] == "revisit":
            assert back[r["refers_to"]]["payload_digest"] == r["payload_digest"] and r["payload"] == b""
    assert "http://a/%0D%0A3" in {r["target_uri"] for r in back.values()}


def test_empty_table(spark, pages):
    assert warc.archive_and_read(pages(ROWS).where("false")).count() == 0


def test_hot_payload_and_many_files(spark, pages, tmp_path):
    rows = [(i, f"u{i}", BIG if i % 3 else f"{i} " * 60) for i in range(1, 400)]
    path = str(tmp_path / "w")
    warc.write_warc(warc.page_records(pages(rows)), path, fileBytes=2000)
    files = [f for f in os.listdir(path) if f.endswith(".warc.gz")]
    assert len(files) > 10
    assert got(warc.archived_pages(spark, path)) == brute(rows)
    many = warc.read_warc(spark, path, partitionBytes=3000).rdd.getNumPartitions()
    assert many > 5 > warc.read_warc(spark, path).rdd.getNumPartitions()


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_files_are_readable_by_other_means(spark, pages, tmp_path, compression):
    path = str(tmp_path / "w")
    warc.write_warc(warc.page_records(pages(ROWS)), path, compression=compression)
    assert got(warc.archived_pages(spark, path)) == brute(ROWS)
    raw = b""
    for f in sorted(os.listdir(path)):
        if not f.startswith("_") and not f.startswith("."):
            with (gzip.open if compression == "gzip" else open)(f"{path}/{f}", "rb") as fh:
                raw += fh.read()
    assert raw.startswith(b"WARC/1.1\r\n") and BIG.encode() in raw


def test_predicates_reach_the_reader_and_skip_blocks(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(warc.page_records(pages(ROWS)), path)
    df = warc.read_warc(spark, path).where("record_type = 'revisit' and target_uri like 'http://a/%'")
    assert {r["target_uri"] for r in df.collect()} == {"http://a/1", "http://a/%0D%0A3"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"(^|[ )])Filter \W", plan, re.M), plan  # decided in the source alone
    rest = warc.read_warc(spark, path).where("headers['x-row-id'] = '3' and record_type <> 'warcinfo'")
    assert rest.count() == 2
    assert "payload" not in warc.read_warc(spark, path, payload=False).columns
    nulls = warc.read_warc(spark, path).where("refers_to is null and content_length > 100000").collect()
    assert [len(r["payload"]) for r in nulls] == [3_000_000]


def test_unwanted_blocks_are_not_inflated(tmp_path):
    body = os.urandom(3_000_000)
    records = [warc.record_bytes({"record_type": k, "record_id": f"<urn:{k}>", "payload": body})
               for k in ("response", "resource", "metadata")]
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(map(warc.gzip_member, records)))
    import pyarrow.fs as pafs

    class Counted:
        def __init__(self, f):
            self.f, self.read = f, 0

        def size(self):
            return self.f.size()

        def read_at(self, n, at):
            out = self.f.read_at(n, at)
            self.read += len(out)
            return out

    f = Counted(pafs.LocalFileSystem().open_input_file(str(path)))
    found = list(warc.records(f, True, lambda h: h["warc-type"] == "metadata", True))
    assert [p for *_, p in found] == [body]
    assert f.read < 2.1 * 3_000_000  # the last block, and the starts of the others
    f = Counted(pafs.LocalFileSystem().open_input_file(str(path)))
    assert len(list(warc.records(f, True, lambda h: True, False))) == 3 and f.read < 3.5 * (1 << 20)


def test_archives_of_others(spark, tmp_path):
    """Chunked and gzipped bodies, folded headers, members without lengths, one member with two records."""
    def rec(kind, block, extra=b""):
        return (b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\nWARC-Record-ID: <urn:x>\r\n" + extra
                + b"Content-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n" % len(block)
                + block + b"\r\n\r\n")
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n2;x=y\r\nde\r\n0\r\n\r\n"
    zipped = (b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\nContent-Type: text/plain\r\n\r\n"
              + gzip.compress(b"hello"))
    deflated = b"HTTP/1.1 200 OK\r\nContent-Encoding: deflate\r\n\r\n" + zlib.compress(b"flat")
    a = rec(b"response", chunked, b"WARC-Target-URI: http://x\r\n /y\r\n")
    b, c = rec(b"response", zipped), rec(b"response", deflated)
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(a + b) + gzip.compress(c))
    (tmp_path / "two.warc").write_bytes(b + a)
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted(bytes(r["payload"]) for r in rows) == [b"abcde", b"abcde", b"flat", b"hello", b"hello"]
    assert {r["content_type"] for r in rows if bytes(r["payload"]) == b"hello"} == {"text/plain"}
    assert {r["target_uri"] for r in rows if bytes(r["payload"]) == b"abcde"} == {"http://x /y"}
    assert warc.read_warc(spark, str(tmp_path)).where("record_type = 'revisit'").count() == 0
    (tmp_path / "bad.warc").write_bytes(b"not a record\r\n\r\n")
    with pytest.raises(Exception, match="no WARC record"):
        warc.read_warc(spark, str(tmp_path / "bad.warc")).collect()


def test_only_committed_files_are_read(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(warc.page_records(pages(ROWS)), path)
    stray = warc.gzip_member(warc.record_bytes({"record_type": "response", "record_id": "<urn:lost>"}))
    (tmp_path / "w" / "part-00000-lost-00000.warc.gz").write_bytes(stray)
    assert got(warc.archived_pages(spark, path)) == brute(ROWS)
    warc.write_warc(warc.page_records(pages(ROWS[:4])), path, mode="overwrite")
    assert got(warc.archived_pages(spark, path)) == brute(ROWS[:4])
