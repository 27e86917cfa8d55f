"""Archives: round trips, plain and foreign files, pushed filters, and the crawl's revisits against brute force."""

import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from entitymart.llm import warc

PAGE = "<html>" + "x" * 200 + "</html>"


@pytest.fixture
def pages(spark):
    def make(rows):
        return spark.createDataFrame(rows, "page_id long, url string, html string").select("*", F.lit(1).alias("payload"), F.lit("z").alias("digest"), F.lit("q").alias("row"))

    return make


def expected(rows):
    """By hand: sorted by id, the first of equal payloads of 100 bytes is the response."""
    seen, out = {}, []
    for page_id, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (html or "").encode()
        digest = hashlib.sha256(raw).hexdigest()
        if len(raw) >= 100 and digest in seen:
            out.append((page_id, len(raw), digest, "revisit", seen[digest]))
        else:
            seen.setdefault(digest, page_id)
            out.append((page_id, len(raw), digest, "response", None))
    return sorted(out, key=str)


def stored(spark, df, path):
    warc.archive(df, path)
    rows = warc.crawl(warc.read(spark, path)).collect()
    assert all(r["digest_agrees"] for r in rows)
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=str)


MESSY = [
    (1, "http://a/1", PAGE),
    (2, "http://a/2", PAGE),
    (2, "http://a/2", PAGE),
    (3, None, "short"),
    (4, "http://a/4", "short"),
    (5, "http://a/5", None),
    (6, "http://a/6", ""),
    (None, "http://a/n", PAGE),
    (None, None, "n" * 150),
    (None, None, "n" * 150),
    (-7, "http://a/\r\nX-Page-Id: 99\r\n\r\n", "é日" * 60),
    (8, "http://a/8", "é日" * 60),
    (9, "http://a/9", "nul\x00 \r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 20),
    (10, "http://a/10", "long " * 400_000),
    (11, "http://a/11", "a" * 99),
    (12, "http://a/12", "a" * 99),
    (13, "http://a/13", "b" * 100),
    (14, "http://a/14", "b" * 100),
]


@pytest.mark.parametrize("hot", [1000, 1])
def test_crawl_equals_brute_force(spark, pages, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(warc, "HOT_GROUPS", hot)
    assert stored(spark, pages(MESSY), str(tmp_path / "a")) == expected(MESSY)


def test_crawl_of_the_pages_and_of_none(spark, sf, pages, tmp_path):
    df = spark.read.parquet(f"{sf}/pages.parquet")
    doubled = df.union(df.withColumn("page_id", F.col("page_id") + 10_000))
    rows = [(r["page_id"], r["url"], r["html"]) for r in doubled.collect()]
    assert stored(spark, doubled, f"file://{tmp_path}/b") == expected(rows)
    assert stored(spark, pages([]), str(tmp_path / "c")) == []


def test_payloads_are_stored_once_and_files_are_gzip(spark, pages, tmp_path):
    warc.archive(pages([(k, f"http://a/{k}", os.urandom(20_000).hex() if k == 0 else None) for k in range(1)] * 30), str(tmp_path / "a"))
    files = [f for f in os.listdir(tmp_path / "a") if f.endswith(".gz")]
    raw = b"".join(gzip.decompress((tmp_path / "a" / f).read_bytes()) for f in files)
    assert raw.count(b"WARC-Type: response\r\n") == 1 and raw.count(b"WARC-Type: revisit\r\n") == 29 and len(raw) < 60_000


def numbered(spark, n, path, **columns):
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "revisit").otherwise("response").alias("record_type"),
        F.concat(F.lit("<urn:x:"), F.col("id").cast("string"), F.lit(">")).alias("record_id"),
        F.concat(F.lit("http://h"), (F.col("id") % 5).cast("string"), F.lit("/"), F.col("id").cast("string")).alias("target_uri"),
        F.repeat(F.col("id").cast("string"), 2000).cast("binary").alias("payload"),
        F.create_map(F.lit("X-Kind"), (F.col("id") % 2).cast("string")).alias("headers"),
    )
    warc.write(df.coalesce(1), path)


def test_filters_are_pushed_and_payloads_of_other_records_are_not_inflated(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "a")
    numbered(spark, 300, path)
    df = warc.read(spark, path).where("record_type = 'response' and target_uri like 'http://h2/%' and content_length > 4000")
    ids = sorted(r["record_id"] for r in df.select("record_id").collect())
    assert ids == sorted(f"<urn:x:{k}>" for k in range(300) if k % 3 and k % 5 == 2 and len(str(k)) > 1)
    left = warc.WarcReader(warc.StructType(), {"path": path})
    rest = list(left.pushFilters([warc.ds.EqualTo(("record_type",), "response"), warc.ds.GreaterThan(("date",), "2"), warc.ds.EqualTo(("file",), "f")]))
    assert [f.attribute[0] for f in rest] == ["date", "file"] and len(left.tests) == 1
    only = warc.read(spark, path, ["record_id", "offset"], **{"header.X-Kind": "1"})
    assert only.columns == ["record_id", "offset"] and only.count() == 150
    # What is stepped over is read as headers alone: the first 4 KB of each member.
    inflated = []
    real = warc.zlib.decompressobj

    class Counted:
        def __init__(self, *a):
            self.it = real(*a)

        def __getattr__(self, name):
            return getattr(self.it, name)

        def decompress(self, raw):
            out = self.it.decompress(raw)
            inflated.append(len(raw))
            return out

    monkeypatch.setattr(warc.zlib, "decompressobj", Counted)
    big = tmp_path / "big.warc.gz"
    rows = [{"record_type": "response", "record_id": f"<{k}>", "payload": os.urandom(500_000)} for k in range(3)]
    big.write_bytes(b"".join(warc.member(warc.record(r)) for r in rows))
    got = [(f["warc-record-id"], len(b)) for _, f, b in warc.records(str(big), 0, 1 << 40, lambda f: f["warc-record-id"] == "<1>")]
    assert len(got) == 1 and got[0][0] == "<1>" and got[0][1] > 500_000 and sum(inflated) < 530_000


def test_plans_cut_at_record_starts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "CUT_BYTES", 2000)
    monkeypatch.setattr(warc, "FILE_BYTES", 40_000)
    numbered(spark, 500, str(tmp_path / "whole"))
    writer = warc.WarcWriter(str(tmp_path / "cut"), False)
    batches = warc.read(spark, str(tmp_path / "whole")).select("record_type", "record_id", "target_uri", "payload").toArrow().to_batches()
    writer.commit([writer.write(iter(batches)), None])
    for most in (1, 5000, 1 << 30):
        reader = warc.WarcReader(warc.StructType(), {"path": str(tmp_path / "cut"), "partitionbytes": str(most)})
        parts = reader.partitions()
        found = sorted(f["warc-record-id"] for p in parts for path, a, b in p.parts for _, f, _ in warc.records(path, a, b))
        assert found == sorted(f"<urn:x:{k}>" for k in range(500)) and (len(parts) == 1) == (most == 1 << 30)


def test_files_of_lost_tasks_do_not_count(spark, tmp_path):
    path = str(tmp_path / "a")
    numbered(spark, 20, path)
    (tmp_path / "a" / "lost.warc.gz").write_bytes(warc.member(warc.record({"record_type": "response", "record_id": "<lost>"})))
    assert warc.read(spark, path).count() == 20
    numbered(spark, 5, path)
    assert warc.read(spark, path).count() == 25
    warc.write(warc.read(spark, path).limit(3).select("record_type", "record_id", "payload"), path, "overwrite")
    assert warc.read(spark, path).count() == 3


def test_foreign_archives(spark, tmp_path):
    """Plain archives, members without lengths, folded headers, blocks that are not HTTP."""
    one = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <i>\r\nContent-Type: application/warc-fields\r\nContent-Length: 7\r\n\r\na: b\r\n!\r\n\r\n"
    two = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://a/\r\n  b\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: 45\r\n\r\nHTTP/1.0 404 Not\r\nContent-Length: 7\r\n\r\nWARC/1.\r\n\r\n"
    two = two.replace(b"Content-Length: 45", b"Content-Length: 46", 1) if len(two.split(b"\r\n\r\n", 1)[1]) - 4 == 46 else two
    (tmp_path / "p.warc").write_bytes(one + two)
    (tmp_path / "g.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two))
    for name in ("p.warc", "g.warc.gz"):
        rows = warc.read(spark, str(tmp_path / name)).orderBy("offset").collect()
        assert [bytes(r["payload"]) for r in rows] == [b"a: b\r\n!", b"WARC/1."]
        assert rows[1]["http_status"] == 404 and rows[1]["http_length"] == 7 and rows[1]["target_uri"] == "http://a/ b"
    assert warc.read(spark, str(tmp_path)).count() == 4
    (tmp_path / "bad.warc.gz").write_bytes(warc.member(one)[:-20])
    with pytest.raises(Exception, match="cut off"):
        warc.read(spark, str(tmp_path / "bad.warc.gz")).count()
