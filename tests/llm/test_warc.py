import base64
import hashlib

import pytest

from tidemark.llm import warc

DDL = "page_id long, url string, html string, sha256 string, record_id int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7) for r in rows], DDL).repartition(3)


ROWS = [
    (5, "http://a/1", "<p>same</p>"), (3, "http://a/2", "<p>same</p>"), (9, None, "<p>same</p>"), (1, "http://b", None),
    (2, "http://c", ""), (7, "http://d\r\nX: y", "é日本 \u0000 \r\n\r\n WARC/1.1"), (8, "http://e", "x" * 300_000),
    (None, "http://f", "<p>same</p>"), (3, "http://a/2", "<p>same</p>"), (None, "http://g", "only null"),
]


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("min_bytes", [0, 5, 10**6])
def test_records_come_back_as_they_were(spark, min_bytes):
    archive = warc.write(pages(spark, ROWS), min_bytes=min_bytes)
    assert archive.payloads.count() == len({t or "" for *_, t in ROWS})
    got = warc.read(archive).collect()
    first = {}
    for i, _, t in ROWS:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    want = []
    for i, url, t in ROWS:
        data = (t or "").encode()
        leader = first.get(t or "")
        revisit = len(data) >= min_bytes and leader is not None and i != leader
        refers = leader if revisit else None
        record = warc.header(i, url, len(data), sha1(t), refers, "2020-01-01T00:00:00Z") + (b"" if revisit else data) + b"\r\n\r\n"
        want.append((i, "revisit" if revisit else "response", refers, len(data), sha1(t), record))
    have = [(r.record_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, bytes(r.record)) for r in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)
    for r in got:
        said = warc.fields(bytes(r.record))
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        assert int(said["Content-Length"]) == len(block) - 4 and head.startswith(b"WARC/1.1\r\n")


def test_empty_table(spark):
    assert warc.read(warc.write(pages(spark, []))).collect() == []


def test_a_changed_payload_is_noticed(spark):
    import zstandard
    from pyspark.sql import functions as F

    archive = warc.write(pages(spark, ROWS[:1]))
    other = zstandard.ZstdCompressor().compress(b"forged")
    forged = warc.Archive(archive.payloads.withColumn("packed", F.lit(other)), archive.headers)
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read(forged).collect()
