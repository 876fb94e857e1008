"""A content-addressed archive of WARC records.

``write`` stores three kinds of rows in the shared folder and nothing twice:

* ``payloads``: the bytes of each distinct payload once, compressed, under their SHA-256;
* ``headers``: per record its exact header bytes (WARC and HTTP) and the digest of its payload.

``read`` joins them, verifies both digests of every payload against its bytes, and returns the original records.  Of
records with equal payloads of at least ``min_bytes`` bytes, that with the smallest id is the response and the others are
revisits that refer to it; smaller payloads are always responses.  Equality is that of SHA-256, and all members of a
group must agree in SHA-1 and length, or the write fails.

Defined cases: a null payload is empty, a null url leaves out the target header; repeated rows with the smallest id are
responses all of them; a null id is smallest only among null ids and stays null; other columns are not read; an empty
table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, stored

RECORD_SCHEMA = (
    "record_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, record binary"
)
NAMESPACE = uuid.NAMESPACE_URL
BATCH_BYTES = 8 << 20


@dataclass(frozen=True)
class Archive:
    payloads: DataFrame
    headers: DataFrame


def record_urn(record_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'record:{record_id}')}>"


def _clean(url: str) -> str:
    return "".join(c for c in url if c not in "\r\n")


def header(record_id: int | None, url: str | None, length: int, sha1: str, refers_to: int | None, date: str) -> bytes:
    """WARC header and, after it, the HTTP header with which the record's block begins."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    revisit = refers_to is not None
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_urn(record_id)}"]
    lines += [f"WARC-Date: {date}"] + ([f"WARC-Target-URI: {_clean(url)}"] if url else [])
    lines += [f"WARC-Payload-Digest: sha1:{sha1}", "Content-Type: application/http;msgtype=response"]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_urn(refers_to)}",
        ]
    lines.append(f"Content-Length: {len(http) + (0 if revisit else length)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def fields(head: bytes) -> dict[str, str]:
    """The named fields of a WARC header; the block's HTTP header is not looked at."""
    warc = head.split(b"\r\n\r\n", 1)[0].decode()
    return dict(line.split(": ", 1) for line in warc.split("\r\n")[1:])


def write(
    pages: DataFrame, min_bytes: int = 0, date: str = "2020-01-01T00:00:00Z", id_col: str = "page_id",
    url_col: str = "url", payload_col: str = "html",
) -> Archive:
    bound_batches(pages.sparkSession)
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("record_id"), F.col(url_col).alias("url"), payload.alias("payload")
    )

    def compress(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        for batch in batches:
            pack = zstandard.ZstdCompressor(level=1).compress
            batch["sha256"] = [hashlib.sha256(p).digest() for p in batch["payload"]]
            batch["length"] = batch["payload"].map(len)
            batch["check"] = [hashlib.sha1(p).digest() for p in batch["payload"]]
            # Within a batch equal payloads travel once; ids are gathered from the digests alone.
            batch = batch.drop_duplicates("sha256")
            yield batch.assign(packed=batch["payload"].map(pack))[["sha256", "check", "length", "packed"]]

    packed = rows.select("payload").mapInPandas(compress, "sha256 binary, check binary, length long, packed binary")
    payloads = stored(packed.groupBy("sha256").agg(
        F.min("check").alias("check"), F.max("check").alias("other"), F.min("length").alias("length"),
        F.first("packed").alias("packed"),
    ).withColumn(
        "check", F.when(F.col("check") == F.col("other"), F.col("check")).otherwise(
            F.raise_error(F.lit("two payloads share a SHA-256"))
        ),
    ).drop("other"), "warc-payloads")

    ids = rows.select(
        "record_id", "url", F.unhex(F.sha2("payload", 256)).alias("sha256"), F.unhex(F.sha1("payload")).alias("sha1"),
        F.octet_length("payload").cast("long").alias("length"),
    )
    firsts = stored(ids.groupBy("sha256").agg(F.min("record_id").alias("first_id")), "warc-firsts")

    def with_headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, no_id, url, sha256, sha1, length, refers_to, no_ref in batch.itertuples(index=False):
                digest = base64.b32encode(sha1).decode()
                ref = None if no_ref else refers_to
                out.append((None if no_id else i, ref, sha256, header(None if no_id else i, url, length, digest, ref, date)))
            frame = pd.DataFrame(out, columns=["record_id", "refers_to", "sha256", "header"])
            yield frame.astype({"record_id": "Int64", "refers_to": "Int64"})

    refers = F.when(
        (F.col("length") >= min_bytes) & ~F.col("record_id").eqNullSafe(F.col("first_id")), F.col("first_id")
    )
    zero = F.lit(0).cast("long")
    headers = (
        ids.join(firsts, "sha256")
        .withColumn("ref", refers)
        .select(
            F.coalesce("record_id", zero).alias("record_id"), F.col("record_id").isNull().alias("no_id"), "url", "sha256", "sha1",
            "length", F.coalesce("ref", zero).alias("ref"), F.col("ref").isNull().alias("no_ref"),
        )
        .mapInPandas(with_headers, "record_id long, refers_to long, sha256 binary, header binary")
    )
    return Archive(payloads, stored(headers, "warc-headers"))


def read(archive: Archive) -> DataFrame:
    """Every record as it was: its whole bytes (a revisit has no payload in its block), and what its header says."""

    def rebuild(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        for batch in batches:
            unpack, rows, held = zstandard.ZstdDecompressor().decompress, [], 0
            for i, no_id, ref, no_ref, sha256, head, packed in batch.itertuples(index=False):
                payload, said = unpack(packed), fields(head)
                digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
                if hashlib.sha256(payload).digest() != sha256 or digest != said["WARC-Payload-Digest"]:
                    raise ValueError(f"the payload of {said['WARC-Record-ID']} does not match its digest")
                kind, key = said["WARC-Type"], None if no_ref else ref
                if kind == "revisit" and said["WARC-Refers-To"] != record_urn(key):
                    raise ValueError(f"{said['WARC-Record-ID']} refers to another record than the archive says")
                record = head + (b"" if kind == "revisit" else payload) + b"\r\n\r\n"
                rows.append((None if no_id else i, kind, key, len(payload), digest.removeprefix("sha1:"), record))
                held += len(record)
                if held > BATCH_BYTES:
                    yield frame(rows)
                    rows, held = [], 0
            yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        names = ["record_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "record"]
        return pd.DataFrame(rows, columns=names).astype({"record_id": "Int64", "refers_to": "Int64"})

    zero = F.lit(0).cast("long")
    joined = archive.headers.join(archive.payloads.select("sha256", "packed"), "sha256").select(
        F.coalesce("record_id", zero).alias("record_id"), F.col("record_id").isNull().alias("no_id"),
        F.coalesce("refers_to", zero).alias("refers_to"), F.col("refers_to").isNull().alias("no_ref"),
        "sha256", "header", "packed",
    )
    return joined.mapInPandas(rebuild, RECORD_SCHEMA)
