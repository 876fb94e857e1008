"""Token ids as length-delimited binary records, with a separate offset index.

A file is a run of frames::

    uint64 length | uint32 masked crc of the length | body | uint32 masked crc of the body

and a body is ``int64 doc_id | uint8 flags | token ids``, little-endian.  Flag 1: the id is null.  Flag 2: ids take four
bytes instead of two.  The check sum is CRC-32, masked by a rotation by 15 bits and the constant 0xA282EAD8, so that
check sums of data that hold check sums stay sound.

``write`` range-partitions by document id, sorts each partition, and lets its task stream frames into files of bounded
size; Spark stores one index row per record (file, offset, frame length, token count).  ``read`` streams whole files,
``read_at`` seeks to the records of any subset of the index, in any order, as a shuffled training run does.

Words are looked up in a bounded cache before the tokenizer is asked: every rule of this vocabulary splits at white
space, so a text's ids are the ids of its words one after the other.

Defined cases: null and empty texts give the end id alone; a null document id sorts first and stays null; repeated rows
are records of their own; an empty table gives an empty index.  Other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import files
from tidemark.llm.common import bound_batches, release_memory, stored
from tidemark.session import scratch_path

MASK = 0xA282EAD8  # fixed value: the customary masking constant of length-delimited record files
INDEX_SCHEMA = "shard int, part int, file string, offset long, length long, doc_id long, n_tokens long"
INDEX_NAMES = ["shard", "part", "file", "offset", "length", "doc_id", "n_tokens"]
INDEX_TYPES = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
RECORD_SCHEMA = "shard int, part int, doc_id long, before long, n_tokens long, ids binary"
FILE_BYTES = 256 << 20
CACHE_WORDS = 600_000
# A full stop or comma at a word's end, behind a letter of ASCII or Latin-1.
FINAL_MARK = re.compile(rb"([.,])(?:(?<=[a-z].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))(?![^ \t\n\r\x0b\x0c])")
# An ASCII capital before a character from U+0300 on.  All combining marks are among these, and a capital and its small
# letter need not compose with a mark alike.
BEFORE_MARK = re.compile(rb"[A-Z][\xcc-\xf4]")
GROUP_BYTES = 2 << 20


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


class WordEncoder:
    """Ids of whole texts by a bounded cache of words, which takes words until it is full; frequent ones come early.

    Where the tokenizer lowers all letters and takes a full stop or comma behind a letter for a token of its own, which is
    tested when the encoder is made, texts are lowered and such marks cut off first, so that fewer words are told apart.
    A text where a combining mark may follow an ASCII capital stays as it is: the tokenizer composes before it lowers.
    """

    def __init__(self, tokenizer_path: str, end_id: int):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.wide = max(self.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id) > 0xFFFF
        self.dtype = np.dtype("<u4" if self.wide else "<u2")
        self.end = np.array([end_id], self.dtype).tobytes()
        self.words: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.last_of_word = np.zeros(max(vocabulary.values(), default=0) + 2, bool)
        self.last_of_word[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        # Special tokens are told apart by case.
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        one = self._one
        self.alike = all(one("Ab" + m) == one("ab") + one(m) for m in ".,") and one("aB") == one("ab")

    def _one(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _encode_new(self, new: list[bytes]) -> dict[bytes, bytes]:
        """Words of letters go in long lines, cut again behind the pieces that end a word; others one by one."""
        found: dict[bytes, bytes] = {}
        decoded = [(w, w.decode()) for w in new]
        plain = [w for w, t in decoded if t.isalpha()]
        lines = [plain[i : i + 200] for i in range(0, len(plain), 200)]
        encoded = self.tokenizer.encode_batch_fast([b" ".join(x).decode() for x in lines], add_special_tokens=False)
        single = [w for w, t in decoded if not t.isalpha()]
        for line, e in zip(lines, encoded):
            ids = np.array(e.ids, self.dtype)
            ends = np.flatnonzero(self.last_of_word[np.minimum(ids, len(self.last_of_word) - 1)]) + 1
            if len(ends) != len(line) or ends[-1] != len(ids):
                single += line
                continue
            raw, at = ids.tobytes(), (np.append(0, ends) * self.dtype.itemsize).tolist()
            found.update(zip(line, [raw[a:b] for a, b in zip(at, at[1:])]))
        for i in range(0, len(single), 5000):
            some = single[i : i + 5000]
            encoded = self.tokenizer.encode_batch([w.decode() for w in some], add_special_tokens=False)
            found.update((w, np.array(e.ids, self.dtype).tobytes()) for w, e in zip(some, encoded))
        return found

    def _split(self, text: bytes) -> list[bytes]:
        if not self.alike or (not text.isascii() and BEFORE_MARK.search(text)):
            return text.split()
        lowered = text.lower()  # ASCII letters only
        if any(token in lowered for token in self.special):
            return text.split()
        return FINAL_MARK.sub(rb" \1", lowered).split()

    def encode(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """The ids of each UTF-8 text, the end id last; texts are taken in groups of bounded size."""
        group, held = [], 0
        for text in texts:
            group.append(self._split(text))
            held += len(text)
            if held > GROUP_BYTES:
                yield from self._encode_group(group)
                group, held = [], 0
        yield from self._encode_group(group)

    def _encode_group(self, group: list[list[bytes]]) -> Iterator[bytes]:
        words = self.words
        found = self._encode_new(list(set().union(*group).difference(words)))
        words.update(found)
        ids_of = words.__getitem__
        for tokens in group:
            yield b"".join(map(ids_of, tokens)) + self.end
        if len(words) > CACHE_WORDS:  # the cache was full before this group
            for w in found:
                del words[w]
        else:
            for w in found:
                if len(w) > 64:
                    del words[w]


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def _encoder(path: str, end_id: int) -> WordEncoder:
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = WordEncoder(path, end_id)
    return _ENCODERS[path, end_id]


def _frame(doc_id: int | None, ids: bytes, wide: bool) -> bytes:
    body = struct.pack("<qB", doc_id or 0, (doc_id is None) | wide << 1) + ids
    head = struct.pack("<Q", len(body))
    return b"".join((head, struct.pack("<I", masked_crc(head)), body, struct.pack("<I", masked_crc(body))))


def _parse(head: bytes, rest: bytes) -> tuple[int | None, np.ndarray]:
    body, crc = rest[:-4], struct.unpack("<I", rest[-4:])[0]
    if crc != masked_crc(body):
        raise ValueError("a record's body does not match its check sum")
    doc_id, flags = struct.unpack_from("<qB", body)
    ids = np.frombuffer(body, "<u4" if flags & 2 else "<u2", offset=9)
    return None if flags & 1 else doc_id, ids


def _length(head: bytes) -> int:
    length, crc = struct.unpack("<QI", head)
    if crc != masked_crc(head[:8]):
        raise ValueError("a record's length does not match its check sum")
    return length


def write(
    docs: DataFrame, root: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    file_bytes: int = FILE_BYTES, shards: int | None = None,
) -> DataFrame:
    """Write all rows of ``docs`` in ascending id order and return the stored index."""
    bound_batches(docs.sparkSession)
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def write_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, attempt, encoder = TaskContext.get().partitionId(), uuid.uuid4().hex, _encoder(tokenizer_path, end_id)
        part, at, out, name = 0, 0, None, ""
        release_memory()
        for batch in batches:
            rows = []
            for key, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(_values(batch.column("data")))):
                if out is not None and at >= file_bytes:
                    out.close()
                    out, part, at = None, part + 1, 0
                if out is None:
                    name = f"{root}/records-{shard:06d}-{part:05d}-{attempt}.bin"
                    out = files.open_output(name)
                frame = _frame(key, ids, encoder.wide)
                out.write(frame)
                rows.append((shard, part, name, at, len(frame), key, len(ids) // encoder.dtype.itemsize))
                at += len(frame)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), INDEX_TYPES)], INDEX_NAMES)
        if out is not None:
            out.close()

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data")
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text)
        .repartitionByRange(shards, "doc_id")
        .sortWithinPartitions("doc_id")
    )
    return stored(ordered.mapInArrow(write_partition, INDEX_SCHEMA), "records-index")


def _values(column: pa.Array) -> Iterator[bytes]:
    for i in range(0, len(column), 100):
        yield from column.slice(i, 100).to_pylist()


def read(index: DataFrame, digest: bool = False) -> DataFrame:
    """All records of the files that ``index`` names; ``before`` counts the ids in front of a record in all of these files.

    With ``digest`` there is the CRC-32 of the ids as 32-bit numbers in place of the ids.
    """

    def read_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, part, name, before in batch.itertuples(index=False):
                rows, held = [], 0
                with files.open_input(name) as source:
                    while head := source.read(12):
                        doc_id, ids = _parse(head, source.read(_length(head) + 4))
                        wide = ids.astype("<u4").tobytes()
                        rows.append((shard, part, doc_id, before, len(ids), zlib.crc32(wide) if digest else wide))
                        before += len(ids)
                        held += 32 if digest else len(wide)
                        if held > 16 << 20:
                            yield _records(rows, last)
                            rows, held = [], 0
                if rows:
                    yield _records(rows, last)

    # One row for each file on either side.
    named = index.select("shard", "part", "file").distinct().join(starts(index), ["shard", "part"])
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = "ids_crc32" if digest else "ids"
    schema = RECORD_SCHEMA.replace("ids binary", "ids_crc32 long") if digest else RECORD_SCHEMA
    return named.repartition(tasks, "file").mapInPandas(read_files, schema)


def read_at(index: DataFrame) -> DataFrame:
    """The records of the given index rows, each by its offset, in the order in which a task meets them."""

    def seek(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, rows in batch.groupby("file", sort=False):
                with files.open_input(name, seekable=True) as source:
                    for row in rows.itertuples(index=False):
                        source.seek(row.offset)
                        head = source.read(12)
                        doc_id, ids = _parse(head, source.read(_length(head) + 4))
                        yield _records([(row.shard, row.part, doc_id, None, len(ids), ids.astype("<u4").tobytes())])

    return index.mapInPandas(seek, RECORD_SCHEMA)


def _records(rows: list[tuple], last: str = "ids") -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["shard", "part", "doc_id", "before", "n_tokens", last])
    return frame.astype({"doc_id": "Int64", "before": "Int64"})


def starts(index: DataFrame) -> DataFrame:
    """Per file, how many ids all files before it hold: one row per file, so the window sorts few rows."""
    totals = index.groupBy("shard", "part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))


def digests(index: DataFrame) -> DataFrame:
    """Read everything back: per record its id, its start in the whole sequence, its ids' number and CRC-32."""
    return read(index, digest=True).select("doc_id", F.col("before").alias("start"), "n_tokens", "ids_crc32")


def folder(spark: SparkSession) -> str:
    return scratch_path(spark, "records")
