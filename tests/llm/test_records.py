import functools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import records
from tidemark.session import scratch_path

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
END = 2
TEXTS = [
    None, "", " \t ", "Hello, World. it's 12345 THE END.", "İstanbul É é ÉCOLE straße, áb", "x" * 5000, "<|endoftext|>a b<|startoftext|>. <|ENDOFTEXT|> <|endoftext|>. Ää. ÄÄ, é, ñ.",
    "a.. b,. .,. , ... A. B, é. É,", "tab\tnew\nline nbsp em\x1cfs\x85nel", "日本語 テキスト。 中文.", "don't We'LL 'tis rock'n'roll.",
] + [f"Word{i} plain words. again, Again" for i in range(400)]


@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("word_bpe_49k.json")


@functools.cache
def tokenizer(path):
    return tokenizers.Tokenizer.from_file(path)


def ids_of(path, text):
    return tokenizer(path).encode(text or "", add_special_tokens=False).ids + [END]


def test_words_add_up_to_texts(path):
    encoder = records.WordEncoder(path, END)
    plain = tokenizers.Tokenizer.from_file(path)
    assert encoder.alike
    for _ in range(2):
        for text, ids in zip(TEXTS, encoder.encode([(t or "").encode() for t in TEXTS])):
            assert np.frombuffer(ids, "<u2").tolist() == plain.encode(text or "", add_special_tokens=False).ids + [END], text


def test_capitals_before_combining_marks(path):
    marks = [chr(c) for c in range(0x300, 0x370)] + ["\u05b0\u030c", "\u0317\u0307", "\u1dce\u0331", "\u0323\u0308"]
    pairs = [c + m for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for m in marks]
    texts = ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a", "The H\u0331 and Y\u030ab, End.", *pairs]
    encoder = records.WordEncoder(path, END)
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u2").tolist() == ids_of(path, text), ascii(text)


def test_round_trip_and_digests(spark, documents, path):
    rows = [(5 * i - 20, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (0, "Hello, World."), (0, "Hello, World.")]
    index = records.write(documents(rows), scratch_path(spark, "records"), path, END, file_bytes=2000)
    assert index.select("file").distinct().count() > 3
    read = {(r.doc_id, bytes(r.ids)) for r in records.read(index).collect()}
    as_ids = lambda t: np.array(ids_of(path, t), "<u4").tobytes()
    assert read == {(i, as_ids(t)) for i, t in rows}
    some = index.filter("pmod(doc_id, 3) = 1").orderBy(F.rand(3))
    want = {(i, as_ids(t)) for i, t in rows if i is not None and i % 3 == 1}
    assert {(r.doc_id, bytes(r.ids)) for r in records.read_at(some).collect()} == want

    got = sorted(records.digests(index).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    crc = {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got}
    assert crc == {(i, len(ids_of(path, t)), zlib.crc32(as_ids(t))) for i, t in rows}


def test_no_rows(spark, documents, path):
    index = records.write(documents([]), scratch_path(spark, "records"), path, END)
    assert records.digests(index).collect() == []


def test_damage_is_noticed(spark, documents, path):
    index = records.write(documents([(1, "some text")]), scratch_path(spark, "records"), path, END)
    row = index.first()
    name = row.file.removeprefix("file://")
    data = bytearray(open(name, "rb").read())
    data[-6] ^= 1
    open(name, "wb").write(data)
    with pytest.raises(Exception, match="check sum"):
        records.read(index).collect()
