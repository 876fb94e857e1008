import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle

DDL = "doc_id long, text string, lang string, source string, n_chars long, pos int, `group` string"


def table(spark, rows):
    """Rows of (doc_id, source, text) with two columns that clash with the operator's own."""
    full = [(i, t, "en" if i else None, s, None if t is None else len(t), 3, "x") for i, s, t in rows]
    return spark.createDataFrame(full, DDL).repartition(4)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    i, s, t = row
    return h(*map(field, (i, s, "en" if i else None, None if t is None else len(t), text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + 16]) for k in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, at):
    for level in levels[:-1]:
        start = at // 16 * 16
        yield "".join(level[start:at]), "".join(level[at + 1 : start + 16])
        at //= 16


def expected(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row, row[2]), row))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for at, (_, _, digest, row) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            way = [*siblings(trees[s], at), *siblings(top, k)]
            chosen = row[0] is not None and row[2] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            lowered = "".join(c.lower() if c.isascii() else c for c in row[2]) if chosen else row[2]
            node = leaf(row, lowered)
            for left, right in way:
                node = h(left, node, right)
            root = top[-1][0]
            out.append((row[0], s, digest, trees[s][-1][0], root, h(*[x for w in way for x in w]), node, node == root))
    return sorted(out, key=repr)


def audited(spark, rows):
    found = merkle.audit(merkle.build(table(spark, rows), merkle.tampered_leaf()))
    return sorted(map(tuple, found.collect()), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    ids = [rng.randrange(-(2**62), -1) for _ in range(n // 2)] + rng.sample(range(10**6), n - n // 2)
    return [(i, rng.choice([None, "", "a", "Ä", "hot", "hot", "hot"]), rng.choice(["Abc", "é", "x" * 500])) for i in ids]


@pytest.mark.parametrize("n", [1, 17, 300])
def test_equal_to_trees_built_by_hand(spark, n):
    rows = corpus(n, n)
    assert audited(spark, rows) == expected(rows)


def test_a_source_with_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DEPTH", 1)
    monkeypatch.setattr(merkle, "CHUNK", 16)
    rows = [(7 * i, "one", f"Text {i}") for i in range(4200)] + [(i, f"s{i}", "A") for i in range(40)]
    assert len(merkle.build(table(spark, rows)).rounds) == 4
    assert audited(spark, rows) == expected(rows)


def test_null_and_repeated_ids_and_rows(spark):
    rows = [(None, "a", "x"), (None, "a", None), (3, "a", "B"), (3, "a", "A"), (3, "a", "A"), (3, None, "A"), (5, None, None)]
    rows += [(4, "hot", "Same")] * 40 + [(2, "hot", ""), (2, "hot", None), (1, "hot", "Z" * 300_000)]
    assert audited(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert audited(spark, []) == []


def test_ranks_count_the_smaller_keys(spark):
    rng = random.Random(1)
    keys = {0, -1, 63, 64, 65535, 65536, 2**63 - 1, -(2**63), 2**48, 2**32 - 1} | {rng.randrange(-(2**63), 2**63) for _ in range(500)}
    rows = [(g, k) for g in ("a", None) for k in keys if g or k % 3]
    got = merkle.ranked(spark.createDataFrame(rows, "group string, key long")).collect()
    for g in ("a", None):
        want = {k: p for p, k in enumerate(sorted(k for x, k in rows if x == g))}
        assert {r.key: r.pos for r in got if r.group == g} == want


def test_a_tampered_text_is_found(spark):
    rows = [(i, "s", f"Text {i}") for i in range(50)]
    found = merkle.audit(merkle.build(table(spark, rows), merkle.tampered_leaf())).filter(~F.col("verified")).collect()
    assert {r.doc_id for r in found} == {i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 0}
