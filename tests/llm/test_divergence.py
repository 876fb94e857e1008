import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import divergence

DDL = "doc_id long, lang string, source string, text string, term string, n int"
LOWER = {i: chr(i).lower() for i in range(ord("A"), ord("Z") + 1)}


def table(spark, rows):
    """Rows of (lang, source, text) with ids that repeat and two columns that clash with the operator's own."""
    return spark.createDataFrame([(i % 3 or None, *r, "x", 1) for i, r in enumerate(rows)], DDL).repartition(5)


def terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def kept_of(rows, min_docs=3):
    docs = defaultdict(Counter)
    for lang, _, text in rows:
        docs[lang or ""].update(set(terms(text)))
    return {lang: {t for t, n in c.items() if n >= min_docs} for lang, c in docs.items()}


def ranked(found, limit=None):
    found = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:limit]
    return [(item, value, i + 1) for i, (item, value) in enumerate(found)]


def expected(rows):
    kept = kept_of(rows)
    counts = defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        own = Counter(t for t in terms(text) if t in kept[lang])
        counts[lang, source] += own
        counts[lang, None] += own

    def p(lang, source, t):
        c = counts[lang, source]
        return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept[lang]))

    def f(p, q):
        return (p - q) ** 2 // q

    out = []
    for lang, source in [k for k in counts if k[1] is not None]:
        others = [s for x, s in counts if x == lang and s not in (None, source)]
        pair = [(o, sum(f(p(lang, source, t), p(lang, o, t)) for t in kept[lang])) for o in others]
        own = [t for t in kept[lang] if counts[lang, source][t] and p(lang, source, t) > p(lang, None, t)]
        term = [(t, f(p(lang, source, t), p(lang, None, t))) for t in own]
        out += [(lang, source, "pair", *r) for r in ranked(pair)]
        out += [(lang, source, "term", *r) for r in ranked(term, 200)]
    return sorted(out)


def corpus(seed, n=250):
    rng = random.Random(seed)
    stems = ["a", "ab", "abc", "abcd", "abcde", "Straße", "日本語", "été", "x" * 31, "x" * 32, "x" * 33, "longest" * 9]
    words = stems + [s + e for s in stems for e in ("s", "ed", "é")] + [f"rare{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "1", "[", "_", "@", "\x7f"]) for _ in range(rng.randrange(40)))
        rows.append((rng.choice(["en", "en", "en", "de", None]), rng.choice(["hot", "hot", "hot", "a", "b", "", None]), text))
    return rows + [("fr", "lone", "Allein ALLEIN allein"), ("it", "empty", None), ("it", "other", "1 2 3"), ("en", "c", "q" * 400_000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_counting_by_hand(spark, seed):
    rows = corpus(seed)
    assert sorted(map(tuple, divergence.audit(table(spark, rows)).collect())) == expected(rows)


def test_more_typical_terms_than_are_reported(spark):
    rng = random.Random(3)
    words = [f"{chr(97 + i)}{chr(97 + j)}" for i in range(26) for j in range(26)]
    rows = [("en", s, " ".join(rng.sample(words[k : k + 400], 300))) for s, k in (("a", 0), ("b", 200)) for _ in range(30)]
    found = sorted(map(tuple, divergence.audit(table(spark, rows)).collect()))
    assert found == expected(rows) and max(r[5] for r in found) == 200


def test_empty_table(spark):
    assert divergence.audit(table(spark, [])).collect() == []


@pytest.mark.parametrize("most", [0, 10**6])
def test_refinement_keeps_what_full_counts_keep(spark, monkeypatch, most):
    """Prefix lists are broadcast, or shuffled if they are larger than allowed."""
    monkeypatch.setattr(divergence, "BROADCAST_ROWS", most)
    rows = corpus(5)
    counted = table(spark, rows).select("lang", "source", "text").mapInArrow(divergence._count_terms, divergence.OCCURRENCES)
    kept = divergence.kept_terms(counted)
    found = {(r.lang, bytes(r.term)) for r in kept.collect()}
    assert kept.filter("first").count() == len(found)
    assert found == {(lang, t.encode() + b"\0") for lang, ts in kept_of(rows).items() for t in ts}


def test_a_prefix_counts_documents_once(monkeypatch):
    """Several terms of one document share a prefix: the first alone counts for it."""
    monkeypatch.setattr(divergence, "FIRST_LEVEL", 4)
    batch = pa.record_batch([["en"] * 2, ["s"] * 2, ["abcde abcdf abcd abcdefgh", "Abcdf abcdf"]], ["lang", "source", "text"])
    rows = next(divergence._count_terms(iter([batch]))).to_pylist()
    found = {r["term"].rstrip(b"\0").decode(): (*r["counts"][0].values(), r["firsts"]) for r in rows}
    assert found == {
        "abcd": ("s", 1, 1, [1, 1]), "abcde": ("s", 1, 1, [0, 1]), "abcdefgh": ("s", 1, 1, [0, 1, 1]), "abcdf": ("s", 3, 2, [1, 2]),
    }


def test_probabilities_beyond_a_long_are_exact(spark):
    from pyspark.sql import functions as F

    rows = [(0, 1, 1), (5, 10**4, 7), (9 * 10**9 - 1, 10**10, 3), (9 * 10**9, 10**10, 3), (10**15, 3 * 10**15, 10**6), (1, 0, 0)]
    found = spark.createDataFrame(rows, "n long, total long, terms long").select("*", divergence._p(*map(F.col, ("n", "total", "terms"))).alias("p"))
    for r in found.collect():
        assert r.p == (1 + 10**9 * (r.n + 1) // (r.total + r.terms) if r.total + r.terms else None)


def test_blocks_add_up(monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 7)
    rng = np.random.default_rng(1)
    rows = [("en", [{"source": f"s{k}", "p": int(rng.integers(1, 10**9)), "zero": 5 + k} for k in range(5)]) for _ in range(4)]
    batch = pa.record_batch([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], ["lang", "sources"])
    found = Counter()
    blocks = list(divergence._compare(iter([batch])))
    for block in blocks:
        for r in block.to_pylist():
            found[r["source"], r["other"]] += r["value"]
    f = lambda p, q: (p - q) ** 2 // q
    want = Counter()
    for _, held in rows:
        for a in held:
            for b in held:
                p, q, p0, q0 = a["p"], b["p"], a["zero"], b["zero"]
                want[a["source"], b["source"]] += f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)
    assert found == want and len(blocks) > 4
