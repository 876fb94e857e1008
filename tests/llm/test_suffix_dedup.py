import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import suffix_dedup


def brute(texts, length=400):
    """Per text: covered bytes, by counting all windows."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if counts[d[i : i + length]] > 1:
                gone[i : i + length] = True
        gone = gone[:-1]
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    prose = lambda k: " ".join(word() for _ in range(k))
    shared = [prose(110) for _ in range(3)] + [prose(72) for _ in range(3)]
    texts = [None, "", "a" * 399, "a" * 900, "ab" * 600, "x" * 400, "b" + "a" * 700 + "c"]
    while len(texts) < n:
        parts = [prose(rng.randint(0, 150))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(shared)
            cut = rng.randint(0, 150)
            parts += [p[cut:] if rng.random() < 0.5 else p[: len(p) - cut], prose(rng.randint(0, 60))]
        texts.append(" ".join(parts))
        if rng.random() < 0.2:
            texts.append(texts[-1])
        if rng.random() < 0.2:
            t = texts[-1]
            k = rng.randrange(len(t) + 1)
            texts.append(t[:k] + "#" + t[k + 1 :])
    return texts


@pytest.mark.parametrize("seed, hot", [(1, 4096), (2, 4096), (3, 3)])
def test_against_counting_all_windows(spark, documents, monkeypatch, seed, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    texts = corpus(seed)
    ids = [i * 3 for i in range(len(texts))]
    got = {r.doc_id: r for r in suffix_dedup.dedup(documents(list(zip(ids, texts)))).collect()}
    want = dict(zip(ids, brute(texts)))
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items()} == want
    assert sum(n for _, n, _, _ in want.values()) > 5000


def test_repeated_and_null_ids_are_rows_of_their_own(documents):
    text = " ".join(map(str, range(200)))
    rows = [(1, text), (1, text), (None, text), (None, "other"), (2, None)]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed) for r in suffix_dedup.dedup(documents(rows)).collect())
    n = len(text)
    assert got == [(False, 1, n, n), (False, 1, n, n), (False, 2, 0, 0), (True, 0, 5, 0), (True, 0, n, n)]


def test_no_rows(documents):
    assert suffix_dedup.dedup(documents([])).collect() == []


def test_multikey_quicksort_sorts():
    rng = random.Random(5)
    rows = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(0, 40))) for _ in range(500)]
    order = suffix_dedup.multikey_quicksort(rows)
    padded = [r + b"\x00" * (48 - len(r)) for r in rows]
    assert [padded[i] for i in order] == sorted(padded)
