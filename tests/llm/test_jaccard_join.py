import random

import numpy as np
import pytest

from tidemark.llm import jaccard_join
from tidemark.llm.components import components
from tidemark.llm.shingles import shingle_set


def words_of(text):
    raw = text or ""
    raw = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
    for c in "\t\n\x0b\x0c\r":
        raw = raw.replace(c, " ")
    return [w for w in raw.split(" ") if w]


def brute(rows):
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d is None, d or 0, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def corpus(seed, n=150):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghÉß") for _ in range(rng.randint(2, 7)))
    passage = " ".join(word() for _ in range(40))
    texts = [None, "", " \t\n", "one two", "One two", "ONE two", "a b c d", "a b c d"]
    while len(texts) < n:
        base = [word() for _ in range(rng.choice([6, 20, 60, 150]))]
        if rng.random() < 0.4:
            base = passage.split() + base
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 35))):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy) if rng.random() < 0.8 else "\n".join(copy).upper().replace("SS", "ß"))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(documents, seed):
    rows = [(7 * i, t) for i, t in enumerate(corpus(seed))]
    got = jaccard_join.join(documents(rows)).collect()
    have = sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got), key=repr)
    assert have == brute(rows)
    assert len({r.component_id for r in got}) < len(rows) - 30


def test_messy_ids_and_one_kept(documents):
    text = " ".join(map(str, range(30)))
    rows = [(None, text), (4, text), (4, text + " x"), (9, "something else that is long enough"), (None, ""), (None, None)]
    got = jaccard_join.join(documents(rows)).collect()
    have = sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in got), key=repr)
    assert have == brute(rows)
    kept = jaccard_join.keep_one(documents(rows))
    assert kept.columns == documents(rows).columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 4), (False, 9), (True, 0), (True, 0)]


def test_no_rows(documents):
    assert jaccard_join.join(documents([])).collect() == []


def test_regions_find_all_close_pairs(monkeypatch):
    monkeypatch.setattr(jaccard_join, "LEAF", 6)
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 1 << 63, rng.integers(10, 900)).astype(np.uint64)
        for _ in range(rng.integers(1, 5)):
            copy = base.copy()
            change = rng.integers(0, len(base), len(base) // 25)
            copy[change] = rng.integers(0, 1 << 63, len(change))
            sets.append(np.unique(copy))
    n = np.array([len(s) for s in sets])
    counts = [jaccard_join.class_counts(s).tobytes() for s in sets]
    one = np.array([len(sets)])
    zero = np.zeros(len(sets), np.int64)
    rows = jaccard_join.Rows(n, np.arange(len(sets)), zero, np.zeros((len(sets), 8), np.int64), zero == 0)
    i, j, _ = jaccard_join.cell_candidates(np.array([0]), one, rows, counts)
    found = set(zip(i.tolist(), j.tolist())) | set(zip(j.tolist(), i.tolist()))
    whole = set(found)
    monkeypatch.setattr(jaccard_join, "LEAF", 10_000)
    i, j, _ = jaccard_join.cell_candidates(np.array([0]), one, rows, counts)
    assert whole == set(zip(i.tolist(), j.tolist())) | set(zip(j.tolist(), i.tolist()))
    linked = {
        (a, b)
        for a in range(len(sets))
        for b in range(len(sets))
        if a != b and 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))
    }
    assert len(linked) > 50 and linked <= found


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40, 80)] + [(5, 9), (9, 7), (100, 3), (3, 101), (8, 8)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 40 for i in range(40, 81)}, 5: 5, 9: 5, 7: 5, 100: 3, 3: 3, 101: 3}


def test_shingles_ignore_ascii_case_and_white_space_only():
    assert (shingle_set(b"A b\tC d e") == shingle_set(b"a  B c\nD E ")).all()
    assert len(shingle_set("Éa b c d e".encode())) == 1
    assert (shingle_set("É b c d e".encode()) != shingle_set("é b c d e".encode())).all()
    assert len(shingle_set(b"")) == 0
