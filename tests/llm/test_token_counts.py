import random

import pytest

from tidemark.llm import token_counts as tc

PIECES = {
    "▁": -3.0, "a": -2.0, "b": -2.0, "c": -4.0, "ab": -2.5, "▁a": -2.2, "▁ab": -4.0, "bc": -3.0, "abc": -4.4, "cab": -5.0, "é": -6.0
}


def brute(word):
    """The best segmentation, by trying all."""
    unknown = min(PIECES.values()) - tc.UNKNOWN

    def best(rest):
        if not rest:
            return (0.0, 0)
        options = []
        for k in range(1, len(rest) + 1):
            if rest[:k] in PIECES:
                score, n = best(rest[k:])
                options.append((score + PIECES[rest[:k]], n - 1))
        if rest[0] not in PIECES:
            n = len(rest[0].encode())
            score, m = best(rest[1:])
            options.append((score + n * unknown, m - n))
        return max(options)

    return -best(tc.MARK + word)[1]


@pytest.mark.parametrize("seed", range(3))
def test_counts_match_all_segmentations(seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abcé日") for _ in range(rng.randint(1, 9))) for _ in range(300)}
    found = tc.UnigramCounter(PIECES).count_new([w.encode() for w in words])
    assert {w.decode(): n for w, n in found.items()} == {w: brute(w) for w in words}


def test_each_prefix_is_computed_once(monkeypatch):
    counter, computed = tc.UnigramCounter(PIECES), []
    extend = tc.UnigramCounter.extend
    monkeypatch.setattr(tc.UnigramCounter, "extend", lambda s, w, f, k: (computed.extend(w[: i + 1] for i in range(k, len(w))), extend(s, w, f, k)))
    words = ["abc", "abcab", "abb", "b", "abca"]
    counter.count_new([w.encode() for w in words])
    assert len(computed) == len(set(computed)) == len({(tc.MARK + w)[: i + 1] for w in words for i in range(len(w) + 1)})


def test_rows_of_all_kinds(documents):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = [None, "", " \n", "hello world", "hello\tworld hello", "日本語 ☃", "x" * 100_000, "nbsp inside"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "hello"), (3, "hello world"), (3, "hello world")]
    got = tc.token_counts(documents(rows), path).collect()
    counter = tc.UnigramCounter(tc.load_pieces(path))
    plain = lambda t: [w for w in (t or "").encode().split()]
    want = [(i, len(plain(t)), sum(counter.count_new([w])[w] for w in plain(t))) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert tc.token_counts(documents([]), path).collect() == []


def test_a_full_table_changes_nothing(monkeypatch):
    texts = ["ab abc a", "abc cab b", None, "abcab " * 30]
    plain = tc.UnigramCounter(PIECES).count(texts)
    monkeypatch.setattr(tc, "TABLE_WORDS", 1)
    monkeypatch.setattr(tc, "GROUP_CHARS", 3)
    assert tc.UnigramCounter(PIECES).count(texts) == plain
