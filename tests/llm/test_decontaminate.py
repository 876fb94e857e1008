import random

import pytest

from tidemark.llm import decontaminate as d


def edits(item, text):
    """Fewest edits between the item and any stretch of the text (Sellers)."""
    lower = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    item, text = lower(item), lower(text)
    cost = list(range(len(item) + 1))
    best = cost[-1]
    for c in text:
        diagonal, cost[0] = cost[0], 0
        for i, x in enumerate(item, 1):
            diagonal, cost[i] = cost[i], min(diagonal + (x != c), cost[i] + 1, cost[i - 1] + 1)
        best = min(best, cost[-1])
    return best


def budget(item):
    return min(int(len(item) * d.RATE), (len(item) - d.Q) // d.Q)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdéß日") for _ in range(rng.randint(1, 5)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rng.randint(8, 40))) for i in range(12)]
    items += [(None, prose(20)), (50, items[0][1]), (51, "short"), (52, None), (53, "")]

    def edited(text, n):
        chars = list(text)
        for _ in range(n):
            k = rng.randrange(len(chars))
            chars[k : k + 1] = rng.choice([[], [rng.choice("xyz")], [chars[k], "q"]])
        return "".join(chars)

    docs = [(0, None), (1, ""), (2, items[3][1]), (3, items[4][1].upper())]
    for i in range(4, 90):
        item = rng.choice(items[:13])[1]
        n = rng.randint(0, budget(item) + 3)
        docs.append((i, prose(rng.randint(0, 40)) + " " + edited(item, n) + " " + prose(rng.randint(0, 40))))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_finds_what_full_alignment_finds(spark, documents, seed):
    docs, items = corpus(seed)
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    rows = d.contaminated(documents(docs), benchmark).collect()
    want = {}
    for i, text in docs:
        for j, item in items:
            if text and item and len(item) >= d.MIN_CHARS and (n := edits(item, text)) <= budget(item):
                want[i, j] = n
    got = {}
    for r in rows:
        got[r.doc_id, r.item_id] = min(r.edits, got.get((r.doc_id, r.item_id), 99))
    assert got == want and len(want) > 50
    texts, by_item = dict(docs), dict(items)
    for r in rows:
        assert edits(by_item[r.item_id], texts[r.doc_id][r.begin : r.end]) <= r.edits
    clean = d.clean(documents(docs), benchmark)
    assert {r.doc_id for r in clean.collect()} == set(texts) - {i for i, _ in want}
    assert clean.columns == documents(docs).columns


def test_a_misaligned_find_ends():
    item = "āĀ" * 20
    index = d.build([(1, item)])
    assert d.occurrences("Āā" * 30, index)[0][3] == 0
    assert d.occurrences("ab" * 500, index) == []


def test_blocks_and_empty_tables(spark, documents, monkeypatch):
    docs, items = corpus(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(repr, d.contaminated(documents(docs), benchmark).collect()))
    monkeypatch.setattr(d, "BLOCK_CHARS", 300)
    assert sorted(map(repr, d.contaminated(documents(docs), benchmark).collect())) == one
    assert d.contaminated(documents([]), benchmark).collect() == []
    assert d.clean(documents(docs), benchmark.limit(0)).count() == len(docs)


def whole(item, text):
    """Begins of the item in the text as whole words, A-Z and a-z alike."""
    lower = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    item, text = lower(item), lower(text)
    inner = lambda c: c.isalnum() and ord(c) < 0x2E80
    begins = []
    for b in range(len(text) - len(item) + 1):
        e = b + len(item)
        joined = (b > 0 and inner(text[b - 1]) and inner(text[b])) or (e < len(text) and inner(text[e - 1]) and inner(text[e]))
        if text[b:e] == item and not joined:
            begins.append(b)
    return begins


@pytest.mark.parametrize("seed", [1, 2])
def test_short_items_are_found_as_whole_words(spark, documents, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abAé日本7") for _ in range(rng.randint(1, 4)))
    prose = lambda n: rng.choice([" ", "-", ", "]).join(word() for _ in range(n))
    items = [(i, prose(rng.randint(1, 6))) for i in range(300)]
    items = [(i, t) for i, t in items if len(t) < d.MIN_CHARS] + [(900, items[0][1]), (901, "ab"), (902, "a"), (903, None), (904, "")]
    docs = [(0, None), (1, ""), (2, "aba"), (3, "ab")]
    docs += [(n, prose(rng.randint(0, 60)) + " " + rng.choice(items[:-4])[1] + rng.choice(["", ".", "a"])) for n in range(4, 80)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {}
    for r in d.contaminated(documents(docs), benchmark).collect():
        assert r.edits == 0
        got.setdefault((r.doc_id, r.item_id), []).append((r.begin, r.end))
    want = {}
    for n, text in docs:
        for i, item in items:
            if text and item and len(item) >= d.MIN_EXACT:
                for b in whole(item, text):
                    chosen = want.setdefault((n, i), [])
                    if not chosen or chosen[-1][1] <= b:  # overlapping places: the leftmost
                        chosen.append((b, b + len(item)))
    want = {k: v for k, v in want.items() if v}
    assert got == want and {len(i) for _, i in items if i and len(i) in range(3, 24)} >= {3, 7, 8, 15}
    assert {r.doc_id for r in d.clean(documents(docs), benchmark).collect()} == {n for n, _ in docs} - {n for n, _ in want}
