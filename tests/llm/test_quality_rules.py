import random

from pyspark.sql import functions as F

from tidemark.llm import quality_rules as q


def expected(text):
    raw = text or ""
    for c in "\t\n\x0b\x0c\r":
        raw = raw.replace(c, " ")
    words = [w for w in raw.split(" ") if w]
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [line for line in (text or "").split("\n") if line.strip(" \t\x0b\x0c\r")]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed)


def corpus():
    rng = random.Random(4)
    texts = [None, "", " \n\t ", "a", "a\n\na\n a\n", "# $ % & | < > * é x", " ", "x " * 50, "é日本 " * 30, "w" * 200_000]
    vocabulary = [f"{c}{i}" for c in "the" for i in range(6)] + ["of", "is", "Éa."]
    for _ in range(150):
        n = rng.choice([5, 19, 20, 21, 60, 300])
        text = [rng.choice(vocabulary) for _ in range(n)]
        if rng.random() < 0.5:
            k = rng.randrange(n)
            text += text[k : k + rng.randint(6, 12)]
        texts.append("".join(w + rng.choice([" ", " ", "\n", "  ", "\t"]) for w in text))
    return texts


def test_measures_match_counting_by_hand(documents):
    texts = corpus()
    m = F.col("`quality!`")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = q.measure(documents(list(enumerate(texts)))).select("doc_id", *[m[n] for n in names]).collect()
    assert {r[0]: tuple(r)[1:] for r in rows} == {i: expected(t) for i, t in enumerate(texts)}


def test_rules_apply_and_columns_stay(documents):
    prose = " ".join(["the house of the old man is not in this town and it was there for years, he said with a smile"] * 1) + " indeed"
    rows = [(1, prose), (None, prose), (1, prose), (2, prose + "".join(f" ###{i}" for i in range(20))), (3, "zzz " * 30), (4, None), (5, ("qwert " * 25).strip())]
    table = documents(rows)
    kept = q.keep(table)
    assert kept.columns == table.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 1), (True, 0)]
    assert q.keep(documents([])).collect() == []
    loose = q.keep(table, rules=())
    assert {r.doc_id for r in loose.collect()} >= {1, 2, None}


def test_the_plan_is_one_projection(documents):
    plan = q.measure(documents([(1, "a b")]))._jdf.queryExecution().executedPlan().toString()
    measured = q.measure(documents([(1, "a b")])).select("`quality!`")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Aggregate" not in measured and "Join" not in measured
