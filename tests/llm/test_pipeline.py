"""Each stage against a brute-force version on its own input, and the whole run against the chain of stages."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tests.llm import test_decontaminate, test_jaccard_join, test_quality_rules
from tidemark.llm import mixing
from tidemark.llm.common import stored

tokenizers = pytest.importorskip("tokenizers")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    word = lambda: rng.choice("the of and to in a is".split()) if rng.random() < 0.4 else "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(25)) for i in range(6)]
    texts = [None, "", "too short", "### $$$ " * 40]
    while len(texts) < 160:
        texts.append(prose(rng.randint(15, 120)))
        if rng.random() < 0.3:
            tokens = texts[-1].split()
            tokens[rng.randrange(len(tokens))] = "edit"
            texts.append(" ".join(tokens))
        if rng.random() < 0.15:
            texts.append(prose(30) + " " + rng.choice(items)[1] + " " + prose(30))
    rows = [(i, t, "en", f"src{i % 4}" if i % 9 else None, len(t or "")) for i, t in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def chain(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], folder), name.replace(" ", "-")))
    return kept


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns_stay(chain):
    assert all(df.columns == chain[0].columns for df in chain[:-1])


def test_rules(chain):
    have, given = {i for i, _ in rows_of(chain[1])}, dict(rows_of(chain[0]))
    failed = {i for i, t in given.items() if test_quality_rules.expected(t)[-1]}
    assert have == set(given) - failed


def test_one_of_each_group(chain):
    groups = {c for _, _, _, c in test_jaccard_join.brute(rows_of(chain[1]))}
    assert {i for i, _ in rows_of(chain[2])} == groups and len(groups) < chain[1].count()


def test_contaminated_documents_go(spark, chain, folder):
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    given = rows_of(chain[2])
    found = {i for i, t in given if any(test_decontaminate.edits(x, t) <= test_decontaminate.budget(x) for x in items)}
    assert {i for i, _ in rows_of(chain[3])} == {i for i, _ in given} - found and found


def test_the_mix(chain):
    given = {r.doc_id: (r.source, len(r.text.split())) for r in chain[3].collect()}
    copies = Counter(i for i, _ in rows_of(chain[4]))
    sizes, taken = Counter(), Counter()
    for i, (source, n) in given.items():
        sizes[source] += n
        taken[source] += n * copies[i]
    longest = max(n for _, n in given.values())
    for source, target in mixing.targets(sizes).items():
        assert abs(taken[source] - target) <= longest
    assert set(copies) <= set(given) and max(copies.values()) <= mixing.EPOCHS


def test_records_and_the_whole_run(spark, chain, folder):
    import public_tokenizers

    plain = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    at, want = 0, []
    for i, text in sorted(rows_of(chain[4])):
        ids = plain.encode(text, add_special_tokens=False).ids + [2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    have = sorted(tuple(r) for r in chain[5].select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert have == want
    names = chain[5].columns
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).select(*names).collect())) == sorted(map(tuple, chain[5].collect()))
    assert corpus_pipeline.ORACLE_SQL is None
