import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import toxicity

LABELS = "doc_id long, toxic int, score int"


def corpus(n=600):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice(["an", "the", "or", "is", "tion"]) for _ in range(rng.randint(1, 3)))
    docs, labels = [], []
    for i in range(n):
        text = [word() for _ in range(rng.randint(10, 80))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            for w in rng.sample(["scum", "Vermin", "pathetic"], 2):
                text.insert(rng.randrange(len(text)), w)
        docs.append((i, " ".join(text)))
        if rng.random() < 0.9:
            labels.append((i, toxic, 0))
    return docs, labels


def test_held_out_accuracy(spark, documents):
    docs, labels = corpus()
    table, known = documents(docs + [(None, "x"), (9999, None), (9999, "")]), spark.createDataFrame(labels, LABELS)
    got = toxicity.score(table, toxicity.train(table, known)).collect()
    assert len(got) == len(docs) + 3 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by_id = {r.doc_id: r for r in got}
    for i, _ in docs:
        assert by_id[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    test = [(by_id[i].predicted, y) for i, y, _ in labels if by_id[i].held_out]
    assert len(test) > 60 and np.mean([p == y for p, y in test]) > 0.95


def test_held_out_labels_are_never_learned_from(spark, documents):
    docs, labels = corpus(200)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y, 0) for i, y, _ in labels]
    table = documents(docs)
    plain, other = (
        {r.doc_id: r.score for r in toxicity.score(table, toxicity.train(table, spark.createDataFrame(x, LABELS))).collect()}
        for x in (labels, flipped)
    )
    assert plain == other


def test_labels_without_two_classes(spark, documents):
    docs, labels = corpus(50)
    table = documents(docs)
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in toxicity.score(table, toxicity.train(table, none)).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 0) for i, _ in docs] + [(None, 0, 0), (1, None, 0)], LABELS)
    assert all(r.predicted == 1 for r in toxicity.score(table, toxicity.train(table, ones)).collect())
    assert toxicity.score(documents([]), toxicity.train(documents([]), none)).collect() == []


def test_a_sample_is_bounded(spark, documents):
    docs, labels = corpus(600)
    table, known = documents(docs), spark.createDataFrame(labels, LABELS)
    sample = toxicity._sample(table, known, "doc_id", "text", "toxic", 100)
    assert 60 < sample.count() < 140
