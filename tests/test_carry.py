"""Dimensions from carried state equal full builds, whatever the order in which rows come."""

import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import scd2
from tidemark.operators.carry import advance_versions, carried_state
from tidemark.operators.scd2 import VersionSpec

DDL = "id int, at timestamp, HireDate date, TerminationDate date, LastDayWorked date, TerminationReason string, Status string, team string"
SPEC = VersionSpec(entity="id", order="at", tracked=("Status", "team", "TerminationDate", "LastDayWorked"), filled=("team",))
START = datetime(2024, 1, 1)


def corpus(seed, n=400):
    rng = random.Random(seed)
    rows = {}
    for _ in range(n):
        at = START + timedelta(hours=rng.randrange(24 * 12))
        ended = rng.random() < 0.3
        day = at.date() if ended else None
        key = (rng.choice([None, *range(12)]), at)
        rows[key] = (*key, START.date(), day, day if rng.random() < 0.8 else None, rng.choice(["<None>", "x", None]), rng.choice("AB"), rng.choice([None, "t", "u"]))
    return list(rows.values())


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


def content(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def advanced(spark, spec, batches):
    seen = list(batches[0])
    target, state = scd2.versions(frame(spark, seen), spec).checkpoint(), carried_state(frame(spark, seen), spec).checkpoint()
    for batch in batches[1:]:
        seen += batch
        done = advance_versions(target, state, frame(spark, seen), frame(spark, batch), spec)
        target, state = done.versions.checkpoint(), done.state.checkpoint()
    return target, state, frame(spark, seen)


@pytest.mark.parametrize("most", [None, 5])
@pytest.mark.parametrize("late", [0.0, 0.1])
def test_equal_to_a_full_build(spark, most, late):
    """In order or with rows that come late; entities may be cut into segments."""
    spec = replace(SPEC, max_rows_per_entity=most)
    rng = random.Random(7)
    rows = sorted(corpus(3), key=lambda r: r[1])
    batches = [[], [], []]
    for i, row in enumerate(rows):
        batches[2 if rng.random() < late else min(2, 3 * i // len(rows))].append(row)
    target, state, history = advanced(spark, spec, batches)
    assert content(target) == content(scd2.versions(history, spec))
    assert content(state) == content(carried_state(history, spec))


def test_history_is_not_read_while_rows_come_in_order(spark):
    first = [(1, START, None, None, None, None, "A", "t")]
    target, state = scd2.versions(frame(spark, first), SPEC), carried_state(frame(spark, first), SPEC)
    unreadable = frame(spark, first).withColumn("team", F.raise_error(F.lit("the history was read")).cast("string"))
    more = frame(spark, [(1, START + timedelta(days=2), None, None, None, None, "A", None), (1, START + timedelta(days=3), None, None, None, None, "B", None)])
    done = advance_versions(target, state, unreadable, more, SPEC)
    assert [(r.team, str(r.EffectiveEndDate)) for r in done.versions.orderBy("EffectiveStartDate").collect()] == [
        ("t", "2024-01-02"), ("t", "2024-01-03"), ("t", "9999-12-31"),
    ]
    late = frame(spark, [(1, START - timedelta(days=1), None, None, None, None, "A", "s")])
    with pytest.raises(Exception, match="the history was read"):
        advance_versions(target, state, unreadable, late, SPEC).versions.collect()


def test_a_version_of_the_same_day_is_replaced(spark):
    at = [START, START + timedelta(hours=5)]
    rows = [[(1, t, None, None, None, None, s, team)] for t, s, team in zip(at, "AB", ("t", None))]
    target, state, history = advanced(spark, SPEC, rows)
    assert content(target) == content(scd2.versions(history, SPEC)) and target.count() == 1


def test_rows_seen_before_and_empty_batches_change_nothing(spark):
    rows = corpus(5, 60)
    target, state, history = advanced(spark, SPEC, [rows, rows[:10], []])
    assert content(target) == content(scd2.versions(frame(spark, rows), SPEC))
