"""Events meet the version valid on their day, by equi-joins on bins."""

import random
from datetime import date, datetime, timedelta

import pytest

from tests.plans import plan
from tidemark.operators.intervals import valid_versions

EVENTS = "n int, id int, at timestamp_ntz"
VERSIONS = "id int, EffectiveStartDate date, EffectiveEndDate date, name string"
DAY = date(2024, 1, 1)


def corpus(seed):
    rng = random.Random(seed)
    versions = []
    for i in range(8):
        start = DAY + timedelta(days=rng.randrange(30))
        for k in range(rng.randrange(6)):
            days = rng.choice([0, 1, 5, 40])
            end = rng.choice([start + timedelta(days=days)] * 3 + [None, date(9999, 12, 31)])
            versions.append((i, start, end, f"{i}-{k}"))
            start += timedelta(days=days + rng.choice([1, 1, 9]))
    versions += [(None, DAY, None, "nobody"), (2, DAY + timedelta(days=5), DAY, "inverted")]
    ids = [0] * 6 + [None, *range(10)]
    events = [(n, rng.choice(ids), rng.choice([None] + [datetime(2023, 12, 20) + timedelta(hours=rng.randrange(24 * 90)) for _ in range(9)])) for n in range(400)]
    return events, versions


def fitting(event, versions):
    _, entity, at = event
    if entity is None or at is None:
        return []
    return sorted((s, e or date(9999, 12, 31), name) for i, s, e, name in versions if i == entity and s <= at.date() <= (e or date(9999, 12, 31)))


@pytest.mark.parametrize("bin_days", [1, 7, 1000])
@pytest.mark.parametrize("max_rows", [10, 10**6])
def test_equal_to_comparing_all(spark, bin_days, max_rows):
    events, versions = corpus(bin_days)
    sides = spark.createDataFrame(events, EVENTS), spark.createDataFrame(versions, VERSIONS)
    options = {"bin_days": bin_days, "max_rows": max_rows}
    one = valid_versions(*sides, "id", "at", **options).collect()
    best = {e[0]: f[-1][2] if (f := fitting(e, versions)) else None for e in events}
    assert len(one) == len(events) and {r.n: r.name for r in one} == best
    every = valid_versions(*sides, "id", "at", latest_start=False, **options).collect()
    want = [(e[0], name) for e in events for *_, name in fitting(e, versions) or [(None,)]]
    assert sorted((r.n, r.name or "") for r in every) == sorted((n, name or "") for n, name in want)


def test_no_events_and_no_versions(spark):
    events, versions = corpus(1)
    none, no_versions = spark.createDataFrame([], EVENTS), spark.createDataFrame([], VERSIONS)
    assert valid_versions(none, spark.createDataFrame(versions, VERSIONS), "id", "at").collect() == []
    found = valid_versions(spark.createDataFrame(events, EVENTS), no_versions, "id", "at").collect()
    assert len(found) == len(events) and {r.name for r in found} == {None}
    with pytest.raises(ValueError, match="both sides"):
        valid_versions(none, no_versions.withColumnRenamed("name", "n"), "id", "at")


def test_the_plan_has_no_range_product(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events, versions = corpus(2)
        text = plan(valid_versions(spark.createDataFrame(events, EVENTS), spark.createDataFrame(versions, VERSIONS), "id", "at"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "NestedLoop" not in text and "Cartesian" not in text
