"""The fact build on interaction tables, and attributes that arrive late."""

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.plans.fact import FactSpec, affected_keys, build_fact, refresh_fact, windowed_fact, without_key
from tidemark.plans.presets import (
    CUSTOM_COLUMNS,
    INTERACTION_COLUMNS,
    INTERACTION_FACT,
    INTERACTION_FACT_KEY,
    INTERACTION_RENAMES,
    RECORD_COLUMNS,
)
from tidemark.operators.upsert import upsert


def interactions(spark, *keys):
    """Interaction rows; every other column repeats its own name so that renames can be checked."""
    names = [INTERACTION_RENAMES.get(c, c) for c in INTERACTION_COLUMNS if c not in ("InteractionIDKey", "SiteID", "SeqNo")]
    df = spark.createDataFrame(list(keys), "InteractionIDKey string, SiteID int, SeqNo int")
    return df.withColumns({c: F.lit(c) for c in [*names, *RECORD_COLUMNS.values(), "NotInTheFact"]})


def attributes(spark, *keys):
    df = spark.createDataFrame(list(keys), "InteractionIDKey string, SiteID int, SeqNo int")
    return df.withColumns({c: F.lit(c) for c in CUSTOM_COLUMNS})


def test_interaction_fact_layout(spark):
    fact = build_fact(
        interactions(spark, ("c1", 1, 0), ("c2", 1, 0), (None, 1, 0)), attributes(spark, ("c1", 1, 0), ("c9", 1, 0)), INTERACTION_FACT
    )
    assert len(fact.columns) == 46 and fact.columns == list(INTERACTION_FACT.order)
    rows = {r.InteractionIDKey: r.asDict() for r in fact.collect()}
    assert set(rows) == {"c1", "c2", None}
    hit, miss, lost = rows["c1"], rows["c2"], rows[None]
    assert (hit["Fact_InteractionID"], hit["callId"], hit["CustomString4"]) == ("c110", "c1", "CustomString4")
    assert (miss["callId"], miss["CustomNum1"]) == (None, None)
    assert lost["Fact_InteractionID"] is None and lost["callId"] is None
    assert hit["InteractionHashKey"] == hashlib.sha256(b"c1|1|0").hexdigest()
    assert lost["InteractionHashKey"] == hashlib.sha256(b"1|0").hexdigest()
    assert (hit["DNIS"], hit["QueueWait"], hit["nQueueWait"]) == ("DNIS_LocalID", "tQueueWait", "nQueueWait")
    assert hit["RecordCreatedDateTimeCST"] == "__record_created_datetime_cst"


def test_interaction_fact_merge(spark):
    """Merging on id and keys replaces rows; a row without a full key is inserted once more."""
    def fact(*keys):
        return build_fact(interactions(spark, *keys), attributes(spark, ("c1", 1, 0)), INTERACTION_FACT)

    merged = upsert(fact(("c1", 1, 0), (None, 1, 0)), fact(("c1", 1, 0), ("c2", 1, 0), (None, 1, 0)), INTERACTION_FACT_KEY)
    found = sorted((r.InteractionIDKey or "-") for r in merged.collect())
    assert found == ["-", "-", "c1", "c2"]


SPEC = FactSpec(keys=("k",), base={"k": "k", "v": "v"}, attributes={"note": "note"}, nullable_keys=True)
OLD, NEW, SINCE = datetime(2024, 1, 1), datetime(2024, 1, 9), datetime(2024, 1, 5)


@pytest.fixture
def tables(spark):
    base = spark.createDataFrame(
        [(1, "old", OLD), (2, "old", OLD), (3, "new", NEW), (4, "again", NEW), (None, "lost", NEW)],
        "k int, v string, at timestamp",
    )
    notes = spark.createDataFrame([(2, "late", NEW), (4, "early", OLD), (1, "n", OLD)], "k int, note string, at timestamp")
    return base, notes


def found(df):
    return sorted(((r.k, r.note) for r in df.collect()), key=repr)


def test_refresh_reaches_both_sides(tables):
    base, notes = tables
    keys = affected_keys(base, notes, ["k"], "at", SINCE, "at", SINCE)
    new_without_key = without_key(base.where(F.col("v") == "lost"), ["k"])
    fresh = refresh_fact(base, notes, keys, SPEC, new_without_key)
    assert found(fresh) == sorted([(2, "late"), (3, None), (4, "early"), (None, None)], key=repr)


def test_separate_watermarks_lose_attributes(tables):
    """What filtering each side on its own does: the early note is blanked and the late one never attached."""
    base, notes = tables
    assert found(windowed_fact(base, notes, SPEC, "at", SINCE, "at", SINCE)) == sorted(
        [(3, None), (4, None), (None, None)], key=repr
    )


def test_attributes_that_repeat_a_key(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    notes = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, note string")
    many = FactSpec(keys=("k",), base={"k": "k", "v": "v"}, attributes={"note": "note"}, attributes_unique=False)
    assert found(build_fact(base, notes, many)) == [(1, "x"), (1, "y"), (2, None)]
