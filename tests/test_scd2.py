"""Versioning scenarios, batch behaviour, and the segmented form against the plain one."""

from dataclasses import replace
from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.plans import count, plan
from tidemark.operators import scd2
from tidemark.operators.ordered import Timeline, split_hot
from tidemark.operators.scd2 import VersionSpec
from tidemark.plans.presets import (
    EMPLOYEE_DIM,
    EMPLOYEE_TRACKED,
    employee_schema,
    employee_seed,
    employee_versions,
)

SPEC = VersionSpec(
    entity="id",
    order="at",
    tracked=("id", "job", "team", "HireDate", "LastDayWorked", "TerminationDate", "TerminationReason", "Status"),
    filled=("team",),
    max_rows_per_entity=None,
)
DDL = """id int, at timestamp, job string, team string, HireDate date, LastDayWorked date, TerminationDate date,
 TerminationReason string, Status string"""
OPEN = date(9999, 12, 31)
HIRED = date(2020, 1, 1)


def on(day, job="A", team="t", ended=False, reason=None, status="Active", entity=1):
    gone = date(2024, 1, 31) if ended else None
    return (entity, datetime(2024, 1, day, 8), job, team, HIRED, gone, gone, reason, status)


def history(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def spans(df):
    """(job, first day, last day) in order; an open end is None."""
    found = df.select("id", "job", "EffectiveStartDate", "EffectiveEndDate").orderBy("id", "EffectiveStartDate").collect()
    return [(r.job, r[2].day, None if r[3] == OPEN else r[3].day) for r in found]


def build(spark, *rows):
    return scd2.versions(history(spark, *rows), SPEC)


def test_no_change_is_one_open_version(spark):
    assert spans(build(spark, on(1), on(2), on(3))) == [("A", 1, None)]


def test_a_change_closes_the_version_the_day_before(spark):
    assert spans(build(spark, on(1), on(4, "B"))) == [("A", 1, 3), ("B", 4, None)]


def test_return_to_earlier_values_is_a_version(spark):
    assert spans(build(spark, on(1), on(2, "B"), on(3))) == [("A", 1, 1), ("B", 2, 2), ("A", 3, None)]


def test_first_seen_terminated_never_enters(spark):
    assert spans(build(spark, on(1, ended=True), on(2, ended=True))) == []


def test_rows_after_the_first_ended_one_are_dropped(spark):
    got = build(spark, on(1), on(2, "B", ended=True), on(3, "C", ended=True), on(4, "D", ended=True))
    assert spans(got) == [("A", 1, 1), ("B", 2, None)]


def test_rehire_leaves_the_ended_version_open(spark):
    got = build(spark, on(1), on(2, "B", ended=True), on(5, "C"))
    assert spans(got) == [("A", 1, 1), ("B", 2, None), ("C", 5, None)]


def test_gaps_are_filled_from_the_past_only(spark):
    got = build(spark, on(1, team=None), on(2, "B", team="x"), on(3, "C", team=None))
    assert [r.team for r in got.orderBy("at").collect()] == [None, "x", "x"]


def test_status_and_reason(spark):
    got = build(
        spark,
        on(1, reason="early"),
        on(2, "B", ended=True, reason="<None>"),
        on(1, entity=2, reason=None),
        on(2, "B", ended=True, reason="left", entity=2),
        on(1, entity=3),
        on(2, "B", ended=True, reason=None, entity=3),
    )
    found = [(r.id, r.TerminationReason, r.Status) for r in got.orderBy("id", "at").collect()]
    assert found == [
        (1, "null", "Active"),
        (1, "null", "Terminated"),
        (2, "null", "Active"),
        (2, "left", "Terminated"),
        (3, "null", "Active"),
        (3, None, "Terminated"),
    ]


def test_rows_of_one_instant_fold_to_one(spark):
    copies = [on(1)] * 50 + [on(2, "B"), on(2, "C")]
    got = scd2.versions(history(spark, *copies), replace(SPEC, unique_order=False))
    assert spans(got) == [("A", 1, 1), ("C", 2, None)]


def test_surrogate_key(spark):
    assert [r.Dim_ID for r in build(spark, on(7, entity=42)).collect()] == [1_000_042_2024_01_07]


def test_last_of_an_always_set_flag_is_the_rows_own_flag(spark):
    """Why an open end needs no window: the running last of a never-null condition is the current row's condition."""
    flags = [False, True, False, True, False]
    df = spark.createDataFrame(list(enumerate(flags)), "n int, flag boolean")
    from pyspark.sql import Window

    out = df.select("n", F.last("flag", True).over(Window.orderBy("n")).alias("f")).orderBy("n")
    assert [r.f for r in out.collect()] == flags


def test_chain_has_one_shuffle_and_one_sort(spark):
    text = plan(build(spark, on(1), on(2)))
    assert (count(text, "Exchange"), count(text, "Sort"), count(text, "Window")) == (1, 1, 3)
    assert "rangepartitioning" not in text


def test_latest_per_day_folds_before_the_shuffle(spark):
    h = history(spark, on(1), (1, datetime(2024, 1, 1, 9), *on(1, "B")[2:]))
    daily = scd2.latest_per_day(h, "id", "at")
    assert count(plan(daily), "WindowGroupLimit") == 2
    assert [r.job for r in daily.collect()] == ["B"]
    assert daily.columns == h.columns


# --- batches ---------------------------------------------------------------------------------------------------------


def comparable(df):
    return sorted(map(repr, df.select("id", "at", "job", "EffectiveEndDate", "RowHashKey").collect()))


def test_second_batch_closes_the_open_version(spark):
    first, second = [on(1), on(1, entity=2)], [on(5, "B")]
    target = build(spark, *first)
    merged = scd2.merge_versions(target, history(spark, *first, *second), history(spark, *second), SPEC)
    assert comparable(merged) == comparable(build(spark, *first, *second))


def test_rows_without_an_entity_are_merged_like_any_other(spark):
    first, second = [on(1, entity=None)], [on(5, "B", entity=None)]
    merged = scd2.merge_versions(build(spark, *first), history(spark, *first, *second), history(spark, *second), SPEC)
    assert spans(merged) == [("A", 1, 4), ("B", 5, None)]


def test_late_row_is_placed_into_its_history(spark):
    first, late = [on(1), on(9, "C")], [on(5, "B")]
    merged = scd2.merge_versions(build(spark, *first), history(spark, *first, *late), history(spark, *late), SPEC)
    assert spans(merged) == [("A", 1, 4), ("B", 5, 8), ("C", 9, None)]


def test_merging_a_batch_twice_changes_nothing(spark):
    first, second = [on(1)], [on(5, "B")]
    everything, batch = history(spark, *first, *second), history(spark, *second)
    once = scd2.merge_versions(build(spark, *first), everything, batch, SPEC)
    assert comparable(scd2.merge_versions(once, everything, batch, SPEC)) == comparable(once)


def test_insert_only_never_closes_and_loses_returns(spark):
    """The behaviour of insert-only loads, kept for comparison."""
    target = build(spark, on(1))
    second = scd2.insert_versions(target, build(spark, on(5, "B")), SPEC)
    assert spans(second) == [("A", 1, None), ("B", 5, None)]
    third = scd2.insert_versions(second, build(spark, on(8)), SPEC)
    assert spans(third) == spans(second)


job_runs = st.lists(
    st.tuples(st.sampled_from("AB"), st.sampled_from([None, "x", "y"]), st.booleans()), min_size=1, max_size=12
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(runs=st.lists(job_runs, min_size=1, max_size=3), cut=st.integers(1, 12))
def test_versions_of_an_entity_do_not_overlap_and_batches_equal_one_build(spark, runs, cut):
    rows = [
        on(day + 1, job, team, ended=ended and day > 0, entity=entity)
        for entity, run in enumerate(runs)
        for day, (job, team, ended) in enumerate(run)
    ]
    full = build(spark, *rows)
    by_entity = {}
    for r in full.orderBy("id", "EffectiveStartDate").collect():
        by_entity.setdefault(r.id, []).append(r)
    for versions in by_entity.values():
        for earlier, later in zip(versions, versions[1:]):
            assert earlier.EffectiveStartDate < later.EffectiveStartDate
            if earlier.TerminationDate is None:
                assert (later.EffectiveStartDate - earlier.EffectiveEndDate).days == 1
    early = [r for r in rows if r[1].day <= cut]
    late = [r for r in rows if r[1].day > cut]
    merged = scd2.merge_versions(build(spark, *early), history(spark, *rows), history(spark, *late), SPEC)
    assert comparable(merged) == comparable(full)


# --- segments --------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark, sf_dir):
    """One entity owns half of the rows, and rows without an entity form another large group."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    user = F.when(F.col("event_id") % 2 == 0, 1).when(F.col("event_id") % 7 == 0, None).otherwise(F.col("user_id"))
    ended = F.col("event_type") == "error"
    day = F.to_date("ts")
    return events.select(
        user.cast("int").alias("id"),
        F.col("ts").alias("at"),
        F.col("event_type").alias("job"),
        F.nullif("event_type", F.lit("view")).alias("team"),
        F.lit("2020-01-01").cast("date").alias("HireDate"),
        F.when(ended, day).alias("LastDayWorked"),
        F.when(ended & (F.col("event_id") % 5 > 0), day).alias("TerminationDate"),
        F.lit("r").alias("TerminationReason"),
        F.lit("s").alias("Status"),
    ).checkpoint()


@pytest.mark.parametrize("max_rows", [20, 150])
def test_segments_give_the_same_versions(spark, skewed, max_rows):
    plain = scd2.versions(skewed, SPEC)
    cut = scd2.versions(skewed, replace(SPEC, max_rows_per_entity=max_rows))
    assert cut.columns == plain.columns
    ordered = lambda df: sorted(map(repr, df.collect()))
    assert ordered(cut) == ordered(plain)


def test_segments_bound_what_one_task_sees(spark, skewed):
    parts = split_hot(skewed, Timeline("id", "at"), 50)
    assert len(parts) == 2
    cold, (hot, timeline) = parts[0][0], parts[1]
    assert cold.groupBy("id").count().agg(F.max("count")).head()[0] <= 50
    sizes = hot.groupBy("id", timeline.segment).count().agg(F.max("count"), F.sum("count")).head()
    assert sizes[0] <= 150
    assert sizes[1] + cold.count() == skewed.count()


def test_a_small_bound_asks_for_no_more_tasks(spark, skewed):
    """Segments are as small as the bound; the tasks that cut them follow the rows."""
    hot, timeline = split_hot(skewed, Timeline("id", "at"), 3)[-1]
    sizes = hot.groupBy("id", timeline.segment).count().agg(F.max("count"), F.count("*")).head()
    assert sizes[0] <= 3
    assert sizes[1] > 10 * spark.sparkContext.defaultParallelism
    assert hot.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    cut = scd2.versions(skewed, replace(SPEC, max_rows_per_entity=3))
    ordered = lambda df: sorted(map(repr, df.collect()))
    assert ordered(cut) == ordered(scd2.versions(skewed, SPEC))


def test_values_of_rows_without_a_time_cross_segment_borders(spark):
    """Rows without a time come first; the value they bring is carried like any other."""
    day = lambda d: None if d is None else datetime(2024, 1, d)
    made = [(1, day(d), "j", team, day(1), None, None, "r", f"s{d}") for d, team in [(None, "x"), *[(d, None) for d in range(2, 8)]]]
    names = "id long, at timestamp, job string, team string, HireDate timestamp, LastDayWorked timestamp, TerminationDate timestamp, TerminationReason string, Status string"
    history = spark.createDataFrame(made, names)
    cut = scd2.versions(history, replace(SPEC, max_rows_per_entity=1)).where("at IS NOT NULL")
    assert {r.team for r in cut.collect()} == {"x"}


def test_histories_within_the_bound_are_left_alone(spark, skewed):
    assert len(split_hot(skewed, Timeline("id", "at"), 10_000_000)) == 1


# --- employee preset -------------------------------------------------------------------------------------------------


def employees(spark, *rows):
    """Rows give (EmployeeID, LoadDate, overrides)."""
    types = {f: "string" for f in EMPLOYEE_TRACKED} | {
        "EmployeeID": "int", "SupervisorID": "int", "HireDate": "timestamp", "LastDayWorked": "timestamp",
        "TerminationDate": "timestamp",
    }
    names = [*EMPLOYEE_TRACKED, "LoadDate"]
    ddl = ", ".join(f"{n} {types.get(n, 'timestamp')}" for n in names)
    base = {"HireDate": datetime(2020, 1, 1), "FullPartTIme": "Full", "Status": "Active", "UserName": "u"}
    made = [base | {"EmployeeID": i, "LoadDate": datetime(2024, 1, d)} | extra for i, d, extra in rows]
    return spark.createDataFrame([tuple(m.get(n) for n in names) for m in made], ddl)


def test_employee_layout(spark):
    built = employee_versions(employees(spark, (5, 1, {}), (5, 3, {"UserName": None, "JobTitle": "Lead"})))
    assert built.dtypes == [(f.name, f.dataType.simpleString()) for f in employee_schema().fields]
    rows = built.orderBy("EffectiveStartDate").collect()
    assert [r.Dim_EmployeeID for r in rows] == [1_000_005_2024_01_01, 1_000_005_2024_01_03]
    assert [r.UserName for r in rows] == ["u", "u"]
    assert [r.EffectiveEndDate for r in rows] == [date(2024, 1, 2), OPEN]
    assert rows[0].EmploymentType == "Full"


def test_load_into_a_seeded_dimension(spark):
    seed = employee_seed(spark)
    first = employee_versions(employees(spark, (5, 1, {})))
    added = scd2.rows_to_append(seed, first, EMPLOYEE_DIM)
    assert added.count() == 1
    target = seed.unionByName(added)
    again = employee_versions(employees(spark, (5, 1, {}), (5, 2, {"JobTitle": "Lead"})))
    assert [r.JobTitle for r in scd2.rows_to_append(target, again, EMPLOYEE_DIM).collect()] == ["Lead"]
