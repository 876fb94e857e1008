"""MERGE as joins: model-based properties, null keys, duplicates, skew."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.plans import count, plan
from tidemark.operators.conform import conform_union, widest_first
from tidemark.operators.joins import anti_join, left_join, left_join_many, semi_join
from tidemark.operators.upsert import dedupe_latest, duplicate_keys, insert_only, upsert

DDL = "k int, v int"


def frame(spark, rows, ddl=DDL):
    return spark.createDataFrame(rows, ddl)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


unique_rows = st.dictionaries(st.integers(0, 12), st.integers(0, 5), max_size=10)
modest = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@modest
@given(target=unique_rows, source=unique_rows)
def test_upsert_is_a_dictionary_update(spark, target, source):
    t, s = frame(spark, list(target.items())), frame(spark, list(source.items()))
    once = upsert(t, s, ["k"])
    assert rows(once) == sorted((target | source).items(), key=repr)
    assert rows(upsert(once, s, ["k"])) == rows(once)


@modest
@given(target=unique_rows, source=unique_rows)
def test_insert_only_keeps_target_rows(spark, target, source):
    t, s = frame(spark, list(target.items())), frame(spark, list(source.items()))
    assert rows(insert_only(t, s, ["k"])) == sorted((source | target).items(), key=repr)
    assert rows(insert_only(t, s, ["k"], small=True)) == sorted((source | target).items(), key=repr)


@pytest.mark.parametrize("nullable", [True, False])
def test_upsert_without_nulls_does_not_depend_on_the_null_handling(spark, nullable):
    t, s = frame(spark, [(1, 1), (2, 2)]), frame(spark, [(2, 9), (3, 9)])
    assert rows(upsert(t, s, ["k"], nullable_keys=nullable)) == [(1, 1), (2, 9), (3, 9)]


def test_null_keys_never_match(spark):
    ddl = "a int, b int, v string"
    t = frame(spark, [(1, None, "t"), (None, None, "t"), (1, 2, "t")], ddl)
    s = frame(spark, [(1, None, "s"), (1, 2, "s")], ddl)
    assert rows(upsert(t, s, ["a", "b"])) == sorted(
        [(1, None, "t"), (None, None, "t"), (1, None, "s"), (1, 2, "s")], key=repr
    )
    assert rows(semi_join(t, s, ["a", "b"])) == [(1, 2, "t")]
    assert len(rows(anti_join(t, s, ["a", "b"]))) == 2


def test_new_and_missing_columns(spark):
    t, s = frame(spark, [(1, 1), (2, 2)]), frame(spark, [(2, "x")], "k int, w string")
    assert rows(upsert(t, s, ["k"])) == [(1, 1, None), (2, None, "x")]


def test_duplicate_source_keys(spark):
    t, s = frame(spark, [(1, 0)]), frame(spark, [(1, 5), (1, 7), (2, 1)])
    with pytest.raises(ValueError, match="share the key"):
        upsert(t, s, ["k"])
    assert rows(upsert(t, s, ["k"], on_duplicate="latest", order=["v"])) == [(1, 7), (2, 1)]
    assert rows(upsert(t, s, ["k"], on_duplicate="keep")) == [(1, 5), (1, 7), (2, 1)]
    assert rows(duplicate_keys(s, ["k"])) == [(1, 2)]


def test_null_keys_are_not_duplicates(spark):
    s = frame(spark, [(None, 1), (None, 2), (3, 1), (3, 2)])
    assert rows(dedupe_latest(s, ["k"], ["v"], nullable_keys=True)) == sorted([(None, 1), (None, 2), (3, 2)], key=repr)


def test_dedupe_prunes_before_the_shuffle(spark):
    text = plan(dedupe_latest(frame(spark, [(1, 1)]), ["k"], ["v"]))
    assert text.count("WindowGroupLimit") == 2
    partial = [line for line in text.splitlines() if "Partial" in line]
    assert partial and text.index(partial[0]) > text.index("Exchange")


def test_dedupe_breaks_ties_by_the_remaining_columns(spark):
    s = frame(spark, [(1, 1, "b"), (1, 1, "c"), (1, 1, "a")], "k int, v int, w string")
    assert rows(dedupe_latest(s, ["k"], ["v"])) == [(1, 1, "c")]


def test_null_key_rows_do_not_share_one_shuffle_partition(spark):
    """A third of the rows without a key must not end up in one task."""
    t = spark.range(9000).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    s = spark.range(5).select(F.col("id").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        kept = anti_join(t, s, ["k"])
        per_task = kept.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r[1] for r in per_task) == 3000
    assert len(per_task) == 8 and max(r[1] for r in per_task) < 1000


def test_left_join_keeps_unmatched_and_null_keys(spark):
    left = frame(spark, [(1, 1), (None, 2), (3, 3)])
    right = frame(spark, [(1, "a"), (1, "b"), (None, "n")], "k int, w string")
    expected = sorted([(1, 1, "a"), (1, 1, "b"), (None, 2, None), (3, 3, None)], key=repr)
    assert rows(left_join(left, right, ["k"])) == expected


@pytest.mark.parametrize("max_rows", [3, 10_000])
def test_left_join_many_equals_a_plain_left_join(spark, max_rows):
    """One key holds most of the right side, some keys are null, some match nothing."""
    left = spark.sql("SELECT CAST(id % 7 AS INT) k, id v FROM range(20)").union(spark.sql("SELECT NULL, 99L"))
    right = spark.sql("SELECT IF(id % 3 = 0, 1, CAST(id % 5 + 2 AS INT)) k, id w FROM range(200) WHERE id % 5 <> 1")
    right = right.union(spark.sql("SELECT NULL, 7L"))
    plain = left.join(right, "k", "left").select("k", "v", "w")
    assert rows(left_join_many(left, right, ["k"], max_rows=max_rows, buckets=4)) == rows(plain)


def test_identical_rows_of_a_hot_key_are_spread(spark):
    left = spark.createDataFrame([(1, "l"), (2, "m")], "k int, v string")
    copies = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"), F.lit("same").alias("w"))
    joined = left_join_many(left, copies, ["k"], max_rows=100, buckets=64)
    assert joined.distinct().count() == 2 and joined.count() == 4001
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = left_join_many(left, copies, ["k"], max_rows=100, buckets=64)
        per_task = wide.where("k = 1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r[1] for r in per_task) == 4000 and len(per_task) > 2


def test_map_columns_are_carried_along(spark):
    t = spark.sql("SELECT CAST(NULL AS INT) k, map('a', 1) m UNION ALL SELECT 1, map('b', 2)")
    s = spark.sql("SELECT 1 k, map('c', 3) m")
    assert sorted(str(r.m) for r in upsert(t, s, ["k"], on_duplicate="keep").collect()) == ["{'a': 1}", "{'c': 3}"]
    assert dedupe_latest(t.union(s), ["k"], ["k"]).count() == 2
    assert left_join_many(s, t.withColumnRenamed("m", "n"), ["k"], max_rows=0).count() == 1


# --- conforming union ------------------------------------------------------------------------------------------------


def test_conform_union_columns_and_nulls(spark):
    narrow, wide = frame(spark, [(1, 1)]), frame(spark, [(2, "x", 0.5)], "k int, w string, z double")
    out = conform_union([narrow, wide])
    assert out.columns == ["k", "w", "z", "v"]
    assert rows(out) == sorted([(2, "x", 0.5, None), (1, None, None, 1)], key=repr)


def test_widest_first_is_stable(spark):
    a, b, c = frame(spark, [(1, 1)]), frame(spark, [(1, 1)], "x int, y int"), frame(spark, [(1,)], "q int")
    assert [df.columns for df in widest_first([c, a, b])] == [["k", "v"], ["x", "y"], ["q"]]


def test_conform_union_treats_names_case_insensitively(spark):
    out = conform_union([frame(spark, [(1, 1)], "UserName int, v int"), frame(spark, [(2,)], "Username int")])
    assert out.columns == ["UserName", "v"]
    assert rows(out) == sorted([(1, 1), (2, None)], key=repr)


def test_conform_union_resolves_type_drift(spark):
    out = conform_union([frame(spark, [(1, 1)], "k int, v int"), frame(spark, [("z", 2)], "k string, v bigint")])
    assert dict(out.dtypes) == {"k": "string", "v": "bigint"}
    assert rows(out) == [("1", 1), ("z", 2)]


@modest
@given(sizes=st.lists(st.integers(0, 4), min_size=1, max_size=4))
def test_conform_union_is_a_bag_union(spark, sizes):
    frames = [
        frame(spark, [(i, n) for i in range(n)], DDL).withColumn(f"only_{j}", F.lit(j)) for j, n in enumerate(sizes)
    ]
    assert conform_union(frames).count() == sum(sizes)


def test_checked_batch_is_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t, s = spark.range(100).withColumn("v", F.lit(1)), spark.range(50, 60).withColumn("v", F.lit(2))
        text = plan(upsert(t, s, ["id"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


@pytest.fixture
def large(spark):
    """Settings under which small test data is treated like large: no automatic broadcast, low skew thresholds."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key in conf:
        spark.conf.unset(key)


def test_upsert_shuffles_the_target_once(spark, large):
    t, s = (spark.range(n).select((F.col("id") * 7 % 1000).alias("k"), F.lit(n).alias("v")) for n in (100, 10))
    text = plan(upsert(t, s, ["k"], on_duplicate="keep", nullable_keys=False))
    assert count(text, "Exchange") == 3  # the target once; the batch's keys to be folded and to be joined


@pytest.mark.parametrize("join", [anti_join, semi_join])
@pytest.mark.parametrize("nullable", [True, False])
def test_hot_key_is_split(spark, large, join, nullable):
    """One key owns half of the left side: several tasks share its partition."""
    t = spark.range(200_000).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), F.xxhash64("id").alias("v")
    )
    s = spark.range(5, 9).select(F.col("id").alias("k")).union(spark.range(5, 9))
    got = join(t, s, ["k"], nullable)
    expected = 100_000 + 2 if join is semi_join else 100_000 - 2
    assert len(got.collect()) == expected
    assert "skew=true" in plan(got) or "skewed" in plan(got)


@pytest.mark.parametrize("zone", ["UTC", "America/Chicago", "Asia/Tokyo"])
def test_partition_pruning_finds_the_same_rows_in_every_zone(spark, zone):
    from datetime import datetime, timezone

    from tidemark import spec as S
    from tidemark.operators.enrich import add_lineage
    from tidemark.operators.watermarks import filter_lookback, filter_since

    table = S.TableSpec("h", "d", "s", "t", ("k",), "at")
    last = datetime(2024, 3, 10, 2, 30, tzinfo=timezone.utc)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        hours = spark.range(-60, 60).select(
            F.col("id").alias("k"), F.timestamp_seconds(F.lit(int(last.timestamp())) + F.col("id") * 3600 + 1).alias("at")
        )
        rows = add_lineage(hours, table)
        for narrow in (filter_since, filter_lookback):
            plain, pruned = narrow(rows, "at", last), narrow(rows, "at", last, partition_date=S.PARTITION_DATE)
            assert pruned.count() == plain.count() > 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
