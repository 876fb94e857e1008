"""Sinks: snapshots, partitioned upserts, catalog entries, landed batches."""

import json
import shutil
from datetime import date, datetime
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.plans import plan
from tidemark.operators.joins import rows_of_keys
from tidemark.sources import keyindex, landing, paths, tables
from tidemark.sources.rows import local_frame
from tidemark.session import scratch_path


@pytest.fixture
def base(spark):
    return scratch_path(spark, "tables")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- snapshots -------------------------------------------------------------------------------------------------------


def test_snapshot_may_read_the_version_it_replaces(spark, base):
    tables.write_snapshot(spark.range(3), base)
    tables.write_snapshot(tables.read_snapshot(spark, base).unionByName(spark.range(3, 5)), base)
    assert tables.read_snapshot(spark, base).count() == 5
    assert len(paths.subfolders(spark, base)) == 2
    assert len(tables.drop_old_snapshots(spark, base)) == 1
    assert tables.read_snapshot(spark, base).count() == 5


def test_crash_before_the_switch_keeps_the_old_version(spark, base):
    tables.write_snapshot(spark.range(3), base)
    failing = spark.range(3).select(F.raise_error(F.lit("boom")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        tables.write_snapshot(failing, base)
    assert tables.read_snapshot(spark, base).count() == 3


def test_missing_snapshot(spark, base):
    assert not tables.snapshot_exists(spark, base)
    assert tables.drop_old_snapshots(spark, base) == []
    with pytest.raises(FileNotFoundError):
        tables.read_snapshot(spark, base)


def test_promote_copies(spark, base):
    tables.write_snapshot(spark.range(4), f"{base}/a")
    tables.promote(spark, f"{base}/a", f"{base}/b")
    assert rows(tables.read_table(spark, f"{base}/b", "snapshot")) == [(0,), (1,), (2,), (3,)]


def test_read_table_formats(spark, base):
    tables.overwrite(spark.range(2), f"{base}/p")
    tables.append(spark.range(2, 3), f"{base}/p")
    assert tables.read_table(spark, f"{base}/p").count() == 3
    spark.range(2).write.json(f"{base}/j")
    assert tables.read_table(spark, f"{base}/j", "json").count() == 2


# --- partitioned upsert ----------------------------------------------------------------------------------------------

DDL = "k int, v string, part date"


def made(spark, *entries):
    return spark.createDataFrame([(k, v, date(2024, 1, d) if d else None) for k, v, d in entries], DDL)


def test_only_touched_partitions_are_rewritten(spark, base):
    tables.upsert_partitions(spark, base, made(spark, (1, "a", 1), (2, "a", 2), (3, "a", 3)), ["k"], "part")
    before = {f: paths.subfolders(spark, base) and spark.read.parquet(f"{base}/{f}").inputFiles() for f in paths.subfolders(spark, base)}
    touched = tables.upsert_partitions(spark, base, made(spark, (2, "b", 2), (4, "b", 2)), ["k"], "part")
    assert touched == [date(2024, 1, 2)]
    after = {f: spark.read.parquet(f"{base}/{f}").inputFiles() for f in before}
    assert [f for f in before if before[f] != after[f]] == ["part=2024-01-02"]
    assert rows(tables.read_partitioned(spark, base).select("k", "v")) == [(1, "a"), (2, "b"), (3, "a"), (4, "b")]


def test_a_key_that_moves_leaves_no_copy_behind(spark, base):
    tables.upsert_partitions(spark, base, made(spark, (1, "a", 1), (2, "a", 1), (3, "a", 2)), ["k"], "part")
    tables.upsert_partitions(spark, base, made(spark, (1, "b", 5), (3, "b", 5)), ["k"], "part")
    got = rows(tables.read_partitioned(spark, base))
    assert got == rows(made(spark, (1, "b", 5), (2, "a", 1), (3, "b", 5)))
    folders = [name for name in paths.subfolders(spark, base) if not name.startswith("_")]
    assert folders == ["part=2024-01-01", "part=2024-01-05"]


def test_null_partition_value(spark, base):
    tables.upsert_partitions(spark, base, made(spark, (1, "a", None), (2, "a", 1)), ["k"], "part")
    tables.upsert_partitions(spark, base, made(spark, (1, "b", 2)), ["k"], "part")
    assert rows(tables.read_partitioned(spark, base)) == rows(made(spark, (1, "b", 2), (2, "a", 1)))
    tables.upsert_partitions(spark, base, made(spark, (2, "c", None)), ["k"], "part")
    assert rows(tables.read_partitioned(spark, base)) == rows(made(spark, (1, "b", 2), (2, "c", None)))


def test_new_column_reads_as_null_in_old_partitions(spark, base):
    tables.upsert_partitions(spark, base, made(spark, (1, "a", 1), (2, "a", 2)), ["k"], "part")
    wider = made(spark, (2, "b", 2)).withColumn("extra", F.lit(7))
    tables.upsert_partitions(spark, base, wider, ["k"], "part")
    assert rows(tables.read_partitioned(spark, base).select("k", "v", "extra")) == [(1, "a", None), (2, "b", 7)]


def test_empty_batch_changes_nothing(spark, base):
    tables.upsert_partitions(spark, base, made(spark, (1, "a", 1)), ["k"], "part")
    assert tables.upsert_partitions(spark, base, made(spark), ["k"], "part") == []


def test_batch_over_the_broadcast_bound_gives_the_same(spark, base, monkeypatch):
    monkeypatch.setattr(tables, "BROADCAST_ROWS", 0)
    test_a_key_that_moves_leaves_no_copy_behind(spark, base)


entries = st.dictionaries(st.integers(0, 6), st.tuples(st.sampled_from("ab"), st.integers(1, 3)), max_size=6)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(entries, min_size=2, max_size=3))
def test_batches_in_sequence_equal_a_dictionary(spark, batches):
    base, model = scratch_path(spark, "model"), {}
    for batch in batches:
        df = made(spark, *[(k, v, d) for k, (v, d) in batch.items()])
        tables.upsert_partitions(spark, base, df, ["k"], "part")
        model |= batch
        assert rows(tables.read_partitioned(spark, base)) == rows(made(spark, *[(k, v, d) for k, (v, d) in model.items()]))


def test_rows_of_keys_reads_only_partitions_that_hold_one(spark, base):
    tables.upsert_partitions(spark, base, made(spark, (1, "a", 1), (2, "a", 2), (3, "a", None), (4, "a", 3)), ["k"], "part")
    wanted = spark.createDataFrame([(2,), (3,), (9,)], "k int")
    df = rows_of_keys(tables.read_partitioned(spark, base), wanted, ["k"], "part", small=True)
    assert rows(df.select("k")) == [(2,), (3,)]
    assert len(df.inputFiles()) == 4 and "2024-01-02" in plan(df, "formatted")
    pruned = df.where("part = DATE '2024-01-01'")
    assert rows(pruned) == []


# --- catalog ---------------------------------------------------------------------------------------------------------


def test_register_and_query(spark, base):
    tables.write_snapshot(spark.range(3), f"{base}/snap")
    tables.upsert_partitions(spark, f"{base}/parts", made(spark, (1, "a", 1)), ["k"], "part")
    assert not tables.table_exists(spark, "snap", "gold_t")
    tables.register_table(spark, "snap", f"{base}/snap", "gold_t")
    tables.register_table(spark, "parts", f"{base}/parts", "gold_t")
    assert spark.sql("SELECT count(*) FROM gold_t.snap").head()[0] == 3
    assert spark.table("gold_t.parts").count() == 1
    tables.write_snapshot(spark.range(5), f"{base}/snap")
    tables.register_table(spark, "snap", f"{base}/snap", "gold_t")
    assert spark.table("gold_t.snap").count() == 5
    tables.replace_managed_table(spark.range(2), "managed", "gold_t")
    tables.replace_managed_table(spark.range(6), "managed", "gold_t")
    assert tables.table_exists(spark, "managed", "gold_t") and spark.table("gold_t.managed").count() == 6


# --- landing ---------------------------------------------------------------------------------------------------------


def test_landed_batches_and_ledger(spark, base):
    names = [landing.batch_name("t", datetime(2024, 1, d)) for d in (2, 1, 3)]
    for i, name in enumerate(names):
        landing.land(spark.range(i + 1), base, name)
    spark.range(1).write.parquet(f"{base}/{landing.BATCH}=crashed")
    paths.delete(spark, f"{base}/{landing.BATCH}=crashed/_SUCCESS")
    assert landing.landed_batches(spark, base) == sorted(names)
    assert landing.latest_landed(spark, base) == names[2]
    both = landing.read_batches(spark, base, names[:2])
    assert both.count() == 3
    assert rows(landing.latest_batch(both).select(landing.BATCH)) == [(names[0],)]
    ledger = f"{base}-ledger"
    landing.record(ledger, landing.ledger_rows(spark, "src", names[:1], "processed"))
    landing.record(ledger, landing.ledger_rows(spark, "src", names[1:2], "failed"))
    batches = local_frame(spark, [("src", n) for n in names], "source string, batch_id string")
    pending = landing.pending_batches(batches, landing.read_ledger(spark, ledger))
    assert rows(pending) == sorted([("src", n) for n in names[1:]])


def test_landing_a_batch_again_replaces_it(spark, base):
    landing.land(spark.range(3), base, "b")
    landing.land(spark.range(2), base, "b")
    assert landing.read_batches(spark, base, ["b"]).count() == 2


def test_reading_batches_skips_the_others(spark, base):
    for name in ("a", "b"):
        landing.land(spark.range(1), base, name)
    text = plan(landing.read_batches(spark, base, ["b"]), "formatted")
    assert "batch_id=b" in text and "batch_id=a" not in text


def test_batches_with_drifting_schemas_are_read_together(spark, base):
    landing.land(spark.createDataFrame([(1, 7, "x")], "k int, v int, old string"), base, "b1")
    landing.land(spark.createDataFrame([(2, "seven", 2.5)], "k bigint, v string, fresh double"), base, "b2")
    landing.land(spark.createDataFrame([(3, "nine", 3.5)], "k bigint, v string, fresh double"), base, "b3")
    df = landing.read_batches(spark, base, ["b1", "b2", "b3"])
    found = {r.batch_id: (r.k, r.v, r.old, r.fresh) for r in df.collect()}
    assert found == {"b1": (1, "7", "x", None), "b2": (2, "seven", None, 2.5), "b3": (3, "nine", None, 3.5)}
    text = plan(df)
    assert text.count("FileScan parquet") == 2 and "mergeSchema" not in text  # one scan for each schema


def test_types_without_a_common_one_become_text(spark, base):
    landing.land(spark.createDataFrame([(1, 7)], "k int, v int"), base, "b1")
    landing.land(spark.sql("SELECT 2 AS k, DATE '2024-01-02' AS v"), base, "b2")
    assert {r.v for r in landing.read_batches(spark, base, ["b1", "b2"]).collect()} == {"7", "2024-01-02"}


def test_a_batch_without_a_kept_schema_is_read_by_its_own_footer(spark, base):
    landing.land(spark.createDataFrame([(1, 7)], "k int, v int"), base, "b1")
    spark.createDataFrame([(2, "x")], "k int, v string").write.parquet(f"{base}/{landing.BATCH}=b2")
    assert {r.v for r in landing.read_batches(spark, base, ["b1", "b2"]).collect()} == {"7", "x"}


def test_local_frame_needs_no_python_workers(spark):
    df = local_frame(spark, [(1, None), (2, "x")], "a int, b string")
    assert rows(df) == [(1, None), (2, "x")]
    assert "LocalTableScan" in plan(df)


@pytest.mark.parametrize("values", [("a:b", "2024/01", "x y"), (True, False, None), ("50%", "=", None)])
def test_moving_keys_leave_no_copy_behind_whatever_the_partition_value(spark, base, values):
    one, two, three = values
    kind = "boolean" if isinstance(one, bool) else "string"
    table = lambda *rows: spark.createDataFrame(rows, f"k int, v string, part {kind}")
    tables.upsert_partitions(spark, base, table((1, "a", one), (2, "a", two), (3, "a", three)), ["k"], "part")
    tables.upsert_partitions(spark, base, table((1, "b", two), (3, "b", two)), ["k"], "part")
    got = sorted(((r.k, r.v, r.part) for r in tables.read_partitioned(spark, base).collect()), key=repr)
    assert got == [(1, "b", two), (2, "a", two), (3, "b", two)]


@pytest.mark.parametrize("fail_at", range(1, 7))
def test_an_interrupted_upsert_loses_nothing(spark, base, monkeypatch, fail_at):
    from tidemark.sources import paths

    tables.upsert_partitions(spark, base, made(spark, (1, "a", 1), (2, "a", 1), (3, "a", 2), (4, "a", 3)), ["k"], "part")
    calls = {"n": 0}

    def failing(function):
        def run(*args):
            calls["n"] += 1
            if calls["n"] == fail_at:
                raise OSError("the driver dies")
            return function(*args)

        return run

    batch = made(spark, (1, "b", 2), (4, "b", 2))
    with monkeypatch.context() as patch:
        patch.setattr(paths, "delete", failing(paths.delete))
        patch.setattr(paths, "move", failing(paths.move))
        with pytest.raises(OSError):
            tables.upsert_partitions(spark, base, batch, ["k"], "part")
    tables.upsert_partitions(spark, base, batch, ["k"], "part")
    got = sorted((r.k, r.v, r.part.day) for r in tables.read_partitioned(spark, base).collect())
    assert got == [(1, "b", 2), (2, "a", 1), (3, "a", 2), (4, "b", 2)]


def test_duplicate_keys_are_an_error_or_resolved(spark, base):
    batch = made(spark, (1, "a", 1), (1, "b", 1))
    with pytest.raises(ValueError, match="share the key"):
        tables.upsert_partitions(spark, base, batch, ["k"], "part")
    tables.upsert_partitions(spark, base, batch, ["k"], "part", on_duplicate="latest", order=["v"])
    assert [r.v for r in tables.read_partitioned(spark, base).collect()] == ["b"]


@pytest.mark.parametrize("first, second", [("int", "string"), ("string", "int"), ("int", "double"), ("int", "bigint")])
def test_a_column_may_change_its_type(spark, base, first, second):
    table = lambda kind, *rows: spark.createDataFrame(rows, "k int, v int, part int").withColumn("v", F.col("v").cast(kind))
    tables.upsert_partitions(spark, base, table(first, (1, 10, 1), (2, 20, 2)), ["k"], "part")
    tables.upsert_partitions(spark, base, table(second, (2, 21, 2), (3, 30, 3)), ["k"], "part")
    got = {r.k: float(r.v) for r in tables.read_partitioned(spark, base).collect()}
    assert got == {1: 10.0, 2: 21.0, 3: 30.0}
    tables.upsert_partitions(spark, base, table(first, (3, 31, 1)), ["k"], "part")
    assert {r.k: float(r.v) for r in tables.read_partitioned(spark, base).collect()} == {1: 10.0, 2: 21.0, 3: 31.0}


def test_registering_again_follows_columns_and_partitions(spark, base):
    tables.upsert_partitions(spark, base, made(spark, (1, "a", 1), (2, "a", 2)), ["k"], "part")
    tables.register_table(spark, "followed", base)
    wider = made(spark, (1, "b", 2)).withColumn("more", F.lit(5))
    tables.upsert_partitions(spark, base, wider, ["k"], "part")
    tables.register_table(spark, "followed", base)
    assert sorted((r.k, r.v, r.more) for r in spark.table("followed").collect()) == [(1, "b", 5), (2, "a", None)]
    assert [r.partition for r in spark.sql("SHOW PARTITIONS followed").collect()] == ["part=2024-01-02"]
    spark.sql("DROP TABLE followed")


def test_files_read_by_an_upsert_depend_on_the_batch(spark, base, monkeypatch):
    tables.upsert_partitions(spark, base, made(spark, *[(k, "a", 1 + k % 28) for k in range(200)]), ["k"], "part")
    read = []
    monkeypatch.setattr(tables, "read_partitioned", lambda *args: read.append(args))
    touched = tables.upsert_partitions(spark, base, made(spark, (3, "b", 4), (900, "c", 7)), ["k"], "part", stable_partition=True)
    assert len(touched) == 2 and touched.rows == 2 and read == []
    monkeypatch.undo()
    got = {r.k: r.v for r in tables.read_partitioned(spark, base).collect()}
    assert len(got) == 201 and got[3] == "b" and got[900] == "c"


# --- key index -------------------------------------------------------------------------------------------------------

PARTS = "k int, v string, part int"


def moved(spark, base, *batch, **options):
    return tables.upsert_partitions(spark, base, spark.createDataFrame(batch, PARTS), ["k"], "part", **options)


def garble(folder):
    for file in Path(folder).rglob("*.parquet"):
        file.write_bytes(b"not parquet")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)


def indexed(spark, base, monkeypatch):
    """A table of ten partitions with an index of several buckets."""
    monkeypatch.setattr(keyindex, "INDEX_FROM", 0)
    monkeypatch.setattr(keyindex, "BUCKET_PAIRS", 10)
    moved(spark, base, *[(k, "a", k % 10) for k in range(100)])
    moved(spark, base, (0, "b", 0))
    return {k: ("b" if k == 0 else "a", k % 10) for k in range(100)}


def stored(spark, base):
    found = tables.read_partitioned(spark, base).collect()
    assert len(found) == len({r.k for r in found})
    return {r.k: (r.v, r.part) for r in found}


def test_an_upsert_of_few_keys_reads_only_their_buckets_and_partitions(spark, base, monkeypatch):
    expected = indexed(spark, base, monkeypatch)
    index = keyindex.KeyIndex(spark, base, ("k",), "part", tables._stored_schema(spark, base))
    pairs = index.pairs_of(spark.createDataFrame([(57, "c", 3)], PARTS))
    used = {f.rsplit("/", 2)[1] for f in index.matching(pairs).inputFiles()}
    assert len(used) == 1 and len(list(Path(base).glob("_keys/*/bucket=*"))) > 5
    kept = {"part=7", "part=3"}
    backup = Path(f"{base}-backup")
    shutil.copytree(base, backup)
    for folder in [*Path(base).glob("part=*"), *Path(base).glob("_keys/*/bucket=*")]:
        if folder.name not in kept and folder.name not in used:
            garble(folder)
    assert sorted(moved(spark, base, (57, "c", 3))) == [3, 7]  # what is not needed could not even be read
    for n in range(10):
        if f"part={n}" not in kept:
            shutil.rmtree(f"{base}/part={n}")
            shutil.copytree(backup / f"part={n}", f"{base}/part={n}")
    assert stored(spark, base) == expected | {57: ("c", 3)}


def test_keys_that_move_again_and_again(spark, base, monkeypatch):
    expected = indexed(spark, base, monkeypatch)
    monkeypatch.setattr(keyindex, "MAX_APPENDS", 3)
    for turn in range(1, 6):
        batch = [(k, f"t{turn}", (k + turn) % 10) for k in range(0, 130, turn + 1)]
        moved(spark, base, *batch)
        expected |= {k: (v, p) for k, v, p in batch}
    assert stored(spark, base) == expected
    state = json.loads(paths.read_text(spark, f"{base}/{keyindex.STATE}"))
    assert state["appends"] < 3 and len([n for n in paths.subfolders(spark, f"{base}/_keys")]) == 1


def test_an_index_is_not_trusted_after_other_writes(spark, base, monkeypatch):
    expected = indexed(spark, base, monkeypatch)
    tables.append(spark.createDataFrame([(500, "x", 4)], PARTS), base, ["part"])
    moved(spark, base, (500, "y", 5))
    moved(spark, base, (700, "s", 6), stable_partition=True)
    moved(spark, base, (700, "t", 1))
    assert stored(spark, base) == expected | {500: ("y", 5), 700: ("t", 1)}


def test_repeated_upserts_do_not_grow_the_index(spark, base, monkeypatch):
    indexed(spark, base, monkeypatch)
    before = paths.read_text(spark, f"{base}/{keyindex.STATE}")
    for v in "xyz":
        moved(spark, base, (5, v, 5), (6, v, 6))
    assert paths.read_text(spark, f"{base}/{keyindex.STATE}") == before


def test_a_large_batch_scans_the_keys_and_drops_the_index(spark, base, monkeypatch):
    expected = indexed(spark, base, monkeypatch)
    assert paths.exists(spark, f"{base}/{keyindex.STATE}")
    monkeypatch.setattr(tables, "BROADCAST_ROWS", 0)
    batch = [(k, "large", (k + 3) % 12) for k in range(0, 130, 2)]
    assert sorted(moved(spark, base, *batch)) == [*range(10), 11]
    expected |= {k: (v, p) for k, v, p in batch}
    assert stored(spark, base) == expected and not paths.exists(spark, f"{base}/{keyindex.STATE}")
    with pytest.raises(ValueError, match="share the key"):
        moved(spark, base, (1, "x", 1), (1, "y", 2))
    assert stored(spark, base) == expected and not list(Path(base).glob("_stage*"))


def test_a_small_table_needs_no_index(spark, base):
    moved(spark, base, (1, "a", 1), (2, "a", 2))
    moved(spark, base, (1, "b", 2))
    assert stored(spark, base) == {1: ("b", 2), 2: ("a", 2)} and not paths.exists(spark, f"{base}/{keyindex.STATE}")


def test_keys_of_other_types_and_null_partitions_are_found(spark, base, monkeypatch):
    monkeypatch.setattr(keyindex, "INDEX_FROM", 0)
    make = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    put = lambda df: tables.upsert_partitions(spark, base, df, ["k"], "part")
    put(make([(1.5, "a", None), (0.0, "a", "p"), (3.0, "a", "q")], "k double, v string, part string"))
    put(make([(1.5, "b", "p")], "k float, v string, part string"))
    put(make([(-0.0, "c", "q"), (4.0, "c", None)], "k double, v string, part string"))
    put(make([(3, "d", "p"), (4, "d", "r")], "k int, v string, part string"))
    assert {r.k: (r.v, r.part) for r in tables.read_partitioned(spark, base).collect()} == {
        1.5: ("b", "p"), 0.0: ("c", "q"), 3.0: ("d", "p"), 4.0: ("d", "r"),
    }
    assert tables.read_partitioned(spark, base).count() == 4


# --- registration in place -------------------------------------------------------------------------------------------


def statements(spark, monkeypatch):
    """SQL that runs from here on."""
    seen, run = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, query, *a, **k: seen.append(query) or run(self, query, *a, **k))
    return seen


def test_a_registered_table_is_never_absent(spark, base, monkeypatch):
    name = f"live_{base[-32:]}"
    moved(spark, base, (1, "a", 1), (2, "a", 2))
    tables.register_table(spark, name, base)
    seen = statements(spark, monkeypatch)
    wider = spark.createDataFrame([(2, "b", "new", 3)], "k int, v string, w string, part int")
    tables.upsert_partitions(spark, base, wider, ["k"], "part")
    tables.register_table(spark, name, base)
    assert rows(spark.table(f"default.{name}").select("k", "v", "w", "part")) == [(1, "a", None, 1), (2, "b", "new", 3)]
    assert not any("DROP" in q for q in seen) and any("ADD COLUMNS" in q for q in seen)
    gone = spark.sql(f"SHOW PARTITIONS default.{name}").collect()
    assert {r[0] for r in gone} == {"part=1", "part=3"}


def test_a_new_snapshot_moves_the_entry(spark, base, monkeypatch):
    name = f"snap_{base[-32:]}"
    tables.write_snapshot(spark.range(2), base)
    tables.register_table(spark, name, base)
    seen = statements(spark, monkeypatch)
    tables.write_snapshot(spark.range(5), base)
    tables.register_table(spark, name, base)
    assert spark.table(f"default.{name}").count() == 5
    assert not any("DROP" in q for q in seen) and any("SET LOCATION" in q for q in seen)


def test_a_changed_type_makes_the_entry_anew(spark, base):
    name = f"drift_{base[-32:]}"
    moved(spark, base, (1, "a", 1))
    tables.register_table(spark, name, base)
    tables.upsert_partitions(spark, base, spark.createDataFrame([(2, 5.5, 1)], "k int, v double, part int").withColumn("k", F.col("k").cast("string")), ["k"], "part")
    tables.register_table(spark, name, base)
    assert rows(spark.table(f"default.{name}").select("k", "v")) == [("1", "a"), ("2", "5.5")]
