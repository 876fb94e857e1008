"""The layered flow: replays, crashes, isolation, state."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark import spec as S
from tidemark.operators import runlog
from tests.test_scd2 import employees
from tidemark.operators.upsert import dedupe_latest
from tidemark.plans import medallion
from tidemark.plans.fact import FactSpec
from tidemark.plans.medallion import Medallion, OnError
from tidemark.plans.presets import EMPLOYEE_DIM, employee_layout, employee_schema, employee_seed, employee_versions
from tidemark.session import scratch_path
from tidemark.sources import landing, paths, tables
from tidemark.spec import LoadType, TableSpec
from tidemark.streaming.ingest import stream_to_bronze

DDL = "k int, at timestamp, v string"
A, B = (TableSpec(host, "db", "dbo", "calls", ("k",), "at") for host in ("srv-a", "srv-b"))
FULL = TableSpec("srv-a", "db", "dbo", "codes", ("k",), load_type=LoadType.FULL)


def utc(day, hour=0, micro=0):
    return datetime(2024, 1, day, hour, 0, 0, micro, tzinfo=timezone.utc)


def pull(spark, *rows):
    return spark.createDataFrame([(k, utc(d), v) for k, d, v in rows], DDL)


@pytest.fixture
def lake(spark):
    return Medallion(spark, scratch_path(spark, "lake"))


def content(df):
    return sorted(tuple(r) for r in df.select(S.SOURCE_SERVER, "k", "v").collect())


def run(lake, pulls, day):
    specs = list(pulls)
    for spec, df in pulls.items():
        lake.land(spec, df, utc(day))
    lake.bronze_all(specs)
    loads = lake.silver(specs)
    lake.commit()
    return loads


def test_two_batches_and_watermarks(spark, lake):
    run(lake, {A: pull(spark, (1, 1, "a"), (2, 2, "a")), B: pull(spark, (1, 3, "b"))}, 4)
    assert lake.at_watermark(A).last_loaded == utc(2) and lake.at_watermark(B).last_loaded == utc(3)
    assert lake.earliest("calls") == utc(2)
    run(lake, {A: pull(spark, (2, 5, "A"), (3, 5, "A")), B: pull(spark)}, 6)
    assert content(lake.read_silver(A)) == [("srv-a", 1, "a"), ("srv-a", 2, "A"), ("srv-a", 3, "A"), ("srv-b", 1, "b")]
    assert lake.at_watermark(B).last_loaded == utc(3)


def test_unknown_table_has_no_earliest_watermark(lake):
    with pytest.raises(LookupError):
        lake.earliest("nothing")


def test_whole_rows_are_deduplicated_only_where_a_key_repeats(spark, lake, monkeypatch):
    calls = []
    monkeypatch.setattr(medallion, "dedupe_latest", lambda *args: calls.append(args) or dedupe_latest(*args))
    lake.land(A, pull(spark, (1, 1, "a"), (2, 1, "b")), utc(1))
    assert lake.bronze(A).rows == 2 and not calls
    lake.land(A, pull(spark, (2, 2, "old"), (2, 3, "new"), (3, 2, "c")), utc(3))
    assert lake.bronze(A).rows == 3 and len(calls) == 1
    assert content(lake.read_bronze(A)) == [("srv-a", 1, "a"), ("srv-a", 2, "new"), ("srv-a", 3, "c")]


def test_all_pending_batches_are_read_and_the_newest_wins(spark, lake):
    lake.land(A, pull(spark, (1, 1, "old"), (2, 1, "only here")), utc(1))
    lake.land(A, pull(spark, (1, 2, "new")), utc(2))
    lake.bronze(A)
    assert content(lake.read_bronze(A)) == [("srv-a", 1, "new"), ("srv-a", 2, "only here")]
    assert lake.pending(A) == []


def test_crash_between_bronze_write_and_ledger_is_repaired(spark, lake, monkeypatch):
    lake.land(A, pull(spark, (1, 1, "a")), utc(1))
    with monkeypatch.context() as m:
        m.setattr(lake, "_record", lambda *args, **kwargs: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError, match="crash"):
            lake.bronze(A)
    assert len(lake.pending(A)) == 1
    lake.bronze(A)
    assert content(lake.read_bronze(A)) == [("srv-a", 1, "a")]
    assert lake.pending(A) == []


def test_crash_between_silver_write_and_commit_rereads(spark, lake):
    lake.land(A, pull(spark, (1, 1, "a")), utc(1))
    lake.bronze(A)
    lake.silver([A])
    assert lake.at_watermark(A).last_loaded == S.NEVER_LOADED
    lake.silver([A])
    lake.commit()
    assert content(lake.read_silver(A)) == [("srv-a", 1, "a")]


def test_failed_bronze_batch_stays_pending(spark, lake):
    lake.land(A, pull(spark, (1, 1, "a")).drop("k"), utc(1))
    with pytest.raises(Exception):
        lake.bronze_all([A])
    assert len(lake.pending(A)) == 1
    failed = runlog.read_log(spark, lake.log_path).where(F.col("notebook_execution_status") == runlog.FAILED)
    assert failed.count() == 1


def test_failing_server_does_not_stop_the_others(spark, lake):
    def read(spec):
        if spec.host == "srv-a":
            raise ConnectionError("unreachable")
        return pull(spark, (1, 1, "b"))

    loads = lake.land_all([A, B], read)
    assert [x.status for x in loads] == [runlog.FAILED, runlog.SUCCESS]
    with pytest.raises(ConnectionError):
        lake.land_all([A, B], read, OnError.ABORT)


def test_last_second_is_read_again(spark, lake):
    df = spark.createDataFrame([(1, utc(1, micro=700_000), "a")], DDL)
    run(lake, {A: df}, 2)
    assert lake.at_watermark(A).last_loaded == utc(1)
    assert lake.gather([A]).count() == 1


def test_nothing_landed_is_empty_not_failed(lake):
    assert lake.bronze(A).status == runlog.EMPTY
    assert [x.status for x in lake.silver([A, B])] == [runlog.EMPTY, runlog.EMPTY]


def test_silver_scan_prunes_partitions(spark, lake):
    from tests.plans import plan

    run(lake, {A: pull(spark, *[(i, i + 1, "a") for i in range(5)])}, 9)
    text = plan(lake.gather([A]), "formatted")
    assert "PartitionFilters: [isnotnull(__PartitionDateUTC" in text and "2024-01-05" in text


def test_full_load(spark, lake):
    codes = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    lake.land(FULL, codes, utc(1))
    lake.bronze(FULL)
    lake.silver([FULL])
    lake.land(FULL, codes.where("k = 1"), utc(2))
    lake.bronze(FULL)
    lake.silver([FULL])
    lake.promote(["codes"])
    gold = tables.read_snapshot(spark, lake.path("gold", "codes"))
    assert [tuple(r) for r in gold.select("k", "v").collect()] == [(1, "x")]
    assert S.PARTITION_DATE not in gold.columns
    lake.commit()
    assert lake.at_watermark(FULL).last_loaded > S.NEVER_LOADED
    lake.register("gold", "codes")
    assert spark.table("gold.codes").count() == 1


def test_fact_attaches_attributes_that_arrive_later(spark, lake):
    calls = TableSpec("srv-a", "db", "dbo", "calls", ("k",), "at")
    notes = TableSpec("srv-a", "db", "dbo", "notes", ("k",), "at")
    fact = FactSpec(
        keys=("k",), base={c: c for c in ("k", "at", "v", S.PARTITION_DATE)}, attributes={"note": "v"}, matched="callId"
    )

    def step(call_rows, note_rows, day):
        for spec, rows in ((calls, call_rows), (notes, note_rows)):
            lake.land(spec, pull(spark, *rows), utc(day))
            lake.bronze(spec)
            lake.silver([spec])
        lake.fact("fact_calls", calls, notes, fact, ["Fact_ID", "k"], S.PARTITION_DATE)
        lake.commit()
        got = tables.read_partitioned(spark, lake.path("gold", "fact_calls"))
        return sorted((tuple(r) for r in got.select("k", "v", "note").collect()), key=repr)

    assert step([(1, 1, "a"), (2, 1, "a")], [(1, 1, "n")], 2) == [(1, "a", "n"), (2, "a", None)]
    late = step([(3, 3, "b"), (None, 3, "lost key")], [(2, 3, "late")], 4)
    assert late == sorted([(1, "a", "n"), (2, "a", "late"), (3, "b", None), (None, "lost key", None)], key=repr)
    assert step([(1, 5, "A")], [], 6)[0] == (1, "A", "n")


def test_dimension_closes_versions_and_keeps_its_seed(spark, lake):
    people = TableSpec("srv-a", "db", "hr", "people", ("EmployeeID", "LoadDate"), "LoadDate")

    def step(day, *rows):
        lake.land(people, employees(spark, *rows), utc(day))
        lake.bronze(people)
        lake.silver([people])
        lake.dimension("dim_employee", people, EMPLOYEE_DIM, employee_versions, employee_seed(spark))
        lake.commit()
        dim = tables.read_snapshot(spark, lake.path("gold", "dim_employee"))
        assert dim.schema == employee_schema()
        found = dim.select("EmployeeID", "JobTitle", F.dayofmonth("EffectiveEndDate")).orderBy("EmployeeID", "EffectiveStartDate")
        return [tuple(r) for r in found.collect()]

    assert step(2, (5, 1, {"JobTitle": "Agent"})) == [(-1, "null", 31), (5, "Agent", 31)]
    assert step(8, (5, 7, {"JobTitle": "Lead"}), (6, 7, {})) == [
        (-1, "null", 31), (5, "Agent", 6), (5, "Lead", 31), (6, None, 31),
    ]


def test_failed_silver_load_is_logged(spark, lake, monkeypatch):
    lake.land(A, pull(spark, (1, 1, "a")), utc(1))
    lake.bronze(A)
    monkeypatch.setattr(tables, "upsert_partitions", lambda *args, **kwargs: (_ for _ in ()).throw(RuntimeError("full disk")))
    with pytest.raises(RuntimeError, match="full disk"):
        lake.silver([A])
    log = runlog.read_log(spark, lake.log_path).where("medallion_layer = 'silver'")
    assert [r.notebook_execution_status for r in log.collect()] == [runlog.FAILED]
    assert lake.state(staged=True).isEmpty()


def test_run_log(spark, lake):
    run(lake, {A: pull(spark, (1, 1, "a"), (2, 2, "b"))}, 3)
    log = runlog.read_log(spark, lake.log_path).orderBy("start_datetime_utc")
    assert log.schema == runlog.RUN_LOG_SCHEMA
    rows = log.select("medallion_layer", "source_server", "records_inserted", F.unix_date(F.to_date("last_record_inserted_datetime")))
    day = (utc(2) - datetime(1970, 1, 1, tzinfo=timezone.utc)).days
    assert [tuple(r) for r in rows.collect()][:3] == [
        ("landing", "srv-a", 2, day), ("bronze", "srv-a", 2, day), ("silver", None, 2, day),
    ]
    assert log.where("notebook_execution_status = 'success'").count() == 1  # the seed row


def test_write_metrics_come_from_the_write(spark):
    metrics = runlog.WriteMetrics("at")
    metrics.attach(pull(spark, (1, 1, "a"), (2, 4, "b"))).write.format("noop").mode("overwrite").save()
    assert metrics.rows == 2 and metrics.last is not None


@pytest.mark.parametrize("condition", ["false", "k > 99", "k IN (SELECT k FROM nothing)"])
def test_write_metrics_of_an_empty_result(spark, condition):
    """Also where the optimizer or AQE finds out that nothing is left."""
    pull(spark, (7, 1, "x")).where("k < 0").createOrReplaceTempView("nothing")
    metrics = runlog.WriteMetrics("at")
    metrics.attach(pull(spark, (1, 1, "a")).where(condition)).write.format("noop").mode("overwrite").save()
    assert (metrics.rows, metrics.last) == (0, None)


def test_stream_takes_up_only_new_batches(spark):
    root = scratch_path(spark, "stream")
    seen = []

    def once():
        query = stream_to_bronze(spark, A, f"{root}/in", pull(spark).schema, f"{root}/out", f"{root}/cp", utc(9))
        query.awaitTermination()
        seen.append(sum(p["numInputRows"] for p in query.recentProgress))

    landing.land(pull(spark, (1, 1, "a"), (2, 1, "a")), f"{root}/in", "b1")
    once()
    landing.land(pull(spark, (2, 2, "b")), f"{root}/in", "b2")
    once()
    once()
    assert seen == [2, 1, 0]
    out = tables.read_partitioned(spark, f"{root}/out")
    assert content(out) == [("srv-a", 1, "a"), ("srv-a", 2, "b")]
    folders = [name for name in paths.subfolders(spark, f"{root}/out") if name != "_keys"]
    assert folders == ["__PartitionDateUTC=2024-01-01", "__PartitionDateUTC=2024-01-02"]


def test_a_commit_moves_only_the_named_tables(spark, lake):
    other = TableSpec("srv-a", "db", "dbo", "staff", ("k",), "at")
    for spec in (A, other):
        lake.land(spec, pull(spark, (1, 2, "x")), utc(3))
        lake.bronze(spec)
        lake.silver([spec])
    lake.commit(["calls"])
    assert lake.at_watermark(A).last_loaded == utc(2)
    assert lake.at_watermark(other).last_loaded == S.NEVER_LOADED and lake.gather([other]).count() == 1
    lake.commit(["staff"])
    assert lake.at_watermark(other).last_loaded == utc(2)


def test_an_unreadable_server_is_left_out_and_logged(spark, lake, monkeypatch):
    for spec in (A, B):
        lake.land(spec, pull(spark, (1, 1, spec.host)), utc(2))
        lake.bronze(spec)
    read = Medallion.read_bronze
    with monkeypatch.context() as patch:
        patch.setattr(Medallion, "read_bronze", lambda self, spec: 1 / 0 if spec is A else read(self, spec))
        loads = lake.silver([A, B])
        with pytest.raises(ZeroDivisionError):
            lake.silver([A, B], OnError.ABORT)
    assert [x.status for x in loads] == [runlog.FAILED, runlog.SUCCESS]
    assert content(lake.read_silver(B)) == [("srv-b", 1, "srv-b")]
    log = runlog.read_log(spark, lake.log_path).where("medallion_layer = 'silver'")
    assert sorted(r.notebook_execution_status for r in log.collect()) == [runlog.FAILED, runlog.FAILED, runlog.SUCCESS]
    lake.commit()
    assert len(lake.silver([A, B])) == 2 and lake.read_silver(A).count() == 2


def test_a_server_that_brings_text_does_not_stop_silver(spark, lake):
    lake.land(A, spark.createDataFrame([(1, utc(1), 5)], "k int, at timestamp, v int"), utc(2))
    lake.bronze(A)
    lake.silver([A])
    lake.commit()
    lake.land(B, pull(spark, (1, 3, "five")), utc(4))
    lake.bronze(B)
    lake.silver([A, B])
    assert content(lake.read_silver(A)) == [("srv-a", 1, "5"), ("srv-b", 1, "five")]


def test_purge_keeps_what_is_pending_and_the_newest(spark, lake):
    for day in (1, 2, 3):
        lake.land(A, pull(spark, (day, day, "a")), utc(day))
        if day < 3:
            lake.bronze(A)
    assert len(lake.purge([A])) == 1 and len(lake.pending([A][0])) == 1
    assert len(landing.landed_batches(spark, lake.path("landing", A))) == 2


def test_a_batch_that_comes_late_does_not_replace_newer_rows(spark):
    root = scratch_path(spark, "late")

    def once():
        stream_to_bronze(spark, A, f"{root}/in", pull(spark).schema, f"{root}/out", f"{root}/cp", utc(9)).awaitTermination()

    landing.land(pull(spark, (1, 5, "new"), (2, 1, "a")), f"{root}/in", "b2")
    once()
    landing.land(pull(spark, (1, 3, "old"), (2, 4, "b"), (3, 1, "c")), f"{root}/in", "b1")
    once()
    assert content(tables.read_partitioned(spark, f"{root}/out")) == [("srv-a", 1, "new"), ("srv-a", 2, "b"), ("srv-a", 3, "c")]


NOTES = TableSpec("srv-a", "db", "dbo", "notes", ("k",), "at")
CALLS = FactSpec(keys=("k",), base={"k": "k", "v": "v", "at": "at", S.PARTITION_DATE: S.PARTITION_DATE, "server": S.SOURCE_SERVER},
                 attributes={"note": "v"})


def gold_calls(lake, windowed=False):
    lake.fact("calls", A, NOTES, CALLS, ["k"], S.PARTITION_DATE, windowed=windowed)
    lake.commit()
    return sorted(r.k for r in tables.read_partitioned(lake.spark, lake.path("gold", "calls")).collect())


def silver_of(lake, specs, pulls, day):
    for spec, df in pulls.items():
        lake.land(spec, df, utc(day))
    lake.bronze_all(specs)
    return lake.silver(specs)


def test_dimension_from_carried_state(spark, lake, monkeypatch):
    """Equal to the dimension derived anew; a crash between dimension and state is noticed and both are built again."""
    people = TableSpec("srv-a", "db", "dbo", "employees", ("EmployeeID", "LoadDate"), "LoadDate")
    batches = [[(5, 1, {}), (6, 1, {})], [(5, 3, {"UserName": None, "JobTitle": "Lead"}), (6, 2, {"TerminationDate": datetime(2024, 1, 2)})],
               [(5, 6, {"JobTitle": "Head"})], [(6, 7, {"JobTitle": "Back"}), (7, 7, {})]]

    def load(number, name, **options):
        lake.dimension(name, people, EMPLOYEE_DIM, employee_versions, employee_seed(spark), **options)

    for number, batch in enumerate(batches):
        silver_of(lake, [people], {people: employees(spark, *batch)}, 10 + number)
        load(number, "plain")
        if number == 2:
            with monkeypatch.context() as m:
                m.setattr(lake, "_keep_carried", lambda *args: (_ for _ in ()).throw(RuntimeError("crash")))
                with pytest.raises(RuntimeError, match="crash"):
                    load(number, "carried", layout=employee_layout)
            assert lake._carried(lake.path("gold", "carried")) is None
        load(number, "carried", layout=employee_layout)
        lake.commit()
        found = [tables.read_snapshot(spark, lake.path("gold", n)) for n in ("plain", "carried")]
        assert sorted(map(repr, found[0].collect())) == sorted(map(repr, found[1].collect()))


@pytest.mark.parametrize("windowed", [False, True])
def test_a_server_that_joins_late_brings_its_older_rows(spark, lake, windowed):
    silver_of(lake, [NOTES], {NOTES: pull(spark, (1, 20, "n"))}, 20)
    silver_of(lake, [A, B], {A: pull(spark, *[(k, 20, "a") for k in range(5)])}, 20)
    assert gold_calls(lake) == list(range(5))
    silver_of(lake, [A, B], {B: pull(spark, *[(k, 10, "b") for k in range(5, 15)])}, 21)
    assert lake.frontier("calls") == {("srv-a", "db"): utc(20), ("srv-b", "db"): None}
    assert gold_calls(lake, windowed) == list(range(15))
    assert lake.frontier("calls") == {("srv-a", "db"): utc(20), ("srv-b", "db"): utc(10)}


def test_a_server_left_out_at_first_is_not_left_behind(spark, lake, monkeypatch):
    silver_of(lake, [NOTES], {NOTES: pull(spark, (1, 20, "n"))}, 20)
    fresh = lake._fresh
    with monkeypatch.context() as m:
        m.setattr(lake, "_fresh", lambda spec: fresh(spec) if spec.host == "srv-a" else (_ for _ in ()).throw(OSError("gone")))
        silver_of(lake, [A, B], {A: pull(spark, (1, 20, "a")), B: pull(spark, (2, 5, "b"))}, 20)
    assert gold_calls(lake) == [1]
    lake.silver([A, B], OnError.ISOLATE)
    assert gold_calls(lake) == [1, 2]


def test_dimension_of_a_server_that_joins_late(spark, lake):
    people = [TableSpec(h, "db", "dbo", "employees", ("EmployeeID", "LoadDate"), "LoadDate") for h in ("srv-a", "srv-b")]
    for spec, rows in zip(people, [((5, 20, {}), (5, 22, {"JobTitle": "Lead"})), ((6, 3, {}), (6, 4, {"JobTitle": "Lead"}))]):
        silver_of(lake, people, {spec: employees(spark, *rows)}, 25)
        lake.dimension("dim_employee", people[0], EMPLOYEE_DIM, employee_versions, employee_seed(spark))
        lake.commit()
    found = tables.read_snapshot(spark, lake.path("gold", "dim_employee")).where("EmployeeID in (5, 6)")
    assert sorted(r.EmployeeID for r in found.collect()) == [5, 5, 6, 6]


def test_frontier_prunes_partitions_until_a_source_is_new(spark, tmp_path):
    from tests.plans import plan
    from tidemark.operators.watermarks import filter_frontier

    rows = [(h, "db", utc(d).replace(tzinfo=None), utc(d).date()) for h in ("a", "b") for d in (1, 10, 20)]
    ddl = f"`{S.SOURCE_SERVER}` string, `{S.SOURCE_DATABASE}` string, at timestamp_ntz, `{S.PARTITION_DATE}` date"
    spark.createDataFrame(rows, ddl).write.partitionBy(S.PARTITION_DATE).parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))

    def found(frontier, **more):
        out = filter_frontier(df, "at", frontier, S.PARTITION_DATE, **more)
        return sorted((r[S.SOURCE_SERVER], r["at"].day) for r in out.collect()), plan(out, "formatted")

    both, text = found({("a", "db"): utc(10), ("b", "db"): utc(1)})
    assert both == [("a", 20), ("b", 10), ("b", 20)]
    assert f"PartitionFilters: [((({S.PARTITION_DATE}" in text or f"PartitionFilters: [(({S.PARTITION_DATE}" in text
    assert found({("a", "db"): utc(10), ("b", "db"): None})[0] == [("a", 20), ("b", 1), ("b", 10), ("b", 20)]
    assert found({("a", "db"): utc(20)}, lookback_days=10)[0] == [("a", 10), ("a", 20)]
    assert len(found({})[0]) == 6


def test_pending_batches_of_drifting_types_reach_bronze(spark, lake):
    lake.land(A, spark.createDataFrame([(1, utc(1), 5)], "k int, at timestamp, x int"), utc(1))
    lake.land(A, spark.createDataFrame([(2, utc(2), "five")], "k int, at timestamp, x string"), utc(2))
    done = lake.bronze(A)
    assert (done.rows, done.last) == (2, utc(2))
    assert sorted((r.k, r.x) for r in lake.read_bronze(A).collect()) == [(1, "5"), (2, "five")]
    lake.land(A, spark.createDataFrame([(1, utc(3), 6)], "k int, at timestamp, x int"), utc(3))
    done = lake.bronze(A)
    assert (done.rows, done.last) == (1, utc(3))
    assert sorted((r.k, r.x) for r in lake.read_bronze(A).collect()) == [(1, "6"), (2, "five")]


def test_stream_takes_rows_without_a_watermark(spark):
    root = scratch_path(spark, "stream")
    for day, at, v in ((1, utc(1), "old"), (2, None, "new")):
        df = spark.createDataFrame([(1, at, v)], DDL)
        landing.land(df, f"{root}/in", landing.batch_name("calls", utc(day)))
        stream_to_bronze(spark, A, f"{root}/in", df.schema, f"{root}/out", f"{root}/cp", utc(9)).awaitTermination()
    assert [r.v for r in tables.read_partitioned(spark, f"{root}/out").collect()] == ["new"]


def test_slow_sources_overlap_and_one_failure_leaves_the_others(spark, lake):
    import threading

    specs = [TableSpec(f"srv-{n}", "db", "dbo", "calls", ("k",), "at") for n in range(3)]
    together = threading.Barrier(2, timeout=60)

    def read(spec):
        if spec.host == "srv-2":
            raise OSError("gone")
        together.wait()  # passes only while both sources are being read
        return pull(spark, (int(spec.host[-1]), 1, spec.host))

    loads = lake.land_all(specs, read)
    assert [(x.spec.host, x.rows, x.status) for x in loads] == [
        ("srv-0", 1, "Success"), ("srv-1", 1, "Success"), ("srv-2", 0, "Failed"),
    ]
    lake.bronze_all(specs)
    assert {n: len(x) for n, x in lake.silver_all(specs).items()} == {"calls": 3}
    assert content(lake.read_silver(specs[0])) == [("srv-0", 0, "srv-0"), ("srv-1", 1, "srv-1")]
    logged = runlog.read_log(spark, lake.log_path).where("source_table = 'calls'").groupBy("medallion_layer").count()
    assert dict(map(tuple, logged.collect())) == {"landing": 3, "bronze": 2, "silver": 1}


def test_abort_begins_nothing_new_and_raises(spark, lake):
    lake.parallel = 1
    seen = []

    def read(spec):
        seen.append(spec.host)
        raise OSError(spec.host)

    with pytest.raises(OSError, match="srv-a"):
        lake.land_all([A, B], read, OnError.ABORT)
    assert seen == ["srv-a"]


def test_gold_opens_only_partitions_that_were_rewritten(spark, lake):
    """A new server has no watermark to prune by; the journal of rewritten partitions does."""
    silver_of(lake, [NOTES], {NOTES: pull(spark, (1, 20, "n"))}, 20)
    silver_of(lake, [A, B], {A: pull(spark, *[(k, 10 + k, "a") for k in range(5)])}, 20)
    assert lake.rewritten("calls") is None  # a new table: all
    assert gold_calls(lake) == list(range(5))
    assert lake.rewritten("calls") == []
    silver_of(lake, [A, B], {B: pull(spark, (7, 2, "b")), A: pull(spark, (3, 25, "moved"))}, 26)
    assert lake.rewritten("calls") == ["2024-01-02", "2024-01-13", "2024-01-25"]
    files = lake._recent(lake.read_silver(A), A)
    assert sorted(r.k for r in files.collect()) == [3, 7]
    from tests.plans import plan

    scan = next(line for line in plan(files, "formatted").splitlines() if "PartitionFilters" in line)
    assert "2024-01-02" in scan or "IN (" in scan
    assert gold_calls(lake) == [0, 1, 2, 3, 4, 7]
    assert lake.rewritten("calls") == []
