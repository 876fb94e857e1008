"""Hashing and time semantics that are easy to get wrong."""

import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.hashing import fingerprint, joined_id, source_key
from tidemark.functions.temporal import at_zone, instant, literal_like, timestamps_to_dates
from tidemark.session import scratch_path, shuffle_conf
from tidemark.spec import LoadType, TableSpec, parse_instant, specs_from_json


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def one(spark, ddl, row, *columns):
    return tuple(spark.createDataFrame([row], ddl).select(*columns).head())


def test_fingerprint_skips_nulls(spark):
    with_gap, without = (
        one(spark, "a string, b string, c string", row, fingerprint(["a", "b", "c"]))[0]
        for row in [("a", None, "b"), ("a", "b", None)]
    )
    assert with_gap == without == sha("a|b")


def test_fingerprint_of_only_nulls_is_not_null(spark):
    assert one(spark, "a string, b int", (None, None), fingerprint(["a", "b"])) == (sha(""),)


def test_source_key_appends_the_host_with_spaces(spark):
    got = one(spark, "a int, d date", (7, date(2024, 1, 2)), source_key(["a", "d"], "srv"))
    assert got == (sha("7 2024-01-02 srv"),)


def test_joined_id_is_ambiguous_and_null_propagating(spark):
    ids = [one(spark, "a string, b int", row, joined_id(["a", "b"]))[0] for row in [("1", 23), ("12", 3), ("1", None)]]
    assert ids == ["123", "123", None]


@pytest.mark.parametrize(
    ("utc", "central"),
    [
        (datetime(2024, 7, 1, 12), datetime(2024, 7, 1, 7)),
        (datetime(2024, 1, 1, 12), datetime(2024, 1, 1, 6)),
        (datetime(2024, 3, 10, 7, 59), datetime(2024, 3, 10, 1, 59)),
        (datetime(2024, 3, 10, 8), datetime(2024, 3, 10, 3)),
    ],
)
def test_central_time_observes_daylight_saving(spark, utc, central):
    got = spark.range(1).select(at_zone(instant(utc)).cast("string")).head()[0]
    assert got == central.isoformat(" ")


def test_instant_ignores_session_and_machine_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        micros = spark.range(1).select(F.unix_micros(instant(datetime(2030, 1, 2, 3, 4, 5)))).head()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert micros == 1_893_553_445_000_000


@pytest.mark.parametrize("dtype", ["timestamp", "timestamp_ntz", "date"])
def test_literals_take_the_columns_type(spark, dtype):
    df = spark.sql(f"SELECT CAST('2024-05-20' AS {dtype}) AS c")
    assert df.select(literal_like(df, "c", datetime(2024, 5, 20)).alias("c")).schema["c"].dataType == df.schema["c"].dataType
    assert df.where(F.col("c") == literal_like(df, "c", datetime(2024, 5, 20))).count() == 1


def test_timestamps_to_dates_leaves_other_types(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-05-20 23:59:59' a, TIMESTAMP_NTZ '2024-05-20 01:00:00' b, 1 n, 'x' `odd name`")
    assert timestamps_to_dates(df).dtypes == [("a", "date"), ("b", "date"), ("n", "int"), ("odd name", "string")]


CONFIG = """{"Ledger": [{"host_name": "h", "database_name": "d", "schema_name": "dbo", "sql_table": "Ledger",
 "watermark_column": " ", "last_inserted_datetime": "2031-02-03T01:02:03.000Z", "load_type": "full", "host_secret": "x",
 "hash_key_column_list": ["EntryNo"]}],
 "Calls": [{"host_name": "h", "database_name": "d", "schema_name": "dbo", "sql_table": "Calls",
 "watermark_column": "Ended", "last_inserted_datetime": "2032-11-30T23:59:58.000Z", "load_type": "Incremental",
 "hash_key_column_list": ["Id", "Site"]}]}"""


def test_specs_from_json():
    full, incremental = specs_from_json(CONFIG)
    assert full.load_type is LoadType.FULL and full.watermark is None
    assert incremental.incremental and incremental.keys == ("Id", "Site")
    assert incremental.last_loaded == parse_instant("2032-11-30T23:59:58.000Z")
    assert incremental.qualified_table == "dbo.Calls" and incremental.relative_path == "h/d/Calls"


def test_shuffle_partitions_follow_the_data():
    assert shuffle_conf(1 << 30)["spark.sql.shuffle.partitions"] == "200"
    assert shuffle_conf(1 << 40)["spark.sql.shuffle.partitions"] == "8192"
    assert shuffle_conf(100 << 40)["spark.sql.shuffle.partitions"] == "100000"


def test_scratch_folders_are_below_the_sessions_checkpoint_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(root) and second.startswith(root)


def test_spec_needs_keys_and_watermark():
    with pytest.raises(ValueError, match="key"):
        TableSpec("h", "d", "s", "t", ())
    with pytest.raises(ValueError, match="watermark"):
        TableSpec("h", "d", "s", "t", ("k",))
