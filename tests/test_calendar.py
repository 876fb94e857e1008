"""Known calendar facts, and where the stored calendar's rules differ from the documented ones."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.plans import plan
from tidemark.plans import calendar, clock


@pytest.fixture(scope="module")
def days(spark):
    return calendar.date_dim(spark).checkpoint()


def test_size_and_range(days):
    assert days.agg(F.count("*"), F.min("DateFull"), F.max("DateFull")).head() == (
        11_323,
        date(2020, 1, 1),
        date(2050, 12, 31),
    )
    assert len(days.columns) == 34


def test_one_dst_start_and_end_per_year(days):
    per_year = days.groupBy("Year").agg(F.sum("IsDSTStartDate").alias("a"), F.sum("IsDSTEndDate").alias("b"))
    assert per_year.where("a <> 1 OR b <> 1").count() == 0


def holidays(days, year):
    rows = days.where((F.col("Year") == year) & (F.col("USFederalHoliday") != "")).orderBy("DateFull").collect()
    return {(r.DateFull.month, r.DateFull.day): r.USFederalHoliday for r in rows}


def test_holidays_2024(days):
    assert holidays(days, 2024) == {
        (1, 1): "New Year Day", (1, 15): "MLK Day", (2, 19): "President Day", (5, 27): "Memorial Day",
        (6, 19): "Juneteenth National Independence Day", (7, 4): "Independence Day", (9, 2): "labor Day",
        (10, 14): "Columbus Day", (11, 11): "Veterans Day", (11, 28): "Thanksgiving Day",
        (11, 29): "Day after Thanksgiving Day", (12, 25): "Christmas Day",
    }


def test_weekend_holidays_move(days):
    found = holidays(days, 2021)
    assert found[(7, 5)] == "Independence Day" and (7, 4) not in found
    assert found[(12, 24)] == "Christmas Day" and (12, 25) not in found
    assert found[(12, 31)] == "New Year Day"
    assert found[(6, 18)] == "Juneteenth National Independence Day"


@pytest.mark.parametrize("year", [2024, 2030, 2041, 2047])
def test_day_after_thanksgiving(spark, days, year):
    stored = calendar.date_dim(spark, reference_compatible=True)
    assert (11, 29) in holidays(days, year) and (11, 22) not in holidays(days, year)
    assert (11, 22) in holidays(stored, year) and (11, 29) not in holidays(stored, year)


def test_offsets_switch_on_both_transition_days(days):
    rows = {r.DateFull: r for r in days.where("Year = 2024").collect()}
    assert [rows[date(2024, m, d)].EasternOffSet for m, d in [(3, 9), (3, 10), (11, 3), (11, 4)]] == [-5, -4, -4, -5]
    summer, winter = rows[date(2024, 7, 1)], rows[date(2024, 1, 1)]
    zones = [f"{z}OffSet" for z in calendar.OFFSET_ORDER]
    assert [summer[z] for z in zones] == [-4, -5, -6, -7, -7, -8, -10]
    assert [winter[z] for z in zones] == [-5, -6, -7, -7, -8, -9, -10]


def test_week_conventions(days):
    row = days.where("DateKey = '20240107'").head()  # a Sunday
    assert (row.DayOfWeek, row.DayName, row.Week) == (1, "Sunday", 1)
    assert (row.StartOfWeek, row.EndOfWeek) == (date(2024, 1, 1), date(2024, 1, 7))


def test_workdays(days):
    flags = {r.DateKey: r.IsCompanyWorkday for r in days.where("Year = 2024").collect()}
    assert (flags["20240704"], flags["20240706"], flags["20240115"]) == (0, 0, 1)


def test_placeholder_day(spark, days):
    row = calendar.unknown_day(spark).head()
    assert (row.DateKey, row.DateFull, row.IsLeapyear, row.USFederalHoliday) == ("19000101", date(1900, 1, 1), 1, "")
    assert (row.StartOfWeek, row.EndOfWeek, row.DayName) == (date(1899, 12, 31), date(1900, 1, 6), "Monday")
    assert (row.EndOfQuarter, row.EndOfMonth, row.YearMonth) == (date(1900, 3, 31), date(1900, 1, 31), "Jan 1900")
    assert days.where("Year = 1900").count() == 0
    kept = calendar.date_dim(spark, keep_unknown=True)
    assert kept.count() == 11_324 and kept.where("Year = 1900").head().EasternOffSet == -5


def test_transitions_agree_with_the_rule(spark, days):
    transitions = calendar.dst_transitions(days)
    assert transitions.count() == 31
    first, last = calendar.dst_bounds(F.col("Year"))
    assert transitions.where((first != F.col("dst_first")) | (last != F.col("dst_last"))).count() == 0


def test_leap_years(spark):
    df = spark.createDataFrame([(1900,), (2000,), (2024,), (2023,)], "y int")
    got = df.select(calendar.leap_year(F.col("y")), calendar.leap_year(F.col("y"), reference_compatible=True)).collect()
    assert [tuple(r) for r in got] == [(False, True), (True, True), (True, True), (False, False)]


def test_dimension_joins_are_broadcast(spark):
    facts = spark.range(10).select(F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("day"))
    joined = calendar.with_calendar(facts, "day", calendar.date_dim(spark), ["Week", "CentralOffSet"])
    assert joined.columns == ["day", "Week", "CentralOffSet"]
    assert joined.where("Week IS NULL").count() == 0
    text = plan(joined)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_clock(spark):
    seconds = clock.time_dim(spark)
    assert seconds.count() == 86_400 and len(seconds.columns) == 30
    noon, late = seconds.where("TimeKey IN (120000, 234559)").orderBy("TimeKey").collect()
    assert (noon.Hour12, noon.AmPmString, noon.Hour12FullString) == (0, "PM", "00:00:00")
    assert (late.HalfHour, late.HalfHourCode, late.HalfHourFullString12) == (1, 2330, "11:30:00")
    assert (late.QuarterHour, late.QuarterHourShortString, late.FullTimeString24) == (3, "2345", "23:45:59")
    text = plan(seconds)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
