"""Calendar dimension: one row per day with periods, US federal holidays, workdays and UTC offsets of US zones."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bounds of the stored calendar and the day that stands for "unknown".
FIRST_DAY = date(2020, 1, 1)
LAST_DAY = date(2050, 12, 31)
UNKNOWN_DAY = date(1900, 1, 1)

# Holiday labels as stored, spelling included.
NEW_YEAR = "New Year Day"
MLK = "MLK Day"
PRESIDENT = "President Day"
MEMORIAL = "Memorial Day"
JUNETEENTH = "Juneteenth National Independence Day"
INDEPENDENCE = "Independence Day"
LABOR = "labor Day"
COLUMBUS = "Columbus Day"
VETERANS = "Veterans Day"
THANKSGIVING = "Thanksgiving Day"
AFTER_THANKSGIVING = "Day after Thanksgiving Day"
CHRISTMAS = "Christmas Day"
COMPANY_HOLIDAYS = (NEW_YEAR, MEMORIAL, INDEPENDENCE, LABOR, THANKSGIVING, AFTER_THANKSGIVING, CHRISTMAS)

# Hours from UTC in standard time for zones that change their clocks, and for those that do not.
SHIFTING_ZONES = {"Eastern": -5, "Central": -6, "Mountain": -7, "Pacific": -8, "Alaska": -9}
FIXED_ZONES = {"Arizona": -7, "HawaiiAleutian": -10}
OFFSET_ORDER = ("Eastern", "Central", "Mountain", "Arizona", "Pacific", "Alaska", "HawaiiAleutian")

# dayofweek() numbers.
SUNDAY, MONDAY, THURSDAY, FRIDAY, SATURDAY = 1, 2, 5, 6, 7


def _is(flag: Column) -> Column:
    return F.when(flag, 1).otherwise(0)


class _Day:
    """Predicates on one date column."""

    def __init__(self, day: Column) -> None:
        self.day = day
        self.month = F.month(day)
        self.dom = F.day(day)
        self.dow = F.dayofweek(day)

    def in_span(self, month: int, dow: int, first: int, last: int) -> Column:
        return (self.month == month) & (self.dow == dow) & self.dom.between(first, last)

    def nth(self, month: int, dow: int, n: int) -> Column:
        """The n-th such weekday of the month."""
        return self.in_span(month, dow, 7 * n - 6, 7 * n)

    def observed(self, month: int, dom: int) -> Column:
        """A fixed holiday: the day itself on weekdays, else the adjacent Friday or Monday.

        Shifting the holiday rather than the row keeps the rule in one place, across month and year ends too.
        """
        eve, after = F.date_add(self.day, 1), F.date_sub(self.day, 1)

        def falls_on(d: Column) -> Column:
            return (F.month(d) == month) & (F.day(d) == dom)

        weekday = ~self.dow.isin(SUNDAY, SATURDAY)
        return (
            (falls_on(self.day) & weekday)
            | (falls_on(eve) & (self.dow == FRIDAY))
            | (falls_on(after) & (self.dow == MONDAY))
        )


def holiday(day: Column, reference_compatible: bool = False) -> Column:
    """Federal holiday label, empty on other days.

    The day after Thanksgiving falls on the 23rd to 29th.  Stored calendars tested the 22nd to 28th, which moves the
    label a week in years whose November starts on a Friday; ``reference_compatible`` reproduces that.
    """
    d = _Day(day)
    friday = (22, 28) if reference_compatible else (23, 29)
    rules = [
        (NEW_YEAR, d.observed(1, 1)),
        (MLK, d.nth(1, MONDAY, 3)),
        (PRESIDENT, d.nth(2, MONDAY, 3)),
        (MEMORIAL, d.in_span(5, MONDAY, 25, 31)),
        (JUNETEENTH, d.observed(6, 19)),
        (INDEPENDENCE, d.observed(7, 4)),
        (LABOR, d.nth(9, MONDAY, 1)),
        (COLUMBUS, d.nth(10, MONDAY, 2)),
        (VETERANS, d.observed(11, 11)),
        (THANKSGIVING, d.nth(11, THURSDAY, 4)),
        (AFTER_THANKSGIVING, d.in_span(11, FRIDAY, *friday)),
        (CHRISTMAS, d.observed(12, 25)),
    ]
    label = F.lit("")
    for name, rule in reversed(rules):
        label = F.when(rule, name).otherwise(label)
    return label


def leap_year(year: Column, reference_compatible: bool = False) -> Column:
    """Stored calendars only test divisibility by four."""
    every_four = year % 4 == 0
    return every_four if reference_compatible else every_four & ((year % 100 != 0) | (year % 400 == 0))


def period_bounds(day: Column) -> dict[str, Column]:
    """First and last day of the week (Monday-based), month, quarter and year around ``day``."""
    columns: dict[str, Column] = {}
    for unit in ("Week", "Year", "Quarter", "Month"):
        start = F.date_trunc(unit.lower(), day)
        following = F.timestamp_add(unit.upper(), F.lit(1), start)
        columns[f"StartOf{unit}"] = F.to_date(start)
        columns[f"EndOf{unit}"] = F.date_sub(F.to_date(following), 1)
    return columns


def day_attributes(day: Column, reference_compatible: bool = False) -> dict[str, Column]:
    """The base columns of one calendar row, in stored order."""
    d = _Day(day)
    year = F.year(day)
    p = period_bounds(day)
    return {
        "DateKey": F.replace(day.cast("string"), F.lit("-"), F.lit("")),
        "DateFull": day,
        "Year": year,
        "Month": d.month,
        "Day": d.dom,
        "DayOfWeek": d.dow,
        "DayName": F.date_format(day, "EEEE"),
        "MonthName": F.date_format(day, "MMMM"),
        "Week": F.weekofyear(day),
        "StartOfWeek": p["StartOfWeek"],
        "EndOfWeek": p["EndOfWeek"],
        "StartOfYear": p["StartOfYear"],
        "EndOfYear": p["EndOfYear"],
        "DayOfYear": F.dayofyear(day),
        "Quarter": F.quarter(day),
        "StartOfQuarter": p["StartOfQuarter"],
        "EndOfQuarter": p["EndOfQuarter"],
        "StartOfMonth": p["StartOfMonth"],
        "EndOfMonth": p["EndOfMonth"],
        "YearMonth": F.date_format(day, "MMM yyyy"),
        "YearMonthCode": F.date_format(day, "yyyyMM"),
        "IsWeekday": _is(~d.dow.isin(SUNDAY, SATURDAY)),
        "IsLeapyear": _is(leap_year(year, reference_compatible)),
        "IsDSTStartDate": _is(d.nth(3, SUNDAY, 2)),
        "IsDSTEndDate": _is(d.nth(11, SUNDAY, 1)),
        "USFederalHoliday": holiday(day, reference_compatible),
    }


def calendar_days(
    spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY, reference_compatible: bool = False
) -> DataFrame:
    """One row per day with the base columns."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day"))
    return days.select(*[c.alias(n) for n, c in day_attributes(F.col("day"), reference_compatible).items()])


def unknown_day(spark: SparkSession) -> DataFrame:
    """The placeholder row for facts without a date.

    Its stored values follow other rules than the calendar's: its week starts on Sunday, its year counts as a leap
    year and it is no holiday.
    """
    computed = calendar_days(spark, UNKNOWN_DAY, UNKNOWN_DAY)
    return computed.withColumns(
        {
            "StartOfWeek": F.date_sub("DateFull", 1),
            "EndOfWeek": F.date_add("DateFull", 5),
            "IsLeapyear": F.lit(1),
            "USFederalHoliday": F.lit(""),
        }
    )


def dst_bounds(year: Column) -> tuple[Column, Column]:
    """Second Sunday of March and first Sunday of November."""
    return F.next_day(F.make_date(year, F.lit(3), F.lit(7)), "Sun"), F.next_day(
        F.make_date(year, F.lit(10), F.lit(31)), "Sun"
    )


def utc_offsets(summer: Column) -> dict[str, Column]:
    """Hours from UTC per zone, in stored order."""
    hours = {zone: F.when(summer, base + 1).otherwise(base) for zone, base in SHIFTING_ZONES.items()}
    hours |= {zone: F.lit(base) for zone, base in FIXED_ZONES.items()}
    return {f"{zone}OffSet": hours[zone] for zone in OFFSET_ORDER}


def add_offsets(days: DataFrame, workday: str = "IsCompanyWorkday") -> DataFrame:
    """Workday flag and UTC offsets, daylight saving counted from its first to its last day inclusive.

    The transitions follow from the year, so no join is needed and unused offsets are pruned.
    """
    summer = F.col("DateFull").between(*dst_bounds(F.col("Year")))
    works = (F.col("IsWeekday") == 1) & ~F.col("USFederalHoliday").isin(*COMPANY_HOLIDAYS)
    return days.select("*", _is(works).alias(workday), *[c.alias(n) for n, c in utc_offsets(summer).items()])


def date_dim(
    spark: SparkSession,
    first: date = FIRST_DAY,
    last: date = LAST_DAY,
    workday: str = "IsCompanyWorkday",
    reference_compatible: bool = False,
    keep_unknown: bool = False,
) -> DataFrame:
    """The whole dimension.  Stored calendars lack the placeholder day; ``keep_unknown`` adds it."""
    days = calendar_days(spark, first, last, reference_compatible)
    return add_offsets(days.unionByName(unknown_day(spark)) if keep_unknown else days, workday)


def dst_transitions(days: DataFrame) -> DataFrame:
    """One row per year with both transition days, read off a calendar; years lacking one drop out."""

    def flagged(flag: str, name: str) -> DataFrame:
        return days.where(F.col(flag) == 1).select("Year", F.col("DateFull").alias(name)).distinct()

    return flagged("IsDSTStartDate", "dst_first").join(flagged("IsDSTEndDate", "dst_last"), "Year")


def with_offsets(df: DataFrame, day: str, transitions: DataFrame) -> DataFrame:
    """Attach UTC offsets to facts by a range test against their year's transitions.

    Facts without a day, or with one outside the calendar, stay and have null offsets.  ``transitions`` has one row per
    calendar year, so its broadcast does not grow with the facts.
    """
    joined = df.join(F.broadcast(transitions), F.year(df[day]) == transitions["Year"], "left")
    summer = df[day].between(F.col("dst_first"), F.col("dst_last"))
    known = F.col("dst_first").isNotNull()
    return joined.select(*df.columns, *[F.when(known, c).alias(n) for n, c in utc_offsets(summer).items()])


def with_calendar(df: DataFrame, day: str, calendar: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Attach calendar columns to facts by their date.

    The calendar has one row per day of a fixed range, so its broadcast does not grow with the facts.
    """
    wanted = columns or calendar.columns
    side = calendar.select(F.col("DateFull").alias("__day"), *[c for c in wanted])
    return df.join(F.broadcast(side), F.to_date(df[day]) == F.col("__day"), "left").drop("__day")
