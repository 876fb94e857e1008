"""Clock dimension: one row per second of the day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400


def _two(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def _clock(*parts: Column | str) -> Column:
    return F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else _two(p) for p in parts])


def _bucket(name: str, width: int, hour: Column, half: Column, minute: Column) -> dict[str, Column]:
    """Columns of the minute bucket of ``width`` minutes that contains the row."""
    index = F.floor(minute / width).cast("int")
    start = index * width
    code = hour * 100 + start
    return {
        name: index,
        f"{name}Code": code,
        f"{name}ShortString": F.lpad(code.cast("string"), 4, "0"),
        f"{name}FullString24": _clock(hour, start, "00"),
        f"{name}FullString12": _clock(half, start, "00"),
    }


def clock_attributes(second_of_day: Column) -> dict[str, Column]:
    """All columns of one clock row, in stored order.  ``Hour12`` runs from 0 to 11: noon and midnight are 0."""
    s = second_of_day.cast("int")
    hour = F.floor(s / 3600).cast("int")
    minute = F.floor(s / 60).cast("int") % 60
    second = s % 60
    half = hour % 12
    morning = hour < 12
    return {
        "TimeKey": hour * 10000 + minute * 100 + second,
        "Hour24": hour,
        "Hour24ShortString": _two(hour),
        "Hour24MinString": _clock(hour, "00"),
        "Hour24FullString": _clock(hour, "00", "00"),
        "Hour12": half,
        "Hour12ShortString": _two(half),
        "Hour12MinString": _clock(half, "00"),
        "Hour12FullString": _clock(half, "00", "00"),
        "AmPmCode": F.when(morning, 0).otherwise(1),
        "AmPmString": F.when(morning, "AM").otherwise("PM"),
        "Minute": minute,
        "MinuteCode": hour * 100 + minute,
        "MinuteShortString": _two(minute),
        "MinuteFullString24": _clock(hour, minute, "00"),
        "MinuteFullString12": _clock(half, minute, "00"),
        **_bucket("HalfHour", 30, hour, half, minute),
        **_bucket("QuarterHour", 15, hour, half, minute),
        "Second": second,
        "SecondShortString": _two(second),
        "FullTimeString24": _clock(hour, minute, second),
        "FullTimeString12": _clock(half, minute, second),
    }


def time_dim(spark: SparkSession) -> DataFrame:
    """86,400 rows from a range and arithmetic; no hours x minutes x seconds product is needed."""
    seconds = spark.range(SECONDS_PER_DAY)
    return seconds.select(*[c.alias(n) for n, c in clock_attributes(F.col("id")).items()])


def time_key(stamp: str | Column) -> Column:
    """Key of a timestamp into the dimension."""
    c = F.col(stamp) if isinstance(stamp, str) else stamp
    return F.hour(c) * 10000 + F.minute(c) * 100 + F.second(c)
