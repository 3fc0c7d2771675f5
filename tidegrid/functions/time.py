"""Date functions on columns: buckets, seasons, lenient parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEASONS = ("spring", "summer", "autumn", "winter")


def season(time: Column) -> Column:
    """winter: December to February, and so on."""
    m = F.month(time)
    return F.when(m.isin(12, 1, 2), "winter").when(m.isin(3, 4, 5), "spring").when(m.isin(6, 7, 8), "summer").when(m.isNotNull(), "autumn")


def season_rank(name: Column) -> Column:
    """spring 1 ... winter 4."""
    out = F.when(name == SEASONS[0], 1)
    for i, s in enumerate(SEASONS[1:], 2):
        out = out.when(name == s, i)
    return out


def season_code(time: Column) -> Column:
    """YYYYS; December counts to the next year's winter, whose digit is 4."""
    year = F.year(time) + F.when(F.month(time) == 12, 1).otherwise(0)
    return (year * 10 + season_rank(season(time))).cast("int")


def season_code_date(code: Column) -> Column:
    """First day of the season's opening month in the coded year; winter is put at its December."""
    month = F.element_at(F.array(*map(F.lit, (3, 6, 9, 12))), (code % 10).cast("int"))
    return F.make_date((code / 10).cast("int"), month, F.lit(1))


def bucket(time: Column, by: str) -> Column:
    """day, week (Monday), month, year: a date; season: its code."""
    if by == "season":
        return season_code(time)
    if by == "day":
        return F.to_date(time)
    if by not in ("week", "month", "year"):
        raise ValueError(f"no such time bucket: {by}")
    return F.to_date(F.date_trunc(by, time))


def parse_time(column: Column, kind: str, mode: str = "date", fmt: str | None = None) -> Column:
    """A date (mode date) or zoneless timestamp (datetime) from any column; text that can't be read is null."""
    if mode not in ("date", "datetime"):
        raise ValueError(f"no such time mode: {mode}")
    if kind == "string":
        column = F.try_to_timestamp(column, F.lit(fmt)) if fmt else F.try_to_timestamp(column)
    return F.to_date(column) if mode == "date" else column.cast("timestamp_ntz")


def has_time_of_day(df: DataFrame, time: str) -> bool:
    """Whether a text column's times of day differ from row to row."""
    clock = F.regexp_extract(F.col(time), r"(\d{2}:\d{2}:\d{2})", 1)
    return df.select(clock.alias("c")).filter("c <> ''").distinct().limit(2).count() > 1


def step_time(time: Column, step_seconds: Column) -> Column:
    """Base time and forecast step as one timestamp."""
    return F.timestamp_seconds(F.unix_timestamp(time) + step_seconds)
