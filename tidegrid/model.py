"""Value objects: date ranges, boxes, time resolutions, and their predicates and labels."""

from __future__ import annotations

import datetime as dt
import enum
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class TimeResolution(enum.Enum):
    MONTH = "month"
    YEAR = "year"


def to_day(value: str | dt.date | dt.datetime) -> dt.date:
    """Midnight of any date-like value; text is ISO 8601."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.datetime.fromisoformat(str(value)).date()


@dataclass(frozen=True)
class DateRange:
    """A closed range of days."""

    start: dt.date
    end: dt.date

    def __post_init__(self) -> None:
        object.__setattr__(self, "start", to_day(self.start))
        object.__setattr__(self, "end", to_day(self.end))
        if self.start > self.end:
            raise ValueError(f"range ends ({self.end}) before it starts ({self.start})")

    def overlaps(self, other: DateRange) -> bool:
        return self.start <= other.end and other.start <= self.end

    def contains(self, other: DateRange) -> bool:
        return self.start <= other.start and other.end <= self.end

    def intersection(self, other: DateRange) -> DateRange | None:
        return DateRange(max(self.start, other.start), min(self.end, other.end)) if self.overlaps(other) else None

    def envelope(self, other: DateRange) -> DateRange:
        return DateRange(min(self.start, other.start), max(self.end, other.end))

    def days(self) -> int:
        return (self.end - self.start).days + 1

    def over_a_year(self) -> bool:
        return self.days() > 366

    def split(self, by: TimeResolution) -> list[DateRange]:
        """Calendar months or years, clipped to this range."""
        out, first = [], self.start
        while first <= self.end:
            following = dt.date(first.year + 1, 1, 1) if by is TimeResolution.YEAR else (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
            out.append(DateRange(first, min(self.end, following - dt.timedelta(days=1))))
            first = following
        return out

    def label(self) -> str:
        return f"{self.start:%Y-%m-%d}" if self.start == self.end else f"{self.start:%Y-%m-%d}_{self.end:%Y-%m-%d}"

    def predicate(self, time: str = "time") -> Column:
        return F.to_date(time).between(F.lit(self.start), F.lit(self.end))

    @classmethod
    def of(cls, df: DataFrame, time: str = "time") -> DateRange:
        low, high = df.agg(F.min(time), F.max(time)).first()
        if low is None:
            raise ValueError(f"no {time} to take a range from")
        return cls(low, high)


@dataclass(frozen=True)
class BBox:
    """A closed box in degrees."""

    xmin: float
    ymin: float
    xmax: float
    ymax: float

    def __post_init__(self) -> None:
        if not (self.xmin < self.xmax and self.ymin < self.ymax):
            raise ValueError(f"empty box: {self}")

    def contains(self, other: BBox) -> bool:
        return self.xmin <= other.xmin and self.ymin <= other.ymin and other.xmax <= self.xmax and other.ymax <= self.ymax

    def overlaps(self, other: BBox) -> bool:
        return self.xmin <= other.xmax and other.xmin <= self.xmax and self.ymin <= other.ymax and other.ymin <= self.ymax

    def padded(self, dx: float, dy: float | None = None) -> BBox:
        """Wider by a cell on every side, so that interpolation at the edge has its neighbours."""
        dy = dx if dy is None else dy
        return BBox(self.xmin - dx, self.ymin - dy, self.xmax + dx, self.ymax + dy)

    def label(self) -> str:
        def one(x: float, positive: str, negative: str) -> str:
            return f"{round(abs(x))}{positive if x >= 0 else negative}"

        return "-".join((one(self.xmin, "E", "W"), one(self.xmax, "E", "W"), one(self.ymin, "N", "S"), one(self.ymax, "N", "S")))

    def predicate(self, lon: str = "lon", lat: str = "lat") -> Column:
        return (F.col(lon) >= self.xmin) & (F.col(lon) <= self.xmax) & (F.col(lat) >= self.ymin) & (F.col(lat) <= self.ymax)

    @classmethod
    def of(cls, df: DataFrame, lon: str = "lon", lat: str = "lat") -> BBox:
        x0, x1, y0, y1 = df.agg(F.min(lon), F.max(lon), F.min(lat), F.max(lat)).first()
        if x0 is None:
            raise ValueError("no coordinates to take a box from")
        return cls(float(x0), float(y0), float(x1), float(y1))


def file_label(source: str, key: str, bbox: BBox | None, dates: DateRange | None) -> str:
    return "_".join(x for x in (source, key, bbox.label() if bbox else "", dates.label() if dates else "") if x)


def with_attributes(df: DataFrame, attributes: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Attributes by column, as column metadata, over what the columns have."""
    return reduce(lambda d, c: d.withMetadata(c, {**d.schema[c].metadata, **attributes[c]}), [c for c in df.columns if c in attributes], df)


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "table") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns: {', '.join(missing)}")
