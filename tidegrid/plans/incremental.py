"""Incremental work: which days to process next, by whole chunks, with late and lagging columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.model import DateRange, TimeResolution, to_day
from tidegrid.operators.join import fillable_days
from tidegrid.sources.store import CubeStore

LOOK_BACK_DAYS = 400
DAY = dt.timedelta(days=1)


def next_range(stored: DateRange | None, start=None, end=None, today: dt.date | None = None) -> DateRange | None:
    """What to process: what is asked for, else from the day after the store's last to today; None if up to date."""
    if start is None and stored is None:
        raise ValueError("an empty store needs a start")
    a = to_day(start) if start is not None else stored.end + DAY
    b = to_day(end) if end is not None else today or dt.date.today()
    if a > b:
        if start is not None:
            raise ValueError(f"{a} is after {b}")
        return None
    return DateRange(a, b)


def gap(stored_end: dt.date | None, source: DateRange) -> DateRange | None:
    a = source.start if stored_end is None else max(source.start, stored_end + DAY)
    return DateRange(a, source.end) if a <= source.end else None


def compile_range(ends: Mapping[str, dt.date | None], sources: Mapping[str, DateRange]) -> DateRange | None:
    """The envelope of every variable's gap between its last compiled day and its source's last."""
    gaps = [g for v, s in sources.items() if (g := gap(ends.get(v), s))]
    return DateRange(min(g.start for g in gaps), max(g.end for g in gaps)) if gaps else None


def backfill_window(store: CubeStore, source: DataFrame, column: str, look_back: int = LOOK_BACK_DAYS) -> DateRange | None:
    """Days inside the store where a column lags or has holes that its source can fill."""
    stored, offered = store.time_coverage(), DateRange.of(source.filter(F.col(column).isNotNull()).withColumn("time", F.to_date("time")))
    last = min(offered.end, stored.end)
    floor = last - dt.timedelta(days=look_back)
    end = store.var_coverage_end([column]).get(column)
    starts = [] if end is None or end >= last else [end + DAY]
    if end is None:
        starts.append(max(stored.start, offered.start))
    start = store.backfill_start([column], {column: floor}).get(column)
    if start is not None:
        span = DateRange(min(start, last), last)
        mine = store.scan(span, columns=[column])
        hole = fillable_days(source.filter(span.predicate()), mine, column).agg(F.min("day")).first()[0]
        if hole:
            starts.append(hole)
    return DateRange(min(starts), last) if starts and min(starts) <= last else None


def grouped_windows(windows: Mapping[str, DateRange | None]) -> dict[DateRange, list[str]]:
    """Columns by identical window, in order."""
    out: dict[DateRange, list[str]] = {}
    for column, w in windows.items():
        if w is not None:
            out.setdefault(w, []).append(column)
    return out


def update(store: CubeStore, source: DataFrame, start=None, end=None, by: TimeResolution = TimeResolution.MONTH, variables: Sequence[str] | None = None, on_error: Callable[[DateRange, Exception], None] | None = None) -> bool:
    """Bring a store up to its source: new days first, then lagging columns inside the stored days.

    variables: add or redo only these columns over the whole span. False if a chunk failed.
    """
    offered = DateRange.of(source.withColumn("time", F.to_date("time")))
    good = True

    def write(window: DateRange, columns: Iterable[str]) -> bool:
        ok = True
        for part in window.split(by):
            try:
                rows = source.filter(part.predicate()).select("time", "lat", "lon", *columns)
                if not rows.isEmpty():
                    store.add_data(rows)
            except Exception as x:  # the others go on
                ok = False
                if on_error is None:
                    raise
                on_error(part, x)
        return ok

    every = [c for c in source.columns if c not in ("time", "lat", "lon", "year", "month", "day")]
    if variables is not None:
        window = offered if start is None and end is None else next_range(offered, start or offered.start, end or offered.end)
        return write(window, variables)
    if not store.exists():
        return write(next_range(offered, start or offered.start, end or offered.end), every)
    if start is not None or end is not None:
        return write(next_range(store.time_coverage(), start, end or offered.end), every)
    held = store.time_coverage()
    if new := gap(held.end, offered):
        good = write(new, every)
    for window, columns in grouped_windows({c: backfill_window(store, source, c) for c in every if c in store.variables()}).items():
        good = write(window, columns) and good
    return good
