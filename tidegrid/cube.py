"""One object for a store: writing, reading, coverage and the data of plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidegrid.model import BBox, DateRange
from tidegrid.plans import plots
from tidegrid.sources.store import CubeStore


class Cube:
    """Facade over a CubeStore. Summaries are cached by their arguments until data is added."""

    def __init__(self, spark: SparkSession, path: str, partitions: Sequence[str] = ("year", "month"), time_mode: str = "date"):
        self.store = CubeStore(spark, path, partitions, time_mode)
        self._cache: dict[tuple, DataFrame] = {}

    def __repr__(self) -> str:
        if not self.store.exists():
            return f"Cube({self.store.path!r}, empty)"
        return f"Cube({self.store.path!r}, {self.store.time_coverage().label()}, {self.store.geo_extent().label()}, {', '.join(self.store.variables())})"

    def add_data(self, df: DataFrame, fmt: str | None = None) -> str:
        for old in self._cache.values():
            old.unpersist()
        self._cache.clear()
        return self.store.add_data(df, fmt)

    def scan(self, dates=None, bbox: BBox | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        return self.store.scan(dates, bbox, columns)

    def load(self, dates=None, bbox: BBox | None = None, columns: Sequence[str] | None = None):
        """The rows as a pandas frame, for results that fit one."""
        return self.scan(dates, bbox, columns).toPandas()

    def time_coverage(self) -> DateRange:
        return self.store.time_coverage()

    def geo_extent(self) -> BBox:
        return self.store.geo_extent()

    def _once(self, key: tuple, make) -> DataFrame:
        if key not in self._cache:
            self._cache[key] = make().cache()
        return self._cache[key]

    def time_series(self, variables: Sequence[str], where: tuple | None = None, agg_by: str = "month", dates=None) -> DataFrame:
        return self._once(("series", tuple(variables), where, agg_by, str(dates)), lambda: plots.time_series(self.scan(dates, columns=variables), variables, where, agg_by))

    def stats_summary(self, variable: str, agg_by: str = "month", dates=None) -> DataFrame:
        return self._once(("stats", variable, agg_by, str(dates)), lambda: plots.stats_summary(self.scan(dates, columns=[variable]), variable, agg_by))

    def spatial_maps(self, variable: str, agg_by: str = "month", dates=None) -> DataFrame:
        return self._once(("maps", variable, agg_by, str(dates)), lambda: plots.spatial_maps(self.scan(dates, columns=[variable]), variable, agg_by))
