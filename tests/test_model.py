import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegrid.config import KeyConfig, normalized, parse
from tidegrid.functions import physics as ph
from tidegrid.model import BBox, DateRange, TimeResolution, file_label
from tidegrid.plans.incremental import compile_range, gap, grouped_windows, next_range
from tidegrid.sources.connectors import Connector, Connectors, last_published_month, plan
from tidegrid.sources.files import date_patterns

D = dt.date


def test_ranges_are_closed_days_in_order():
    r = DateRange("2020-01-05T13:00:00", "2020-01-05")
    assert r.days() == 1 and r.start == D(2020, 1, 5)
    with pytest.raises(ValueError):
        DateRange("2020-01-02", "2020-01-01")
    a, b = DateRange("2020-01-01", "2020-01-10"), DateRange("2020-01-10", "2020-02-01")
    assert a.intersection(b) == DateRange("2020-01-10", "2020-01-10")
    assert a.envelope(b) == DateRange("2020-01-01", "2020-02-01")
    assert DateRange("2020-01-15", "2020-03-02").split(TimeResolution.MONTH) == [DateRange("2020-01-15", "2020-01-31"), DateRange("2020-02-01", "2020-02-29"), DateRange("2020-03-01", "2020-03-02")]


def test_boxes():
    with pytest.raises(ValueError):
        BBox(1, 0, 1, 2)
    b = BBox(-10, 30, 20, 40)
    assert b.label() == "10W-20E-30N-40N" and b.contains(BBox(-10, 30, 0, 35)) and b.overlaps(BBox(20, 40, 30, 50))
    assert file_label("cmems", "sst", b, DateRange("2020-01-01", "2020-01-02")) == "cmems_sst_10W-20E-30N-40N_2020-01-01_2020-01-02"


def test_configuration_is_checked():
    with pytest.raises(ValueError):
        KeyConfig(bbox=(-200, 0, 0, 10))
    with pytest.raises(ValueError):
        KeyConfig(range_mode=True, date_pattern=r"(\d{8})")
    c = parse({"keys": {"sst": {"compiled": ["sst", "sst_std"]}, "moon": {}}, "odd": 1})
    assert c.column_groups() == {"sst": "sst", "sst_std": "sst"} and c.downloadable() == ["sst"]
    assert normalized(None, c.keys) == {"sst": None} and normalized({"sst": "a"}, c.keys) == {"sst": ["a"]}
    with pytest.raises(ValueError):
        normalized("nope", c.keys)
    with pytest.raises(TypeError):
        normalized(3, c.keys)


def test_reprocessed_data_comes_first():
    r = DateRange("2020-01-01", "2020-12-31")
    tasks = plan(r, ("rep", DateRange("2019-01-01", "2020-06-30")), ("nrt", DateRange("2020-01-01", "2020-11-30")))
    assert [(t.dataset_type, t.dates) for t in tasks] == [("rep", DateRange("2020-01-01", "2020-06-30")), ("nrt", DateRange("2020-07-01", "2020-11-30"))]
    tasks = plan(r, ("rep", DateRange("2010-01-01", "2010-06-30")), ("nrt", DateRange("2019-01-01", "2021-01-01")))
    assert [t.dataset_type for t in tasks] == ["nrt"] and tasks[0].dates == r


def test_a_connector_retries_and_asks_once_for_availability():
    class Fake(Connector):
        asked = 0
        failed = False

        def _available(self, dataset_id):
            Fake.asked += 1
            return DateRange("2020-01-01", "2020-12-31")

        def fetch(self, task, target):
            if not self.failed:
                self.failed = True
                raise OSError("once")
            return [f"{target}/{task.dates.label()}"]

    known = Connectors()
    known.register("fake", Fake)
    c = known.make("fake")
    assert c.run(DateRange("2020-02-01", "2020-02-01"), "r", None, "t") == ["t/2020-02-01"]
    c.run(DateRange("2020-02-01", "2020-02-01"), "r", None, "t")
    assert Fake.asked == 1
    with pytest.raises(ValueError):
        known.make("none")


def test_archive_months_and_patterns():
    assert last_published_month(D(2024, 3, 9)) == D(2024, 1, 31) and last_published_month(D(2024, 3, 10)) == D(2024, 2, 29)
    assert date_patterns(DateRange("2019-12-30", "2021-01-31")) == ["*/2019/12/*2019123[0-1]*", "*/2020/*", "*/2021/01/*"]
    assert date_patterns(DateRange("2020-02-09", "2020-02-11")) == ["*/2020/02/*2020020" + "9*", "*/2020/02/*2020021[0-1]*"]


def test_planning_of_increments():
    held = DateRange("2020-01-01", "2020-01-31")
    assert next_range(held, today=D(2020, 2, 3)) == DateRange("2020-02-01", "2020-02-03")
    assert next_range(held, today=D(2020, 1, 31)) is None
    with pytest.raises(ValueError):
        next_range(None)
    with pytest.raises(ValueError):
        next_range(held, "2020-02-02", "2020-02-01")
    assert gap(D(2020, 1, 31), DateRange("2019-01-01", "2020-01-31")) is None
    sources = {"a": DateRange("2020-01-01", "2020-03-01"), "b": DateRange("2020-01-01", "2020-02-10"), "c": DateRange("2020-01-01", "2020-01-05")}
    assert compile_range({"a": D(2020, 2, 20), "b": D(2020, 2, 1), "c": D(2020, 1, 5)}, sources) == DateRange("2020-02-02", "2020-03-01")
    w = DateRange("2020-01-01", "2020-01-02")
    assert grouped_windows({"a": w, "b": None, "c": w}) == {w: ["a", "c"]}


def test_the_moon_of_published_dates(spark):
    """New and full moons and quarters of almanacs, within a day's motion."""
    new = ["2000-01-06", "2017-08-21", "2024-04-08", "1999-08-11"]  # the last three are solar eclipses
    full = ["2000-01-21", "2018-07-27", "2024-03-25", "1996-09-27"]  # lunar eclipses
    quarter = ["2024-04-15", "2024-05-01"]
    days = [(D(*map(int, x.split("-"))), k) for k, xs in (("new", new), ("full", full), ("quarter", quarter)) for x in xs]
    got = spark.createDataFrame(days, "day date, kind string").select("kind", ph.moon_illumination(F.col("day")).alias("lit")).collect()
    for r in got:
        assert {"new": r["lit"] < 3, "full": r["lit"] > 97, "quarter": 38 < r["lit"] < 62}[r["kind"]], r
