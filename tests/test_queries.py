"""Every registered query of the engine against its SQL in DuckDB."""

import datetime as dt
import random

import duckdb
import pandas as pd
import pytest

from tidegrid import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in ("lineitem", "orders", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]
    rows = []
    for r in df.itertuples(index=False):
        rows.append(tuple(None if x is None or x is pd.NaT or x != x else round(float(x), 5) if isinstance(x, (int, float)) or hasattr(x, "dtype") else str(x).removesuffix(" 00:00:00") for x in r))
    return sorted(rows, key=str)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = registry.queries()[name](spark, SF).toPandas()
    want = duck.execute(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = plain(got), plain(want)
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert all(p == q or (isinstance(p, float) and isinstance(q, float) and abs(p - q) < 2e-5) for p, q in zip(x, y, strict=True)), (x, y)


def test_accumulated_rate_is_the_sql_s_to_the_last_digit(spark, duck, tmp_path):
    rng = random.Random(1)
    rows, n = [], 0
    for user in [*range(300), None]:
        at, value = dt.datetime(2024, 1, 1, 7), 0.0
        for _ in range(20):
            at += dt.timedelta(microseconds=rng.choice((1, 7, 10**6, 10**6, 999_983, 86_400 * 10**6 + 1, 2**26)))
            value = rng.choice((value, value + rng.randrange(5, 10**6, 10) / 1e10, value - rng.randrange(20) / 1e10, round(rng.uniform(0, 300), 2), float("nan"), None)) if value == value and value is not None else 0.0
            rows.append((n, at, user, "x", value, "{}"))
            n += 1
        rows += [(n, None, user, "x", 1.0, "{}"), (n + 1, at, user, "x", -1e12, "{}")]
        n += 2
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    for folder, files in ((SF, f"{SF}/events.parquet"), (str(tmp_path), f"{tmp_path}/events.parquet/*.parquet")):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW events AS SELECT * FROM '{files}'")
        want = con.execute(registry.oracle_sql()["accumulated_rate"]).fetchall()
        got = registry.queries()["accumulated_rate"](spark, folder).select("user_id", "time", "rate").collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want)) and len(want) > 900  # repr: a minus zero is another


def test_the_flagship_query_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
