import datetime as dt

from tests_support import cube
from tidegrid import cli


def test_commands(spark, tmp_path, capsys):
    days = [dt.date(2021, 1, 30) + dt.timedelta(days=i) for i in range(4)]
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    cube(spark, days).write.parquet(source)
    assert cli.main(["add", store, source]) == 0
    assert cli.main(["coverage", store]) == 0
    out = capsys.readouterr().out
    assert "created" in out and "2021-01-30_2021-02-02 10W-0E-30N-40N" in out and "sst" in out
    assert cli.main(["aggregate", store, "--by", "month", "--variables", "sst", "--bbox", "-10", "30", "-5", "35"]) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert lines[0] == "time_agg,sst" and len(lines) == 3
    assert cli.main(["scan", store, "--columns", "sst", "--start-date", "2021-02-01", "--end-date", "2021-02-01"]) == 0
    assert len(capsys.readouterr().out.strip().splitlines()) == 10
    assert cli.main(["csv", store, str(tmp_path / "csv"), "--freq", "day"]) == 0
    more = str(tmp_path / "more")
    cli.main(["add", more, source])
    extra = str(tmp_path / "x")
    cube(spark, [dt.date(2021, 2, 3)]).write.parquet(extra)
    cli.main(["add", more, extra])
    assert cli.main(["update", store, more]) == 0
    capsys.readouterr()
    cli.main(["coverage", store])
    assert "2021-02-03" in capsys.readouterr().out
