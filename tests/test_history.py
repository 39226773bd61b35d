"""Vintages as changes: every day equals its whole copy, storage grows with changes."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from pulsepanel.operators.totals import covered_shares
from pulsepanel.sources import history

KEYS = ["region", "date"]
SCHEMA = "region string, date date, new_cases double, note string"


def versions(days=6, seed=1):
    r = random.Random(seed)
    start = datetime.date(2021, 1, 1)
    table = {(k, start + datetime.timedelta(i)): (float(i), None) for k in "AB" for i in range(5)}
    out = {}
    for n in range(days):
        for key in r.sample(sorted(table), 2):
            table[key] = (r.choice([None, 1.0, 2.0]), r.choice([None, "x"]))
        if n % 2:
            table.pop(r.choice(sorted(table)), None)
        table[(r.choice("ABC"), start + datetime.timedelta(r.randrange(8)))] = (9.0, "new")
        if n != 3:  # nothing changes on the fourth day
            out[str(start + datetime.timedelta(20 * n))] = dict(table)
        else:
            out[str(start + datetime.timedelta(20 * n))] = dict(list(out.values())[-1])
            table = dict(list(out.values())[-1])
    return out


def frame(spark, table):
    return spark.createDataFrame([(*k, *v) for k, v in table.items()], SCHEMA)


def rows(df):
    assert df.columns == ["region", "date", "new_cases", "note"]
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def recorded(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("history") / "changes")
    tables = versions()
    for day, table in tables.items():
        history.record_snapshot(frame(spark, table), path, day, KEYS)
    return path, tables


def test_every_day_equals_its_whole_copy(spark, recorded, tmp_path):
    path, tables = recorded
    changes = history.read_changes(spark, path)
    history.write_intervals(history.validity_intervals(changes, KEYS), str(tmp_path / "i"))
    intervals = spark.read.parquet(str(tmp_path / "i"))
    days = list(tables)
    for i, day in enumerate(days):
        want = sorted(((*k, *v) for k, v in tables[day].items()), key=str)
        later = str(datetime.date.fromisoformat(day) + datetime.timedelta(7))
        for asked in (day, later):
            assert rows(history.as_of_changes(changes, asked, KEYS)) == want
            assert rows(history.intervals_as_of(intervals, asked)) == want
            assert rows(history.intervals_as_of(history.validity_intervals(changes, KEYS), asked)) == want
    assert rows(history.intervals_as_of(intervals, "2020-12-31")) == []


def test_only_changes_are_stored(spark, recorded):
    path, tables = recorded
    stored = {str(r.snapshot_date): r["count"] for r in history.read_changes(spark, path).groupBy("snapshot_date").count().collect()}
    before = {}
    for day, table in tables.items():
        changed = sum(1 for k in {*table, *before} if table.get(k) != before.get(k))
        assert stored.get(day, 0) == changed
        before = table
    assert 0 < sum(stored.values()) < sum(map(len, tables.values())) / 2


def test_recording_the_newest_day_again(spark, tmp_path):
    path = str(tmp_path / "c")
    tables = list(versions(3).values())
    history.record_snapshot(frame(spark, tables[0]), path, "2021-01-01", KEYS)
    for table in (tables[1], tables[0], tables[2]):
        history.record_snapshot(frame(spark, table), path, "2021-01-02", KEYS)
        want = sorted(((*k, *v) for k, v in table.items()), key=str)
        assert rows(history.as_of_changes(history.read_changes(spark, path), "2021-01-02", KEYS)) == want
    with pytest.raises(ValueError):
        history.record_snapshot(frame(spark, tables[0]), path, "2021-01-01", KEYS)


def test_intervals_of_ended_months_are_not_read(spark, recorded, tmp_path):
    path, _ = recorded
    history.write_intervals(history.validity_intervals(history.read_changes(spark, path), KEYS), str(tmp_path / "i"))
    df = history.intervals_as_of(spark.read.parquet(str(tmp_path / "i")), "2021-03-20")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(end_month" in plan and "2021-03" in plan


def days(n):
    return [(datetime.date(2020, 11, 1) + datetime.timedelta(i)).isoformat() for i in range(n)]


def shares(panel, counts, window=3):
    table = [(r, d, None if v is None else float(v)) for r, values in counts.items() for d, v in zip(days(20), values)]
    return {r.region: r.share for r in covered_shares(panel(table, ["new_tests"]), days=window).collect()}


def test_shares_over_days_that_all_regions_report(panel):
    n = None
    counts = {"A": [1, 1, 1, 5, 5, n, 7, 7, n], "B": [3, 3, 3, 5, n, 9, 9, 9, n], "all": [4, 4, 4, 10, 12, 12, 16, 16, 16]}
    # days 1 to 4 are the last three and more in a row; the gaps of day 5 and 6 come later
    assert shares(panel, counts) == {"A": 7 / 18, "B": 11 / 18, "all": 1.0}
    assert shares(panel, counts, window=2) == {"A": 14 / 32, "B": 18 / 32, "all": 1.0}
    assert shares(panel, counts, window=5) == {}


def test_shares_of_the_known_panel(panel):
    n = None
    counts = {
        "RegionA": [10, 10, 10, 10, 10, 20, 20, 20, n, n, n, n, n, n],
        "RegionB": [10, 10, 10, 10, 30, 20, 20, 30, 30, 30, n, 12, n, n],
        "RegionC": [40, 40, 40, 10, 30, 20, 0, 17, 40, n, 20, n, n, n],
        "all": [60 * 1.3, 78, 78, 39, 91, 78, 52, 87.1, 91, 39, 26, 15.6, n, n],
    }
    got = shares(panel, counts, window=7)
    assert got["RegionA"] == pytest.approx(100 / (387 * 1.3)) and got["RegionC"] == pytest.approx(157 / (387 * 1.3))
