"""The registered incremental gold and its SQL cover the whole fixture window."""
import datetime as dt

import __spark_entry__ as entry
from barlake.plans.lakehouse import FIXTURE_WINDOW
from conftest import SF_SMALL


def test_runs_cover_the_window(spark, monkeypatch):
    runs = []
    monkeypatch.setattr(entry, "run_medallion", lambda _, raw, cfg: runs.append(cfg))
    monkeypatch.setattr(entry.tables, "read_layer", lambda s, path: s.createDataFrame(
        [], ", ".join(f"`{c}` string" for c in entry.gold_ops.GOLD_COLUMNS)))
    entry.queries()["gold_incremental"](spark, SF_SMALL)
    first, *later = runs
    assert (first.start_date, first.exchanges) == (FIXTURE_WINDOW[0], None)
    follows = (dt.date.fromisoformat(first.end_date) + dt.timedelta(1)).isoformat()
    assert [(r.start_date, r.end_date) for r in later] == [(follows, FIXTURE_WINDOW[1])] * 2
    assert {v for r in later for v in r.exchanges} == {"HOSE", "HNX"}


def test_oracle_keeps_the_window():
    sql = entry.oracle_sql()["gold_incremental"]
    assert all(day in sql for day in FIXTURE_WINDOW)
