"""Snapshot tables: file groups, replaced and appended keys, pinned readers, failed and
lost writers, compaction, spans of days."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from barlake.operators import tails as tail_ops
from barlake.plans.medallion import MedallionConfig, run_medallion
from barlake.sinks import layers, tables
from barlake.sinks.snapshots import KEEP_VERSIONS, SnapshotTable
from test_medallion import _bars, _config

D = dt.date


def _rows(spark, days, tag, venue="HOSE"):
    return spark.createDataFrame([(d, venue, tag) for d in days], "trading_date date, venue string, tag string")


def _all(table, *span):
    return sorted((r.trading_date, r.venue, r.tag) for r in table.read(*span).collect())


def _groups(path):
    return sorted(x for x in os.listdir(f"{path}/data") if x.startswith("_group"))


def _table(spark, path):
    return SnapshotTable(spark, path, "trading_date", ("venue",))


def test_keys_are_replaced_by_one_new_group(spark, tmp_lake):
    t = _table(spark, tmp_lake)
    assert t.read() is None
    days = [D(2025, 1, d) for d in range(1, 29)] + [D(2025, 2, 1)]
    t.publish(t.stage(_rows(spark, days, "a")))
    t.publish(t.stage(_rows(spark, days, "h", "HNX")))
    files = [f for _, _, names in os.walk(f"{tmp_lake}/data") for f in names if f.endswith(".parquet")]
    assert len(files) < len(days)  # files follow months, not days
    t.publish(t.stage(_rows(spark, [D(2025, 1, 2)], "b")))
    got = _all(t)
    assert len(got) == 2 * len(days) and (D(2025, 1, 2), "HOSE", "b") in got
    assert (D(2025, 1, 2), "HOSE", "a") not in got and (D(2025, 1, 2), "HNX", "h") in got
    t.publish(t.stage(_rows(spark, [D(2025, 1, 2)], "c")), "append")
    assert len(_all(t)) == len(got) + 1
    t.publish(t.stage(_rows(spark, [D(2025, 3, 1)], "z")), "overwrite")
    assert _all(t) == [(D(2025, 3, 1), "HOSE", "z")]


def test_null_venue_is_a_key(spark, tmp_lake):
    t = _table(spark, tmp_lake)
    for tag in "ab":
        t.publish(t.stage(_rows(spark, [D(2025, 1, 1)], tag, None)))
        t.publish(t.stage(_rows(spark, [D(2025, 1, 1), D(2025, 1, 2)], tag)))
    got = t.read("2025-01-01", "2025-01-01").collect()
    assert {(r.venue, r.tag) for r in got} == {("HOSE", "b"), (None, "b")} and len(got) == 2


def test_span_names_its_months_only(spark, tmp_lake):
    t = _table(spark, tmp_lake)
    t.publish(t.stage(_rows(spark, [D(2025, m, 1) for m in range(1, 13)], "a")))
    found = t.read("2025-03-01", "2025-04-30")
    assert {f.split("_month=")[1][:7] for f in found.inputFiles()} == {"2025-03", "2025-04"} and found.count() == 2
    assert t.read("2030-01-01").count() == 0
    assert "PushedFilters: [IsNotNull(trading_date)" in found._jdf.queryExecution().executedPlan().toString()


def test_readers_keep_their_version(spark, tmp_lake):
    t = _table(spark, tmp_lake)
    t.publish(t.stage(_rows(spark, [D(2025, 1, 1)], "a")))
    pinned = t.read()
    t.publish(t.stage(_rows(spark, [D(2025, 1, 1)], "b")))
    assert [r.tag for r in pinned.collect()] == ["a"] and [r[2] for r in _all(t)] == ["b"]
    for tag in "cdef":
        t.publish(t.stage(_rows(spark, [D(2025, 1, 1)], tag)))
    assert len(_groups(tmp_lake)) == KEEP_VERSIONS == len(t.versions())


def test_failed_write_leaves_no_trace(spark, tmp_lake):
    t = _table(spark, tmp_lake)
    t.publish(t.stage(_rows(spark, [D(2025, 1, 1)], "a")))
    bad = _rows(spark, [D(2025, 1, 1)], "b").withColumn("tag", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        t.stage(bad)
    assert [r[2] for r in _all(t)] == ["a"] and len(_groups(tmp_lake)) == 1


def test_incomplete_manifest_is_not_the_state(spark, tmp_lake):
    t = _table(spark, tmp_lake)
    t.publish(t.stage(_rows(spark, [D(2025, 1, 1)], "a")))
    t.files.create("_snapshots/0000000002.json", '{"version": 2, "gro')
    assert t.current().version == 1 and [r[2] for r in _all(t)] == ["a"]
    assert t.publish(t.stage(_rows(spark, [D(2025, 1, 1)], "b"))) == 3
    with pytest.raises(Exception):  # a second writer of the same version
        t.files.create("_snapshots/0000000003.json", "{}")


def test_compaction_keeps_rows(spark, tmp_lake):
    t = _table(spark, tmp_lake)
    for i in range(4):
        t.publish(t.stage(_rows(spark, [D(2025, 1, 1 + i), D(2025, 1, 2 + i)], str(i))))
    before = _all(t)
    t.compact()
    assert _all(t) == before and len(t.current().groups) == 1 and not next(iter(t.current().groups.values()))["dead"]


def test_rebuild_switches_when_complete(spark, tmp_lake):
    old = tables.materialize(spark.range(3), tmp_lake)
    with pytest.raises(Exception, match="lost"):
        tables.materialize(spark.range(5).withColumn("id", F.raise_error(F.lit("lost")).cast("bigint")), tmp_lake)
    assert tables.read_layer(spark, tmp_lake).count() == 3
    new = tables.materialize(old.unionByName(spark.range(10, 12)), tmp_lake)  # reads what it replaces
    assert old.count() == 3 and new.count() == 5 == tables.read_layer(spark, tmp_lake).count()


def _tail_table(spark, root):
    t = SnapshotTable(spark, root + "/gold", "trading_date", (layers.VENUE,))
    return tail_ops.Tails(t)


def _every(start, count, step):
    return [(start + dt.timedelta(days=step * i)).isoformat() for i in range(count)]


def _history(spark, root, day):
    got = _tail_table(spark, root).history(day)
    return sorted(tuple(r) for r in got.select("symbol", "trading_date", "close_price", "volume").collect())


def _expected(spark, root, day):
    from barlake.operators.gold import look_back
    return sorted(tuple(r) for r in look_back(tables.read_layer(spark, root + "/gold"), day.isoformat())
                  .select("symbol", "trading_date", "close_price", "volume").collect())


def test_tails_equal_a_look_back_over_all_gold(spark, tmp_lake):
    dense = _bars(spark, _every(D(2023, 1, 2), 500, 1), "AAA")
    sparse = _bars(spark, _every(D(2023, 1, 5), 30, 25), "BBB", "HNX")
    gone = _bars(spark, _every(D(2023, 2, 1), 4, 1), "CCC", "HNX")
    raw = dense.union(sparse).union(gone)
    probes = [D(2023, 1, 1), D(2023, 2, 20), D(2023, 7, 1), D(2024, 2, 11), D(2024, 9, 9), D(2026, 1, 1)]

    def check():
        for day in probes:
            assert _history(spark, tmp_lake, day) == _expected(spark, tmp_lake, day), day
    for start, end in [("2023-01-01", "2023-05-31"), ("2023-06-01", "2023-12-31"), ("2024-03-01", "2024-12-31")]:
        run_medallion(spark, raw, _config(tmp_lake, start, end))
    check()  # with a hole at the start of 2024
    later = raw.withColumn("close", (F.col("close").cast("double") + 0.5).cast("string"))
    run_medallion(spark, later, _config(tmp_lake, "2024-01-01", "2024-02-29"))
    run_medallion(spark, later, _config(tmp_lake, "2023-03-20", "2023-04-10", exchanges=["HNX"]))
    check()
    t = _tail_table(spark, tmp_lake)
    assert t.boundaries(t.gold.current().version) != []
    # gold of other periods isn't read
    months = {f.split("_month=")[1][:7] for f in t.history(D(2024, 8, 20)).inputFiles() if "/gold/" in f}
    assert months <= {"2024-07", "2024-08"}


def test_runs_equal_one_rebuild(spark, tmp_lake):
    raw = _bars(spark, _every(D(2024, 1, 1), 200, 1)).union(_bars(spark, _every(D(2024, 1, 3), 12, 17), "BBB", "HNX"))
    run_medallion(spark, raw, _config(tmp_lake + "/one", "2024-01-01", "2024-12-31"))
    for start, end in [("2024-01-01", "2024-03-15"), ("2024-03-16", "2024-03-16"), ("2024-03-17", "2024-12-31")]:
        run_medallion(spark, raw, _config(tmp_lake + "/many", start, end))
    one, many = (tables.read_layer(spark, f"{tmp_lake}/{x}/gold") for x in ("one", "many"))
    assert one.exceptAll(many).count() == 0 and one.count() == many.count() == 212


def test_lost_tails_are_made_anew(spark, tmp_lake):
    raw = _bars(spark, _every(D(2024, 1, 1), 120, 1))
    run_medallion(spark, raw, _config(tmp_lake, "2024-01-01", "2024-03-31"))
    t = _tail_table(spark, tmp_lake)
    t.gold.publish(t.gold.stage(t.gold.read("2024-03-31", "2024-03-31")))  # a run that never reached its tails
    assert t.boundaries(t.gold.current().version) == []
    assert _history(spark, tmp_lake, D(2024, 4, 2)) == _expected(spark, tmp_lake, D(2024, 4, 2))
    run_medallion(spark, raw, _config(tmp_lake, "2024-04-01", "2024-04-29"))
    assert t.boundaries(t.gold.current().version) == [D(2024, 4, 1), D(2024, 7, 1)]


def test_refused_rows_leave_the_layer_as_it_was(spark, tmp_lake):
    raw = _bars(spark, ["2025-01-02", "2025-01-03"])
    run_medallion(spark, raw, _config(tmp_lake, "2025-01-01", "2025-01-31"))
    twice = raw.union(_bars(spark, ["2025-01-02"], first=99.0))
    with pytest.raises(ValueError, match="pk_duplicate"):
        run_medallion(spark, twice, _config(tmp_lake, "2025-01-01", "2025-01-31"))
    for layer in ("silver", "gold"):
        assert tables.read_layer(spark, f"{tmp_lake}/{layer}").count() == 2
        assert len(_groups(f"{tmp_lake}/{layer}")) == 1
    assert not os.path.exists(f"{tmp_lake}/_staging")


def test_json_bronze_reads_back(spark, tmp_lake):
    stats = run_medallion(spark, _bars(spark, ["2025-01-02", "2025-02-03"]),
                          MedallionConfig(lake_root=tmp_lake, start_date="2025-01-01", end_date="2025-12-31", bronze_format="json"))
    row = tables.read_layer(spark, tmp_lake + "/bronze").orderBy("data_date").first()
    assert stats["gold_rows"] == 2 and row.data_date == D(2025, 1, 2) and row.trading_date == "2025-01-02"


def test_stored_view_outlives_the_session(spark, tmp_lake):
    raw = _bars(spark, ["2025-01-02", "2025-01-03"]).union(_bars(spark, ["2025-01-02"], "BBB", "HNX"))
    run_medallion(spark, raw, _config(tmp_lake, "2025-01-01", "2025-01-31"))
    from barlake.plans.medallion import GOLD_VIEW, build_warehouse
    wh = build_warehouse(spark, tmp_lake + "/gold", tmp_lake + "/wh", price_decimals=2)
    assert wh["fact"].count() == 3
    other = spark.newSession()
    assert not other.catalog.tableExists(GOLD_VIEW)
    run_medallion(spark, _bars(spark, ["2025-01-06"]), _config(tmp_lake, "2025-01-06", "2025-01-06"))
    assert tables.open_view(other, tmp_lake + "/wh", GOLD_VIEW).count() == 4  # of gold as it is now
    assert other.sql(f"SELECT count(*) FROM {GOLD_VIEW} WHERE exchange = 'HNX'").first()[0] == 1
    with pytest.raises(KeyError):
        tables.open_view(other, tmp_lake + "/wh", "nope")


def test_landing_is_scanned_once(spark, tmp_lake):
    """Counts, samples and the range come from the writes: one execution reads the landed files."""
    raw = _bars(spark, ["2025-01-02", "2025-01-03", "nope"])
    raw.write.parquet(tmp_lake + "/landed-once")
    stats = run_medallion(spark, tables.read_layer(spark, tmp_lake + "/landed-once"), _config(tmp_lake, "2025-01-01", "2025-01-31"))
    assert stats["unreadable_days"] == ["nope"] and stats["landed_rows"] == 3
    # listed at the end of each execution by Spark's own listener
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    ran = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [ran.apply(i).physicalPlanDescription() for i in range(ran.size())]
    assert sum("landed-once" in p and "Scan parquet" in p for p in plans) == 1
