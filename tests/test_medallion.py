"""End-to-end job: re-runs, venue subsets, short windows, days left by earlier
runs, empty results; warehouse build matches the layers of ``Lakehouse``."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from barlake.plans.lakehouse import Lakehouse
from barlake.plans.medallion import MedallionConfig, build_warehouse, run_medallion
from barlake.sinks import layers, tables

from conftest import SF_SMALL

RAW = ("symbol string, exchange string, time string, open string, high string, low string, close string, volume string, "
       "ingest_seq bigint")


def test_medallion_idempotent_and_strict(spark, tmp_lake):
    lh = Lakehouse(spark, SF_SMALL)
    cfg = MedallionConfig(lake_root=tmp_lake, start_date="2016-01-01", end_date="2020-12-31",
                          run_date=dt.date(2026, 1, 1), strict=False, price_decimals=2,
                          bronze_format="json")
    ts = dt.datetime(2026, 1, 1)
    s1 = run_medallion(spark, lh.raw, cfg, batch_ts=ts)
    assert s1["status"] == "ok" and s1["bronze_rows"] == 2631
    assert s1["silver_rows"] == 2612 and s1["gold_rows"] == 2609
    assert any(v["rule"] == "pk_duplicate" for v in s1["silver_violations"])
    s2 = run_medallion(spark, lh.raw, cfg, batch_ts=ts)
    assert s2["gold_rows"] == s1["gold_rows"]
    gold_t = tables.read_layer(spark, cfg.path("gold")).drop(layers.VENUE)
    assert s1["rejected"]["invalid_date"] > 0 and s1["unreadable_days"] == ["not-a-date"]
    assert s1["landed_rows"] == 6000 == s1["bronze_rows"] + sum(s1["rejected"].values())
    assert s1["silver_dropped"] == 19 and s1["duplicates_removed"] == 3 and s1["gold_null_dropped"] == 0
    written = {(r.trading_date.isoformat(), r.venue) for r in
               tables.read_layer(spark, cfg.path("gold")).select("trading_date", layers.VENUE).distinct().collect()}
    assert set(s1["gold_keys"]) == written
    assert gold_t.count() == 2609
    assert gold_t.exceptAll(lh.gold.select(*gold_t.columns)).count() == 0
    for layer in ("bronze", "silver", "gold"):
        assert tables.read_layer(spark, cfg.path(layer) + "_run_manifest").count() == 2
    with pytest.raises(ValueError, match="pk_duplicate"):
        run_medallion(spark, lh.raw, MedallionConfig(
            lake_root=tmp_lake + "2", start_date="2016-01-01", end_date="2020-12-31", strict=True),
            batch_ts=ts)

    wh = build_warehouse(spark, gold_t, tmp_lake + "/warehouse", price_decimals=2)
    assert wh["fact"].count() == 2156 and wh["monthly"].count() == 2056
    assert wh["yearly"].exceptAll(lh.yearly).count() == 0
    first = wh["volume_by_exchange_year"].first()
    assert (first.year, first.exchange, first.total_volume) == (2020, "HNX", 7054)


def _bars(spark, days, symbol="AAA", venue="HOSE", first=10.0):
    return spark.createDataFrame(
        [(symbol, venue, d, "1", "1", "1", str(first + i), "5", i) for i, d in enumerate(days)], RAW)


def _config(root, start, end, **more):
    return MedallionConfig(lake_root=root, start_date=start, end_date=end, **more)


def _gold(spark, root):
    return sorted(map(tuple, tables.read_layer(spark, root + "/gold").drop(layers.VENUE)
                      .select("symbol", "exchange", "trading_date", "close_price", "daily_return", "ma_5", "ma_20").collect()))


def test_venues_are_kept_apart(spark, tmp_lake):
    both = _bars(spark, ["2025-01-02", "2025-01-03"]).union(_bars(spark, ["2025-01-02", "2025-01-03"], "BBB", "HNX"))
    for venue in ("HOSE", "HNX"):
        run_medallion(spark, both, _config(tmp_lake, "2025-01-01", "2025-01-31", exchanges=[venue]))
    assert {r[1] for r in _gold(spark, tmp_lake)} == {"HOSE", "HNX"} and len(_gold(spark, tmp_lake)) == 4


def test_short_window_equals_full_rebuild(spark, tmp_lake):
    days = [(dt.date(2025, 1, 1) + dt.timedelta(days=i)).isoformat() for i in range(31)]
    raw = _bars(spark, days)
    run_medallion(spark, raw, _config(tmp_lake, "2025-01-01", "2025-01-31"))
    full = _gold(spark, tmp_lake)
    run_medallion(spark, raw, _config(tmp_lake, "2025-01-25", "2025-01-25"))
    assert _gold(spark, tmp_lake) == full and len(full) == 31


def test_days_of_earlier_runs_stay_out(spark, tmp_lake):
    run_medallion(spark, _bars(spark, ["2025-01-01", "2025-01-02", "2025-01-03"]), _config(tmp_lake, "2025-01-01", "2025-01-31"))
    stats = run_medallion(spark, _bars(spark, ["2025-01-01", "2025-01-03"]), _config(tmp_lake, "2025-01-01", "2025-01-31"))
    assert stats["bronze_rows"] == stats["silver_rows"] == stats["gold_rows"] == 2


def test_empty_results(spark, tmp_lake):
    nothing = run_medallion(spark, _bars(spark, []), _config(tmp_lake, "2025-01-01", "2025-01-31"))
    assert nothing["status"] == "no_rows" and nothing["landed_rows"] == 0
    late = run_medallion(spark, _bars(spark, ["2026-01-01"]), _config(tmp_lake, "2025-01-01", "2025-01-31"))
    assert late["status"] == "no_rows" and late["rejected"]["outside_window"] == 1
    bad = _bars(spark, ["2025-01-02"]).withColumn("close", F.lit("n/a"))
    stats = run_medallion(spark, bad, _config(tmp_lake, "2025-01-01", "2025-01-31", strict=False))
    assert stats["status"] == "no_gold" and stats["silver_rows"] == 0 and stats["silver_dropped"] == 1


def test_many_day_layouts_reach_gold(spark, tmp_lake):
    raw = _bars(spark, ["2025-01-02", "2025/01/03", "20250104", "2025-01-05T09:15:00Z", "2025-01-06 09:15:00+07:00", "01/07/2025"])
    stats = run_medallion(spark, raw, _config(tmp_lake, "2025-01-01", "2025-01-31"))
    assert stats["gold_rows"] == 6 and sorted(r[2].day for r in _gold(spark, tmp_lake)) == [2, 3, 4, 5, 6, 7]
