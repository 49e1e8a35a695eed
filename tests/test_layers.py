"""Layer operators on hand rows (bronze window, silver rules, gold
features and keep-last, warehouse roll-ups, dense keys)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from barlake.functions.ranking import dense_rank_distinct
from barlake.operators import bi, bronze, gold, silver, warehouse

D = dt.date


def _raw(spark, rows):
    return spark.createDataFrame(rows, "symbol string, exchange string, time string, "
                                       "close string, volume string, ingest_seq bigint")


def test_bronze_window_inclusive(spark):
    rows = [("AAA", "HOSE", t, "1", "1", i) for i, t in
            enumerate(["2024-12-31", "2025-01-01", "2025-01-31", "2025-02-01"])]
    b = bronze.bronze_bars(_raw(spark, rows), "2025-01-01", "2025-01-31")
    assert sorted(r.time for r in b.collect()) == ["2025-01-01", "2025-01-31"]
    r = bronze.bronze_range(b).first()
    assert r.in_window and r.rows == 2


def test_bronze_rejects_bad_window_and_exchange(spark):
    raw = _raw(spark, [("AAA", "HOSE", "2025-01-01", "1", "1", 1)])
    with pytest.raises(ValueError):
        bronze.bronze_bars(raw, "2025/01/01", "2025-01-31")
    with pytest.raises(ValueError):
        bronze.bronze_bars(raw, "2025-01-01", "2025-01-31", exchanges=["UPCOM"])


def test_silver_rules(spark):
    raw = _raw(spark, [
        ("AAA", " hose ", "2025-01-02", "10.5", "-5", 1),
        ("BBB", "hnx", "2025-01-02", "n/a", "7", 2),
        ("CCC", "HNX", "2025-01-03", "3", None, 3),
    ])
    s = silver.silver_bars(raw, batch_ts=dt.datetime(2026, 1, 1)).orderBy("symbol").collect()
    assert [r.symbol for r in s] == ["AAA", "CCC"]  # n/a close dropped
    assert [r.exchange for r in s] == ["HOSE", "HNX"]
    assert [r.volume for r in s] == [0.0, 0.0]
    assert s[0].trading_date == D(2025, 1, 2) and s[0].source == "vnstock"
    assert s[0].ingestion_time == dt.datetime(2026, 1, 1)


def test_silver_date_column_resolution_and_strict_parse(spark):
    both = spark.createDataFrame([("AAA", "HOSE", "2025-01-02", "2000-01-01", "1", "1")],
                                 "symbol string, exchange string, time string, date string, "
                                 "close string, volume string")
    s = silver.silver_bars(both).first()
    assert s.trading_date == D(2025, 1, 2) and "time" not in s and "date" not in s
    with pytest.raises(ValueError):
        silver.silver_bars(both.drop("time", "date"))
    bad = _raw(spark, [("AAA", "HOSE", "oops", "1", "1", 1)])
    with pytest.raises(ValueError, match="oops"):
        silver.silver_bars(bad)
    null_text = _raw(spark, [("AAA", "HOSE", None, "1", "1", 1)])
    with pytest.raises(ValueError):
        silver.silver_bars(null_text)
    with pytest.raises(ValueError):
        silver.silver_bars(bad.drop("exchange"))
    with pytest.raises(ValueError):
        silver.silver_bars(bad.drop("volume"))


def _silver(spark, rows):
    return spark.createDataFrame(rows, "symbol string, exchange string, trading_date date, "
                                       "close_price double, volume double, ingest_seq bigint")


def test_returns_use_previous_row_and_guard_zero(spark):
    days = [D(2025, 1, 2), D(2025, 1, 9), D(2025, 2, 1), D(2025, 3, 1)]
    rows = [("AAA", "HOSE", d, c, 1.0, i) for i, (d, c) in enumerate(zip(days, [10.0, 0.0, 5.0, 6.0]))]
    g = gold.gold_bars(_silver(spark, rows)).orderBy("trading_date").collect()
    assert [r.daily_return for r in g] == [None, -1.0, None, 0.2]


def test_moving_averages_count_rows_not_days(spark):
    rows = [("AAA", "HOSE", D(2025, 1, 1) + dt.timedelta(days=3 * i), float(i + 1), 1.0, i)
            for i in range(25)]
    for decimals in (None, 2):
        g = gold.gold_bars(_silver(spark, rows), price_decimals=decimals).orderBy("trading_date").collect()
        assert g[0].ma_5 == 1.0 and g[0].ma_20 == 1.0
        assert g[3].ma_5 == pytest.approx(2.5)
        assert g[24].ma_5 == pytest.approx(sum(range(21, 26)) / 5)
        assert g[24].ma_20 == pytest.approx(sum(range(6, 26)) / 20)
        for r in g:  # property: a moving mean lies inside its frame's range
            assert 1.0 <= r.ma_5 <= 25.0


def test_keep_last_across_partitions(spark):
    rows = [("AAA", "HOSE", D(2025, 1, 2), float(seq), 1.0, seq) for seq in (2, 3, 1)]
    df = _silver(spark, rows).repartition(3)
    g = gold.gold_bars(df).collect()
    assert len(g) == 1 and g[0].close_price == 3.0


def test_fractional_volume_fails(spark):
    df = _silver(spark, [("AAA", "HOSE", D(2025, 1, 2), 1.0, 1.5, 1)])
    with pytest.raises(Exception, match="integer"):
        gold.gold_bars(df).collect()


def test_gold_missing_columns_gives_empty(spark):
    df = _silver(spark, [("AAA", "HOSE", D(2025, 1, 2), 1.0, 1.0, 1)]).drop("volume")
    assert gold.gold_bars(df).count() == 0


def test_dim_date_calendar(spark):
    d = warehouse.dim_date(spark)
    assert d.count() == 7670
    got = {r.date_key: r for r in d.where(F.col("date_key").isin(
        D(2021, 1, 3), D(2018, 12, 31), D(2016, 2, 29))).collect()}
    assert got[D(2021, 1, 3)].week_of_year == 53 and got[D(2021, 1, 3)].day_of_week == "0"
    assert got[D(2021, 1, 3)].is_weekend and not got[D(2021, 1, 3)].is_trading_day
    assert got[D(2018, 12, 31)].week_of_year == 1
    assert D(2016, 2, 29) in got


def test_distributed_dense_rank_equals_window(spark):
    keys = spark.range(0, 500).select(
        (F.col("id") % 37).cast("string").alias("a"), (F.col("id") % 11).cast("string").alias("b")
    ).distinct()
    ours = dense_rank_distinct(keys, ["a", "b"], "k", num_partitions=5)
    ref = keys.withColumn("k", F.dense_rank().over(Window.orderBy("a", "b")))
    assert sorted(map(tuple, ours.select("a", "b", "k").collect())) == \
        sorted(map(tuple, ref.select("a", "b", "k").collect()))


def test_yearly_is_day_weighted_close_unweighted_return(spark):
    monthly = spark.createDataFrame(
        [(1, 2025, 1, 202501, 10.0, 0.01, 10.0, 10.0, 5, 1),
         (1, 2025, 2, 202502, 20.0, 0.03, 20.0, 20.0, 5, 20)],
        "symbol_key bigint, year bigint, month bigint, month_key bigint, avg_close_price double, "
        "avg_daily_return double, avg_ma_5 double, avg_ma_20 double, total_volume bigint, "
        "trading_days bigint")
    for exact in (False, True):
        y = warehouse.fact_yearly(monthly, exact=exact).first()
        assert y.avg_close_price == round((10 * 1 + 20 * 20) / 21, 2)
        assert y.avg_daily_return == 0.02
        assert y.trading_days == 21 and y.total_volume == 10


def test_bronze_exchange_filter_uses_clean_venue(spark):
    rows = [("AAA", " hose ", "2025-01-02", "1", "1", 1), ("BBB", "HNX", "2025-01-02", "1", "1", 2),
            ("CCC", "UPCOM", "2025-01-02", "1", "1", 3)]
    b = bronze.bronze_bars(_raw(spark, rows), "2025-01-01", "2025-01-31", exchanges=["HOSE"])
    assert [r.symbol for r in b.collect()] == ["AAA"]


def test_silver_lazy_raise_mode(spark):
    bad = _raw(spark, [("AAA", "HOSE", "oops", "1", "1", 1)])
    s = silver.silver_bars(bad, on_bad_date="raise")  # no extra pass: fails on execution
    with pytest.raises(Exception, match="oops"):
        s.collect()
    assert silver.silver_bars(bad, on_bad_date="drop").count() == 0


def test_keep_last_needs_an_order(spark):
    df = _silver(spark, [("AAA", "HOSE", D(2025, 1, 2), 1.0, 1.0, 1)]).drop("ingest_seq")
    with pytest.raises(ValueError, match="arrival order"):
        gold.gold_bars(df)


def test_times_of_day_are_one_day(spark):
    df = _silver(spark, [("AAA", "HOSE", D(2025, 1, 2), float(i), 1.0, i) for i in (1, 2)])
    stamped = df.withColumn("trading_date", F.col("trading_date").cast("timestamp_ntz") + F.expr("make_dt_interval(0, ingest_seq)"))
    rows = gold.gold_bars(stamped).collect()
    assert [(r.trading_date, r.close_price) for r in rows] == [(D(2025, 1, 2), 2.0)]


def test_fixed_point_refuses_other_values(spark):
    df = _silver(spark, [("AAA", "HOSE", D(2025, 1, 2), 10.1234, 1.0, 1)])
    with pytest.raises(Exception, match="does not fit 2 decimals"):
        gold.gold_bars(df, price_decimals=2).collect()
    assert gold.gold_bars(df).first().ma_5 == 10.1234 and gold.gold_bars(df, price_decimals=4).first().ma_5 == 10.1234


def test_bronze_range_raises(spark):
    b = bronze.bronze_bars(_raw(spark, [("AAA", "HOSE", "2025-01-02", "1", "1", 1)]), "2025-01-01", "2025-01-31")
    bronze.assert_bronze_range(b)
    with pytest.raises(AssertionError):
        bronze.assert_bronze_range(b.withColumn("trading_date", F.lit("2026-01-01").cast("date")))


def test_recent_report_anchors(spark):
    view = spark.createDataFrame([("AAA", D.today(), 2.0), ("BBB", D(2020, 1, 1), 1.0)],
                                 "symbol string, trading_date date, close_price double")
    assert [r.symbol for r in bi.recent_avg_close(view).collect()] == ["AAA"]
    assert [r.symbol for r in bi.recent_avg_close(view, anchor="max").collect()] == ["AAA"]
    assert {r.symbol for r in bi.recent_avg_close(view, anchor="2020-01-10").collect()} == {"AAA", "BBB"}
