"""Stage sizes of the sf0.001 fixture (the expected-counts table of the
test-table mapping)."""
from pyspark.sql import functions as F

from barlake.operators import bronze
from barlake.plans.lakehouse import FIXTURE_WINDOW, Lakehouse

from conftest import SF_SMALL


def test_stage_counts(spark):
    lh = Lakehouse(spark, SF_SMALL)
    listed = bronze.bronze_bars(lh.raw, *FIXTURE_WINDOW, listing=lh.listing)
    got = {
        "raw": lh.raw.count(),
        "bronze": lh.bronze.count(),
        "bronze_listed": listed.count(),
        "silver": lh.silver.count(),
        "silver_volume_0": lh.silver.where("volume = 0").count(),
        "silver_repeated_keys": lh.silver.groupBy("symbol", "trading_date").count()
                                  .where("count > 1").count(),
        "gold": lh.gold.count(),
        "gold_null_return": lh.gold.where("daily_return IS NULL").count(),
        "dim_symbol": lh.dim_symbol.count(),
        "fact": lh.fact.count(),
        "monthly": lh.monthly.count(),
        "monthly_null_return": lh.monthly.where("avg_daily_return IS NULL").count(),
        "yearly": lh.yearly.count(),
        "dim_date": lh.dim_date.count(),
    }
    assert got == {
        "raw": 6000, "bronze": 2631, "bronze_listed": 2082, "silver": 2612,
        "silver_volume_0": 43, "silver_repeated_keys": 9, "gold": 2609,
        "gold_null_return": 566, "dim_symbol": 390, "fact": 2156, "monthly": 2056,
        "monthly_null_return": 367, "yearly": 1280, "dim_date": 7670,
    }


def test_broken_fact_and_bi_first_rows(spark):
    lh = Lakehouse(spark, SF_SMALL)
    report = {r.metric: r.value for r in lh.integrity(lh.broken_fact).collect()}
    assert (report["fact_orphan_date_key"], report["fact_orphan_symbol_key"],
            report["fact_null_keys"]) == (202, 713, 465)
    assert {r.metric: r.value for r in lh.integrity().collect()}["fact_orphan_date_key"] == 0
    v = lh.volume_by_exchange_year().first()
    assert (v.year, v.exchange, v.total_volume) == (2020, "HNX", 7054)
    t = lh.top_symbols_30d().first()
    assert (t.exchange, t.symbol, t.avg_close_30d) == ("HNX", "05A", 103974.79)


def test_volume_report_top_n(spark):
    top = Lakehouse(spark, SF_SMALL).volume_by_exchange_year(top_n=5).collect()
    assert len(top) == 5 and (top[0].year, top[0].exchange, top[0].total_volume) == (2020, "HNX", 7054)
    assert [r.total_volume for r in top] == sorted((r.total_volume for r in top), reverse=True)
