"""Incremental warehouse against a full rebuild; text ranges of landed days."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from barlake.functions.exprs import parse_text_date
from barlake.operators import bronze, warehouse
from barlake.plans.medallion import run_medallion
from barlake.plans.refresh import WarehouseState
from barlake.sinks import tables
from test_medallion import _bars, _config

D = dt.date


def _every(start, count, step):
    return [(start + dt.timedelta(days=step * i)).isoformat() for i in range(count)]


def _rebuilt(spark, root, decimals):
    view = warehouse.gold_view(tables.read_layer(spark, root + "/gold"))
    symbols, dates = warehouse.dim_symbol(view), warehouse.dim_date(spark)
    fact = warehouse.fact_daily(view, symbols)
    monthly = warehouse.fact_monthly(fact, dates, price_decimals=decimals)
    return symbols, monthly, warehouse.fact_yearly(monthly, exact=decimals is not None)


def _same(a, b):
    assert a.count() == b.count() and a.exceptAll(b.select(*a.columns)).count() == 0


def test_three_runs_equal_a_rebuild(spark, tmp_lake):
    raw = _bars(spark, _every(D(2023, 11, 20), 150, 1), "BBB").union(_bars(spark, _every(D(2023, 12, 5), 6, 31), "CCC", "HNX"))
    late = raw.union(_bars(spark, _every(D(2024, 2, 1), 40, 1), "AAA"))  # a new ticker changes all keys
    changed = late.withColumn("close", F.when(F.col("symbol") == "BBB", F.lit("77.25")).otherwise(F.col("close")))
    state = WarehouseState(spark, tmp_lake + "/gold", tmp_lake + "/state", price_decimals=2)
    for bars, start, end in [(raw, "2023-11-01", "2024-01-31"), (late, "2024-02-01", "2024-12-31"), (changed, "2023-12-10", "2023-12-20")]:
        stats = run_medallion(spark, bars, _config(tmp_lake, start, end, price_decimals=2))
        state.refresh([d for d, *_ in stats["gold_keys"]])
        for got, want in zip((state.dim_symbol(), state.monthly(), state.yearly()), _rebuilt(spark, tmp_lake, 2)):
            _same(got, want)
    assert state.keys.read().count() == 3 and len(state.keys.current().groups) == 2
    # the last run read one month of gold
    months = {f.split("_month=")[1][:7] for f in state.gold.read("2023-12-01", "2023-12-31").inputFiles()}
    assert months == {"2023-12"}
    state.refresh([])
    state.refresh(["2023-12-11"])
    _same(state.monthly(), _rebuilt(spark, tmp_lake, 2)[1])


TEXTS = ["2024-03-05", " 2024-3-5", "2024/03/05", "2024/3/5", "20240305", "03/05/2024", "3/5/2024 10:00", " 2024-03-05", "2024-03-05T09:00:00Z",
         "2023-12-31", "2025-01-01", "12/31/2023", "20250101", "2024-12-31", "2024-01-01", "nope", "", None, "1999", "9/9/2024"]


@pytest.mark.parametrize("start,end", [("2024-03-01", "2024-03-31"), ("2023-06-01", "2025-06-01"), ("2023-12-31", "2024-03-05"),
                                       ("2024-03-05", "2024-03-05"), ("2024-01-01", "2024-12-31")])
def test_ranges_lose_no_day(spark, start, end):
    df = spark.createDataFrame([(t,) for t in TEXTS], "time string")
    inside = parse_text_date(F.col("time")).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    lost = df.where(inside).where(~F.coalesce(bronze.may_be_inside(F.col("time"), start, end), F.lit(False)))
    assert lost.count() == 0 and df.where(inside).count() > 0


def test_ranges_reach_the_scan(spark, tmp_lake):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    days = _every(D(2016, 1, 1), 3000, 1)
    _bars(spark, days).repartitionByRange(8, "time").sortWithinPartitions("time").write.parquet(tmp_lake)
    landed = tables.read_layer(spark, tmp_lake)
    for start, end, most in (("2018-01-01", "2018-12-31", 1200), ("2017-02-01", "2017-02-10", 800), ("2017-02-01", "2018-12-31", 1800)):
        got = bronze.bronze_bars(landed, start, end, stored_text=True)
        assert sorted(r.trading_date.isoformat() for r in got.collect()) == [d for d in days if start <= d <= end]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [" in plan and "LessThan(time,!)" in plan
        # rows that leave the scan: those of row groups whose range may hold the window
        scan = [x for x in _nodes(got._jdf.queryExecution().executedPlan()) if "FileSourceScan" in x.getClass().getName()]
        assert scan[0].metrics().apply("numOutputRows").value() < most
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_a_pruned_run_equals_a_counting_one(spark, tmp_lake):
    days = _every(D(2024, 1, 1), 100, 1) + ["nope", " 2024-02-03 ", "02/04/2024"]
    _bars(spark, days).write.parquet(tmp_lake + "/landed")
    landed = tables.read_layer(spark, tmp_lake + "/landed")
    one = run_medallion(spark, landed, _config(tmp_lake + "/a", "2024-02-01", "2024-02-29", strict=False))
    two = run_medallion(spark, landed, _config(tmp_lake + "/b", "2024-02-01", "2024-02-29", strict=False, prune_landing=True))
    assert one["rejected"]["invalid_date"] == 1 and "rejected" not in two and one["gold_keys"] == two["gold_keys"]
    _same(*(tables.read_layer(spark, f"{tmp_lake}/{x}/gold") for x in "ab"))


def _nodes(plan):
    if "AdaptiveSparkPlan" in plan.getClass().getName():
        return _nodes(plan.executedPlan())
    children, out = plan.children(), [plan]
    for i in range(children.size()):
        out += _nodes(children.apply(i))
    return out
