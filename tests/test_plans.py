"""Physical-plan properties that matter at scale."""
from barlake.operators import contracts, warehouse
from barlake.plans.lakehouse import Lakehouse
from barlake.sinks import tables

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_two_shuffles_with_partial_dedup(spark):
    plan = _plan(Lakehouse(spark, SF_SMALL).gold)
    assert plan.count("hashpartitioning(symbol") == 2
    assert "WindowGroupLimit" in plan
    # lag + both moving averages share one Window node
    assert plan.count("Window [") == 2


def test_calendar_broadcast_in_monthly(spark):
    lh = Lakehouse(spark, SF_SMALL)
    plan = _plan(warehouse.fact_monthly(lh.fact, lh.dim_date, price_decimals=2))
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_partition_pruning_on_day(spark, tmp_lake):
    lh = Lakehouse(spark, SF_SMALL)
    path = tmp_lake + "/gold"
    tables.write_partitioned(lh.gold, path, "trading_date")
    q = tables.read_layer(spark, path).where("trading_date >= DATE'2020-12-01' AND exchange = 'HOSE'")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trading_date" in plan
    assert "PushedFilters: [IsNotNull(exchange), EqualTo(exchange,HOSE)]" in plan


def test_bi_uses_scalar_subquery_and_preaggregates(spark):
    lh = Lakehouse(spark, SF_SMALL)
    plan = _plan(lh.top_symbols_30d())
    assert "Subquery" in plan and "BroadcastNestedLoopJoin" not in plan
    vol = _plan(lh.volume_by_exchange_year())
    # fact reduced per (symbol_key, year) before meeting dim_symbol
    assert vol.count("HashAggregate(keys=[symbol_key") >= 1


def test_filters_reach_the_scan(spark):
    plan = _plan(Lakehouse(spark, SF_SMALL).bronze)
    assert "Exchange RoundRobin" not in plan and "CollectMetrics" not in plan


def test_warehouse_reads_stored_gold(spark):
    lh = Lakehouse(spark, SF_SMALL)
    for df in (lh.view, lh.recent_avg_close(anchor="2020-12-31"), lh.fact):
        plan = _plan(df)
        assert "Scan ExistingRDD" not in plan and "FileScan parquet" in plan
    assert "PushedFilters: [In(exchange" in _plan(lh.view)
    assert "GreaterThanOrEqual(trading_date" in _plan(lh.recent_avg_close(anchor="2020-12-31"))


def test_symbol_dimension_is_broadcast_below_its_limit_only(spark):
    lh = Lakehouse(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = _plan(warehouse.fact_daily(lh.view, lh.dim_symbol))
        large = _plan(warehouse.fact_daily(lh.view, lh.dim_symbol, broadcast_limit=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning" not in small and "BroadcastHashJoin" in small
    assert "SortMergeJoin" in large and "BroadcastHashJoin" not in large


def test_contract_shuffles_the_key_only(spark):
    plan = contracts.contract_report(Lakehouse(spark, SF_SMALL).gold_table, contracts.GOLD_CONTRACT
                                     )._jdf.queryExecution().executedPlan().toString()
    exchanged = [x for x in plan.splitlines() if "Exchange hashpartitioning(symbol" in x]
    assert exchanged and "close_price" not in "".join(exchanged)


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_texts_are_matched_once(spark):
    lh = Lakehouse(spark, SF_SMALL)
    bronze, silver = _optimized(lh.bronze), _optimized(lh.silver)
    # one match for all day layouts; the fixture's own date_format twice, as it's written
    assert bronze.count("regexp_replace(") == silver.count("regexp_replace(") == 1 and bronze.count("date_format(") == 2
    # five number columns, and close once more in the filter below the joins
    assert silver.count("regexp_extract(") == 6 and silver.count("RLIKE(") == 1
    from barlake.operators.bronze import bronze_rejects
    from barlake.operators.silver import silver_bars
    for df in (bronze_rejects(lh.raw, "2016-01-01", "2020-12-31"), silver_bars(lh.raw, on_bad_date="drop"),
               silver_bars(lh.raw, on_bad_date="raise")):
        assert _optimized(df).count("regexp_replace(") == 1
