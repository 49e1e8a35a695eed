"""

``entry(spark)`` runs the flagship report on sf0.001; ``queries()`` maps every
implemented operator to a ``(spark, sf_dir) -> DataFrame`` callable over the
whole test tables; ``oracle_sql()`` gives the equivalent DuckDB SQL for each
key (computed columns carry the same aliases on both sides).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from barlake.functions.exprs import is_valid_ticker, parse_number, round_places  # noqa: E402
from barlake.operators import bronze as bronze_ops  # noqa: E402
from barlake.operators import checks, contracts, gold as gold_ops, silver as silver_ops, warehouse as warehouse_ops  # noqa: E402
from barlake.operators.bi import recent_avg_close, top_symbols_last_dates  # noqa: E402
from barlake.operators.warehouse import fact_monthly, fact_yearly  # noqa: E402
from barlake.plans.lakehouse import FIXTURE_PRICE_DECIMALS, FIXTURE_WINDOW, Lakehouse  # noqa: E402
from barlake.plans.medallion import GOLD_VIEW, MedallionConfig, build_warehouse, run_medallion  # noqa: E402
from barlake.plans.refresh import WarehouseState  # noqa: E402
from barlake.session import checkpoint_dir, scratch_path  # noqa: E402
from barlake.sinks import layers, tables  # noqa: E402

try:  # the text operators are an optional part, and so are the modules they need
    from barlake.llm.registry import ORACLE_SQL as TEXT_SQL
    from barlake.llm.registry import QUERIES as TEXT_QUERIES
    from corpus_pipeline import ORACLE_SQL as PIPELINE_SQL
    from corpus_pipeline import run as run_pipeline
except ModuleNotFoundError as missing:
    if missing.name.startswith("barlake") and missing.name != "barlake.llm":
        raise
    TEXT_QUERIES, TEXT_SQL = {}, {}
else:
    TEXT_QUERIES = {**TEXT_QUERIES, "pipeline": run_pipeline}
    TEXT_SQL = {**TEXT_SQL, **({"pipeline": PIPELINE_SQL} if PIPELINE_SQL else {})}

SMOKE_DIR = "/root/testdata/sf0.001"

BRONZE_COLS = ["symbol", "exchange", "time", "open", "high", "low", "close", "volume",
               "trading_date", "api_source", "api_start_date", "api_end_date", "api_run_date"]
SILVER_COLS = ["symbol", "exchange", "open", "high", "low", "close_price", "volume",
               "trading_date", "api_source", "api_start_date", "api_end_date",
               "api_run_date", "source", "ingestion_time"]


def _lh(spark: SparkSession, sf_dir: str, **kw) -> Lakehouse:
    checkpoint_dir(spark)
    return Lakehouse(spark, sf_dir, **kw)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: top symbols by average close over the last 30 calendar days
    of the fact, built bronze -> silver -> gold -> star schema on sf0.001."""
    return _lh(spark, SMOKE_DIR).top_symbols_30d()


# --- query callables ---------------------------------------------------------

def q_symbol_filter(spark, d):
    raw = _lh(spark, d).raw
    return (raw.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"))
               .withColumn("is_valid", is_valid_ticker(F.col("symbol"))))


def q_bronze_bars(spark, d):
    return _lh(spark, d).bronze.select(*BRONZE_COLS)


def q_bronze_rejects(spark, d):
    return bronze_ops.bronze_rejects(_lh(spark, d).raw, *FIXTURE_WINDOW)


def q_bronze_range(spark, d):
    return bronze_ops.bronze_range(_lh(spark, d).bronze)


def q_universe_semi_join(spark, d):
    lh = _lh(spark, d)
    listed = bronze_ops.bronze_bars(lh.raw, *FIXTURE_WINDOW, listing=lh.listing,
                                    run_date=lh.run_date)
    return listed.select(*BRONZE_COLS)


def q_silver_bad_dates(spark, d):
    """Texts the silver operator can't read a day from: it maps them to a null
    day, which its own row rule would drop."""
    raw = _lh(spark, d).raw
    days = silver_ops.with_trading_day(raw, on_bad_date="null")
    return (days.where(F.col("trading_date").isNull())
                .groupBy(F.coalesce(F.col("time"), F.lit("None")).alias("value"))
                .agg(F.count(F.lit(1)).alias("rows")))


def q_silver_clean(spark, d):
    return _lh(spark, d).silver.select(*SILVER_COLS)


def q_exchange_union(spark, d):
    tpch = _lh(spark, d).silver.drop("ingest_seq")
    events = _lh(spark, d, source="events", window=None).silver.drop("ingest_seq")
    events = events.drop("api_source", "api_start_date", "api_end_date", "api_run_date")
    return tpch.select(*SILVER_COLS).unionByName(events, allowMissingColumns=True)


def q_gold_dedup(spark, d):
    return gold_ops.deduplicated(_lh(spark, d).silver)


def q_gold_daily(spark, d):
    return _lh(spark, d).gold


def _features(spark, d):
    lh = _lh(spark, d)
    return gold_ops.daily_features(gold_ops.deduplicated(lh.silver), price_decimals=lh.price_decimals)


def q_gold_prev_close(spark, d):
    return _features(spark, d).select("symbol", "exchange", "trading_date", "close_price", "prev_close")


def q_gold_daily_return(spark, d):
    return _features(spark, d).select("symbol", "exchange", "trading_date", "daily_return")


def q_gold_ma_5(spark, d):
    return _features(spark, d).select("symbol", "exchange", "trading_date", "ma_5")


def q_gold_ma_20(spark, d):
    return _features(spark, d).select("symbol", "exchange", "trading_date", "ma_20")


def q_gold_daily_events(spark, d):
    return _lh(spark, d, source="events", window=None).gold


def q_gold_view(spark, d):
    return _lh(spark, d).view


def q_dim_symbol(spark, d):
    return _lh(spark, d).dim_symbol


def q_dim_date(spark, d):
    """The calendar, with the landed line items of each day (ship days moved as
    the landing mapping moves them)."""
    from barlake.sources.landing import DATE_SHIFT_MONTHS, read_table
    day = F.add_months(F.to_date("l_shipdate"), DATE_SHIFT_MONTHS)
    landed = (read_table(spark, d, "lineitem").groupBy(day.alias("date_key"))
              .agg(F.count(F.lit(1)).alias("_n")))
    return (_lh(spark, d).dim_date.join(landed, "date_key", "left")
            .withColumn("landed_rows", F.coalesce(F.col("_n"), F.lit(0)).cast("bigint"))
            .drop("_n"))


def q_fact_daily(spark, d):
    return _lh(spark, d).fact


def q_fact_monthly(spark, d):
    return _lh(spark, d).monthly


def q_fact_yearly(spark, d):
    return _lh(spark, d).yearly


def q_check_row_counts(spark, d):
    lh = _lh(spark, d)
    return checks.check_row_counts(lh.fact, lh.dim_date, lh.dim_symbol, lh.monthly, lh.yearly)


def q_integrity_report(spark, d):
    return _lh(spark, d).integrity()


def q_integrity_report_broken(spark, d):
    lh = _lh(spark, d)
    return lh.integrity(lh.broken_fact)


def q_bi_volume(spark, d):
    return _lh(spark, d).volume_by_exchange_year()


def q_bi_top_symbols(spark, d):
    return _lh(spark, d).top_symbols_30d()


def q_bi_recent(spark, d):
    return _lh(spark, d).recent_avg_close(anchor="max")


def q_bi_recent_today(spark, d):
    """The report's own anchor, today, over the view with its days moved so that the
    latest one is today's."""
    view = _lh(spark, d).view
    ago = F.datediff(F.current_date(), view.agg(F.max("trading_date")).scalar())
    moved = view.withColumn("trading_date", F.date_add("trading_date", ago))
    return recent_avg_close(moved, price_decimals=FIXTURE_PRICE_DECIMALS)


def q_contract_report(spark, d):
    return contracts.contract_report(_lh(spark, d).silver_table, contracts.SILVER_CONTRACT)


def q_gold_contract_report(spark, d):
    return contracts.contract_report(_lh(spark, d).gold_table, contracts.GOLD_CONTRACT)


def q_check_pk_dups(spark, d):
    return contracts.duplicate_keys(_lh(spark, d).silver_table, ["symbol", "trading_date"])


def q_check_integer_valued(spark, d):
    return contracts.integer_valued_report(_lh(spark, d).raw, ["volume", "close"])


def q_check_non_negative(spark, d):
    raw = _lh(spark, d).raw
    typed = raw.select(parse_number(raw, "volume").alias("volume"),
                       parse_number(raw, "close").alias("close"))
    return contracts.non_negative_report(typed, ["volume", "close"])


def q_check_midnight(spark, d):
    return contracts.midnight_report(_lh(spark, d, source="events", window=None).raw, ["time"])


def q_layer_stats(spark, d):
    lh = _lh(spark, d)
    parts = [df.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("rows"),
                    F.count_distinct("symbol").alias("symbols"))
             for name, df in (("bronze", lh.bronze), ("silver", lh.silver), ("gold", lh.gold))]
    return reduce(DataFrame.unionByName, parts)


def q_bronze_json_rows(spark, d):
    return tables.render_dates_as_text(_lh(spark, d).bronze.select(*BRONZE_COLS))


def q_bronze_manifest(spark, d):
    lh = _lh(spark, d)
    path = scratch_path(spark, "bronze")
    layers.save_bronze(lh.bronze.drop("ingest_seq"), path, lh.run_date, fmt="json")
    return tables.partition_manifest(spark, path, "data_date")


def q_silver_manifest(spark, d):
    lh = _lh(spark, d)
    path = scratch_path(spark, "silver")
    layers.save_silver(lh.silver.drop("ingest_seq"), path, lh.run_date)
    return tables.partition_manifest(spark, path, "trading_date")


def q_gold_manifest(spark, d):
    lh = _lh(spark, d)
    path = scratch_path(spark, "gold")
    layers.save_gold(lh.gold, path, run_date=lh.run_date)
    return (tables.read_layer(spark, path).groupBy("trading_date")
                  .agg(F.count(F.lit(1)).alias("rows"), F.sum("volume").cast("bigint").alias("volume")))


def q_written_keys(spark, d):
    """The (day, venue) partitions that the gold sink reports to have written."""
    lh = _lh(spark, d)
    result = layers.save_gold(lh.gold, scratch_path(spark, "gold"), run_date=lh.run_date)
    return spark.createDataFrame(result["keys"], "trading_date string, venue string")


def _windows():
    return [(FIXTURE_WINDOW[0], "2018-06-30", None), ("2018-07-01", FIXTURE_WINDOW[1], ["HOSE"]),
            ("2018-07-01", FIXTURE_WINDOW[1], ["HNX"])]


def q_gold_incremental(spark, d):
    """Gold written by the job in runs over adjoining windows, the later one
    venue by venue: equal to one rebuild."""
    root = scratch_path(spark, "medallion")
    raw = _lh(spark, d).landed  # the runs' common input, made once
    for start, end, venues in _windows():
        run_medallion(spark, raw, MedallionConfig(lake_root=root, start_date=start, end_date=end, exchanges=venues,
                                                  strict=False, price_decimals=2))
    return (tables.read_layer(spark, f"{root}/gold").where("exchange in ('HOSE', 'HNX')")
            .select(*gold_ops.GOLD_COLUMNS))


# -- incremental warehouse: state of months refreshed by three runs of the job ----

_RUNS: dict[tuple, WarehouseState] = {}


def _refreshed(spark, d) -> WarehouseState:
    """The warehouse state after three runs of the job, made once per session and input."""
    lh = _lh(spark, d)
    key = (spark.conf.get("spark.app.id", ""), d, lh._input_state)
    if key not in _RUNS:
        root = scratch_path(spark, "warehouse")
        state = WarehouseState(spark, f"{root}/gold", f"{root}/state", price_decimals=lh.price_decimals)
        for start, end, venues in _windows():
            stats = run_medallion(spark, lh.landed, MedallionConfig(
                lake_root=root, start_date=start, end_date=end, exchanges=venues, strict=False, price_decimals=lh.price_decimals))
            state.refresh([day for day, *_ in stats.get("gold_keys", ())])
        _RUNS[key] = state
    return _RUNS[key]


def q_dim_symbol_incremental(spark, d):
    return _refreshed(spark, d).dim_symbol()


def q_fact_monthly_incremental(spark, d):
    return _refreshed(spark, d).monthly()


def q_fact_yearly_incremental(spark, d):
    return _refreshed(spark, d).yearly()


def q_run_manifest(spark, d):
    """Completion rows that the three runs left beside each layer."""
    root = _refreshed(spark, d).gold.path.removesuffix("/gold")
    parts = [tables.read_layer(spark, f"{root}/{name}_run_manifest") for name in ("bronze", "silver", "gold")]
    return reduce(DataFrame.unionByName, parts).select("layer", "rows")


def q_gold_view_stored(spark, d):
    """The analytics view opened by its stored name over the incremental gold."""
    gold = _refreshed(spark, d).gold.path
    root = scratch_path(spark, "views")
    venues = ", ".join(f"'{v}'" for v in warehouse_ops.GOLD_VIEW_EXCHANGES)
    tables.save_view(spark, root, GOLD_VIEW, gold, warehouse_ops.GOLD_VIEW_COLUMNS, f"exchange IN ({venues})")
    return tables.open_view(spark, root, GOLD_VIEW)


def q_warehouse_integrity(spark, d):
    """The integrity report of one warehouse build over the incremental gold."""
    lh = _lh(spark, d)
    built = build_warehouse(spark, _refreshed(spark, d).gold.path, scratch_path(spark, "built"), price_decimals=lh.price_decimals)
    return built["integrity"]


#: A contract that silver can't fulfil: an unknown type, and columns that it doesn't have.
PROBE_CONTRACT = contracts.Contract.from_dict({
    "table": "stock_price_probe",
    "columns": {"symbol": {"type": "string", "nullable": False}, "close_price": {"type": "currency"}, "isin": {"type": "string"},
                "volume": {}},
    "partition_by": ["trading_date", "listing_day"], "primary_key": ["symbol", "trading_date"],
    "quality_checks": {"not_null": ["open"], "positive_values": ["low", "exchange"]}})


def q_contract_report_probe(spark, d):
    return contracts.contract_report(_lh(spark, d).silver_table, PROBE_CONTRACT)


def q_contract_enforced(spark, d):
    """What a lenient run warns of over silver with seeded faults, and at which of
    them a strict run stops."""
    report = contracts.contract_report(checks.broken_silver(_lh(spark, d).silver_table), contracts.SILVER_CONTRACT)
    rows = contracts.enforce(report, strict=False)
    return spark.createDataFrame([(r["rule"], r["column"], r["violations"], i == 0) for i, r in enumerate(rows)],
                                 "rule string, column string, violations bigint, stops boolean")


def q_bronze_from_landing(spark, d):
    """Bronze over stored landed text, of which the window's row groups are read."""
    lh = _lh(spark, d)
    return bronze_ops.bronze_bars(lh.landing_table, *FIXTURE_WINDOW, run_date=lh.run_date, stored_text=True).select(*BRONZE_COLS)


# -- averages of plain doubles, as SQL's AVG gives them ----------------------

def _plain(spark, d):
    return _lh(spark, d, price_decimals=None)


def q_gold_plain(column):
    def run(spark, d):
        lh = _plain(spark, d)
        features = gold_ops.daily_features(gold_ops.deduplicated(lh.silver))
        return features.select("symbol", "exchange", "trading_date", round_places(F.col(column), 6).alias(column))
    return run


def q_fact_monthly_plain(spark, d):
    lh = _plain(spark, d)
    return fact_monthly(lh.fact, lh.dim_date, places=6)


def q_fact_yearly_plain(spark, d):
    """Over monthly averages at 10 decimals: rounded to 6 they would tie in the yearly mean."""
    lh = _plain(spark, d)
    return fact_yearly(fact_monthly(lh.fact, lh.dim_date, places=10), places=6)


def q_fact_yearly_units(spark, d):
    """The yearly fact over plain monthly averages at 10 decimals, summed as integers
    of these: no result depends on the order in which doubles are added."""
    lh = _plain(spark, d)
    return fact_yearly(fact_monthly(lh.fact, lh.dim_date, places=10), places=6, units=10)


def q_top_symbols_plain(spark, d):
    lh = _plain(spark, d)
    return top_symbols_last_dates(lh.fact, lh.dim_date, lh.dim_symbol, places=6)


def q_bi_volume_top(spark, d):
    """The ordered report's first five rows, with their places."""
    rows = _lh(spark, d).volume_by_exchange_year(top_n=5)
    place = Window.orderBy(F.col("total_volume").desc(), "year", "exchange")  # five rows
    return rows.withColumn("place", F.row_number().over(place).cast("bigint"))


def q_contract_broken(spark, d):
    """The silver contract over a silver frame with seeded faults of each kind."""
    bad = checks.broken_silver(_lh(spark, d).silver_table)
    return contracts.contract_report(bad, contracts.SILVER_CONTRACT)


def _metric_query(build):
    def run(spark, d):
        lh = _lh(spark, d)
        return build(lh)
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "symbol_filter": q_symbol_filter,
        "bronze_bars": q_bronze_bars,
        "bronze_rejects": q_bronze_rejects,
        "bronze_range": q_bronze_range,
        "universe_semi_join": q_universe_semi_join,
        "silver_bad_dates": q_silver_bad_dates,
        "silver_clean": q_silver_clean,
        "exchange_union": q_exchange_union,
        "gold_dedup": q_gold_dedup,
        "gold_daily": q_gold_daily,
        "gold_prev_close": q_gold_prev_close,
        "gold_daily_return": q_gold_daily_return,
        "gold_ma_5": q_gold_ma_5,
        "gold_ma_20": q_gold_ma_20,
        "gold_daily_events": q_gold_daily_events,
        "gold_view": q_gold_view,
        "dim_symbol": q_dim_symbol,
        "dim_date": q_dim_date,
        "fact_daily": q_fact_daily,
        "fact_monthly": q_fact_monthly,
        "fact_yearly": q_fact_yearly,
        "check_row_counts": q_check_row_counts,
        "check_dup_daily": _metric_query(lambda lh: checks.check_dup_daily(lh.fact)),
        "check_dup_monthly": _metric_query(lambda lh: checks.check_dup_monthly(lh.monthly)),
        "check_dup_yearly": _metric_query(lambda lh: checks.check_dup_yearly(lh.yearly)),
        "check_null_keys": _metric_query(lambda lh: checks.check_null_keys(lh.fact)),
        "check_orphan_dates": _metric_query(lambda lh: checks.check_orphan_dates(lh.fact, lh.dim_date)),
        "check_orphan_symbols": _metric_query(
            lambda lh: checks.check_orphan_symbols(lh.fact, lh.dim_symbol)),
        "check_trading_days": _metric_query(lambda lh: checks.check_trading_days(lh.monthly)),
        "integrity_report": q_integrity_report,
        "integrity_report_broken": q_integrity_report_broken,
        "bi_volume_by_exchange_year": q_bi_volume,
        "bi_top_symbols_30d": q_bi_top_symbols,
        "bi_recent_avg_close": q_bi_recent,
        "bi_recent_avg_close_today": q_bi_recent_today,
        "contract_report": q_contract_report,
        "gold_contract_report": q_gold_contract_report,
        "check_pk_dups": q_check_pk_dups,
        "check_integer_valued": q_check_integer_valued,
        "check_non_negative": q_check_non_negative,
        "check_midnight": q_check_midnight,
        "layer_stats": q_layer_stats,
        "bronze_json_rows": q_bronze_json_rows,
        "bronze_manifest": q_bronze_manifest,
        "silver_manifest": q_silver_manifest,
        "gold_manifest": q_gold_manifest,
        "written_keys": q_written_keys,
        "gold_incremental": q_gold_incremental,
        "dim_symbol_incremental": q_dim_symbol_incremental,
        "fact_monthly_incremental": q_fact_monthly_incremental,
        "fact_yearly_incremental": q_fact_yearly_incremental,
        "bronze_from_landing": q_bronze_from_landing,
        "run_manifest": q_run_manifest,
        "gold_view_stored": q_gold_view_stored,
        "warehouse_integrity": q_warehouse_integrity,
        "contract_report_probe": q_contract_report_probe,
        "contract_enforced": q_contract_enforced,
        "gold_ma_5_plain": q_gold_plain("ma_5"),
        "gold_ma_20_plain": q_gold_plain("ma_20"),
        "fact_monthly_plain": q_fact_monthly_plain,
        "fact_yearly_plain": q_fact_yearly_plain,
        "fact_yearly_units": q_fact_yearly_units,
        "bi_top_symbols_30d_plain": q_top_symbols_plain,
        "bi_volume_top_5": q_bi_volume_top,
        "contract_report_broken": q_contract_broken,
        **TEXT_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for every key of ``queries()`` (see ``oracle_sql.py``)."""
    from oracle_sql import oracle_queries
    return {**oracle_queries(), **TEXT_SQL}
