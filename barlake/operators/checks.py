"""Warehouse integrity checks.

Each ``check_*`` is a distributed aggregate returning ``(metric, value)``
rows; orphan checks are left-anti joins (a fact row with a null key never
matches, so it counts as an orphan, as with LEFT JOIN ... IS NULL).
``integrity_report`` computes all of them with one pass per table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _metric(name: str, value_df: DataFrame) -> DataFrame:
    return value_df.select(F.lit(name).alias("metric"), F.col("value").cast("bigint").alias("value"))


def row_count(name: str, df: DataFrame) -> DataFrame:
    return _metric(name, df.agg(F.count(F.lit(1)).alias("value")))


def duplicate_grain_count(name: str, df: DataFrame, grain: list[str]) -> DataFrame:
    """Number of grain values that occur more than once (GROUP BY ... HAVING
    COUNT(*) > 1, counted). Partial aggregation runs before the shuffle."""
    dups = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1)
    return _metric(name, dups.agg(F.count(F.lit(1)).alias("value")))


def null_key_count(name: str, fact: DataFrame) -> DataFrame:
    cond = F.col("date_key").isNull() | F.col("symbol_key").isNull()
    return _metric(name, fact.agg(F.count_if(cond).alias("value")))


def orphan_count(name: str, fact: DataFrame, dim: DataFrame, key: str,
                 broadcast_dim: bool = False) -> DataFrame:
    d = dim.select(key).distinct()
    if broadcast_dim:
        d = F.broadcast(d)
    orphans = fact.select(key).join(d, key, "left_anti")
    return _metric(name, orphans.agg(F.count(F.lit(1)).alias("value")))


def non_positive_days(name: str, monthly: DataFrame) -> DataFrame:
    return _metric(name, monthly.agg(F.count_if(F.col("trading_days") <= 0).alias("value")))


def check_row_counts(fact, dates, symbols, monthly, yearly) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        row_count("fact_stock_price_rows", fact),
        row_count("dim_date_rows", dates),
        row_count("dim_symbol_rows", symbols),
        row_count("fact_stock_price_monthly_rows", monthly),
        row_count("fact_stock_price_yearly_rows", yearly),
    ])


def check_dup_monthly(monthly) -> DataFrame:
    return duplicate_grain_count("monthly_duplicate_grain", monthly, ["symbol_key", "year", "month"])


def check_dup_yearly(yearly) -> DataFrame:
    return duplicate_grain_count("yearly_duplicate_grain", yearly, ["symbol_key", "year"])


def check_dup_daily(fact) -> DataFrame:
    return duplicate_grain_count("daily_duplicate_grain", fact, ["symbol_key", "date_key"])


def check_null_keys(fact) -> DataFrame:
    return null_key_count("fact_null_keys", fact)


def check_orphan_dates(fact, dates) -> DataFrame:
    # the calendar is bounded by its day range: safe to broadcast
    return orphan_count("fact_orphan_date_key", fact, dates, "date_key", broadcast_dim=True)


def check_orphan_symbols(fact, symbols) -> DataFrame:
    return orphan_count("fact_orphan_symbol_key", fact, symbols, "symbol_key")


def check_trading_days(monthly) -> DataFrame:
    return non_positive_days("monthly_trading_days_le_0", monthly)


def _stack(df: DataFrame, names: list[tuple[str, str]]) -> DataFrame:
    args = ", ".join(f"'{metric}', CAST(coalesce({col}, 0) AS BIGINT)" for metric, col in names)
    return df.select(F.expr(f"stack({len(names)}, {args}) AS (metric, value)"))


def integrity_report(fact, dates, symbols, monthly, yearly) -> DataFrame:
    """All warehouse checks as one (metric, value) table: row counts,
    duplicate grains (daily / monthly / yearly), null keys, orphan keys,
    non-positive trading days.

    One pass per table: the fact is first reduced to its distinct
    (symbol_key, date_key) pairs with their row counts (partial aggregation
    before the shuffle), the pairs are left-joined to the two dimensions'
    keys (the calendar is broadcast; the symbol keys are joined by AQE's
    choice), and a single aggregate yields rows, duplicate grain, null keys
    and both orphan counts. A null key never matches, so it counts as an
    orphan, as with LEFT JOIN ... IS NULL."""
    pairs = fact.groupBy("symbol_key", "date_key").agg(F.count(F.lit(1)).alias("_n"))
    cal = F.broadcast(dates.select(F.col("date_key").alias("_d")).distinct())
    syms = symbols.select(F.col("symbol_key").alias("_s")).distinct()
    flagged = (pairs.join(cal, pairs["date_key"] == cal["_d"], "left")
                    .join(syms, pairs["symbol_key"] == syms["_s"], "left"))
    n = F.col("_n")

    def rows_where(cond):
        return F.sum(F.when(cond, n).otherwise(F.lit(0)))
    fact_stats = flagged.agg(
        F.sum(n).alias("rows"),
        F.count_if(n > 1).alias("dup"),
        rows_where(F.col("date_key").isNull() | F.col("symbol_key").isNull()).alias("null_keys"),
        rows_where(F.col("_d").isNull()).alias("orphan_dates"),
        rows_where(F.col("_s").isNull()).alias("orphan_symbols"),
    )
    month_stats = (monthly.groupBy("symbol_key", "year", "month")
                          .agg(F.count(F.lit(1)).alias("_n"),
                               F.count_if(F.col("trading_days") <= 0).alias("_le0"))
                          .agg(F.sum("_n").alias("rows"), F.count_if(F.col("_n") > 1).alias("dup"),
                               F.sum("_le0").alias("le0")))
    year_stats = (yearly.groupBy("symbol_key", "year").agg(F.count(F.lit(1)).alias("_n"))
                        .agg(F.sum("_n").alias("rows"), F.count_if(F.col("_n") > 1).alias("dup")))
    parts = [
        _stack(fact_stats, [("fact_stock_price_rows", "rows"),
                            ("daily_duplicate_grain", "dup"),
                            ("fact_null_keys", "null_keys"),
                            ("fact_orphan_date_key", "orphan_dates"),
                            ("fact_orphan_symbol_key", "orphan_symbols")]),
        row_count("dim_date_rows", dates),
        row_count("dim_symbol_rows", symbols),
        _stack(month_stats, [("fact_stock_price_monthly_rows", "rows"),
                             ("monthly_duplicate_grain", "dup"),
                             ("monthly_trading_days_le_0", "le0")]),
        _stack(year_stats, [("fact_stock_price_yearly_rows", "rows"),
                            ("yearly_duplicate_grain", "dup")]),
    ]
    return reduce(DataFrame.unionByName, parts)


# --- fixed values of the corrupted-fact fixture ------------------------------
NULL_SYMBOL_MOD = 5
SHIFT_SYMBOL_MOD = 7
SHIFT_SYMBOL_BY = 1000
SHIFT_DATE_MOD = 11
SHIFT_DATE_YEARS = 30
# ---------------------------------------------------------------------------


def broken_silver(silver: DataFrame) -> DataFrame:
    """Silver with faults of every kind a contract knows, dealt by the cents of
    the close: nulls, negatives, fractional volumes, times of day, a text column
    where a number belongs, a missing column. A row-wise projection."""
    cents = F.round(F.col("close_price") * 100).cast("bigint")

    def when(mod: int, fault, column) -> Column:
        return F.when(cents % mod == 0, fault).otherwise(column)

    day = F.col("trading_date").cast("timestamp_ntz")
    return silver.select(
        when(11, F.lit(None).cast("string"), F.col("symbol")).alias("symbol"),
        when(19, F.lit(None).cast("string"), F.col("exchange")).alias("exchange"),
        F.when(cents % 29 == 0, F.lit(None).cast("timestamp_ntz"))
         .when(cents % 31 == 0, day + F.expr("INTERVAL 9 HOURS")).otherwise(day).alias("trading_date"),
        when(37, F.lit(-1.0), F.col("open")).alias("open"),
        F.col("high").cast("string").alias("high"), "low",
        F.when(cents % 23 == 0, F.lit(None).cast("double"))
         .when(cents % 13 == 0, -F.col("close_price")).otherwise(F.col("close_price")).alias("close_price"),
        when(17, F.col("volume") + 0.5, F.col("volume")).alias("volume"),
        when(41, F.lit(None).cast("timestamp_ntz"), F.col("ingestion_time")).alias("ingestion_time"))


def broken_fact(fact: DataFrame) -> DataFrame:
    """Deliberately corrupted copy of the daily fact that makes every
    integrity check fire: null / out-of-range symbol keys and dates past the
    calendar. A row-wise projection (no shuffle)."""
    k = F.col("symbol_key")
    new_key = (F.when(k % NULL_SYMBOL_MOD == 0, F.lit(None).cast("bigint"))
                .when(k % SHIFT_SYMBOL_MOD == 0, k + SHIFT_SYMBOL_BY)
                .otherwise(k))
    new_date = F.when(k % SHIFT_DATE_MOD == 0,
                      F.add_months(F.col("date_key"), 12 * SHIFT_DATE_YEARS)).otherwise(F.col("date_key"))
    return fact.select(new_date.alias("date_key"), new_key.alias("symbol_key"),
                       *[c for c in fact.columns if c not in ("date_key", "symbol_key")])
