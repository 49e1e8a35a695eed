"""Star schema on top of gold: calendar and symbol dimensions, daily fact,
monthly and yearly roll-ups.

Join strategy: ``dim_date`` is a calendar over a fixed day range (7,670 rows
for 2015..2035) so it is broadcast explicitly; ``dim_symbol`` grows with the
ticker universe, so it is broadcast only after its rows have been counted
(``sized``) and joined by shuffle beyond the limit.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.exprs import round_places, to_units, units_mean_rounded
from barlake.functions.ranking import dense_rank_distinct

# --- fixed values ------------------------------------------------------------
GOLD_VIEW_EXCHANGES = ("HOSE", "HNX")
GOLD_VIEW_COLUMNS = ("trading_date", "symbol", "exchange", "close_price", "volume",
                     "daily_return", "ma_5", "ma_20")
CALENDAR_START = "2015-01-01"
CALENDAR_END = "2035-12-31"
WEEKEND_DAYS = ("0", "6")  # day_of_week text: '0' = Sunday ... '6' = Saturday
CLOSE_PLACES = 2
RETURN_PLACES = 4
MA_PLACES = 2
# ---------------------------------------------------------------------------

# Fixed-point scales used when ``price_decimals`` is given: moving averages and
# returns are taken to 1e-8 units before averaging, monthly values re-read at
# their rounded places.
MA_UNIT_DECIMALS = 8
RETURN_UNIT_DECIMALS = 8
# Rows of the symbol dimension (three short columns) that are broadcast at most.
BROADCAST_SYMBOLS = 500_000


def gold_view(gold: DataFrame, exchanges=GOLD_VIEW_EXCHANGES) -> DataFrame:
    """Analytics view of gold: venue IN-list filter and fixed projection.
    On a day-partitioned gold table the projection prunes columns and the
    venue predicate is pushed to the Parquet reader."""
    return gold.where(F.col("exchange").isin(list(exchanges))).select(*GOLD_VIEW_COLUMNS)


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END,
             num_partitions: int | None = None) -> DataFrame:
    """One row per calendar day, generated with ``range`` (distributed, any
    span) rather than exploding a single-row sequence."""
    lo = dt.date.fromisoformat(start)
    hi = dt.date.fromisoformat(end)
    days = (hi - lo).days + 1
    ids = spark.range(0, days, numPartitions=num_partitions) if num_partitions else spark.range(0, days)
    d = F.date_add(F.lit(start).cast("date"), F.col("id").cast("int"))
    dow = (F.dayofweek("date_key") - 1).cast("string")
    return ids.select(d.alias("date_key")).select(
        "date_key",
        F.year("date_key").cast("bigint").alias("year"),
        F.month("date_key").cast("bigint").alias("month"),
        F.dayofmonth("date_key").cast("bigint").alias("day"),
        F.quarter("date_key").cast("bigint").alias("quarter"),
        F.weekofyear("date_key").cast("bigint").alias("week_of_year"),
        dow.alias("day_of_week"),
        dow.isin(list(WEEKEND_DAYS)).alias("is_weekend"),
        (~dow.isin(list(WEEKEND_DAYS))).alias("is_trading_day"),
    )


def dim_symbol(view: DataFrame) -> DataFrame:
    """(symbol, exchange) -> dense integer key ordered by symbol, exchange.
    Keys are re-derived at every rebuild (not stable when a ticker is added)."""
    keys = view.select("symbol", "exchange").distinct()
    ranked = dense_rank_distinct(keys, ["symbol", "exchange"], "symbol_key")
    return ranked.select("symbol_key", "symbol", "exchange")


def is_few(symbols: DataFrame, limit: int | None = None) -> bool:
    """Whether the symbol dimension has at most ``limit`` rows (counted; a stored table
    answers that from its footers)."""
    limit = BROADCAST_SYMBOLS if limit is None else limit
    return symbols.limit(limit + 1).count() <= limit


def sized(symbols: DataFrame, limit: int | None = None) -> DataFrame:
    """The symbol dimension with a broadcast hint if it ``is_few``. Larger ones are
    joined by shuffle."""
    return F.broadcast(symbols) if is_few(symbols, limit) else symbols


def fact_daily(view: DataFrame, symbols: DataFrame, broadcast_limit: int | None = None) -> DataFrame:
    """Daily fact: measures + foreign keys; inner join drops rows whose
    (symbol, exchange) has no key (null parts never match). A symbol dimension
    of at most ``broadcast_limit`` rows leaves the gold side unshuffled."""
    g = view.alias("g")
    s = sized(symbols, broadcast_limit).alias("s")
    joined = g.join(s, (F.col("g.symbol") == F.col("s.symbol")) &
                    (F.col("g.exchange") == F.col("s.exchange")))
    return joined.select(
        F.col("g.trading_date").alias("date_key"),
        F.col("s.symbol_key").alias("symbol_key"),
        F.col("g.close_price").alias("close_price"),
        F.col("g.volume").alias("volume"),
        F.col("g.daily_return").alias("daily_return"),
        F.col("g.ma_5").alias("ma_5"),
        F.col("g.ma_20").alias("ma_20"),
    )


def fact_monthly(fact: DataFrame, dates: DataFrame, *, price_decimals: int | None = None,
                 places: int | None = None) -> DataFrame:
    """Monthly roll-up per (symbol_key, year, month).

    ``price_decimals`` set: averages come from exact integer sums (prices in
    ``10^-price_decimals`` units, moving averages and returns in 1e-8 units)
    and are rounded once - reproducible bit for bit across partitionings and
    engines. None: ``round(avg(x), n)`` on doubles, ``places`` replacing the
    reported decimals (a plain average's last bits depend on the summing order, so
    ties at the reported decimals may fall either way).
    """
    d = dates.select("date_key", "year", "month")
    joined = fact.join(F.broadcast(d), "date_key")
    if price_decimals is None:
        aggs = [
            round_places(F.avg("close_price"), places or CLOSE_PLACES).alias("avg_close_price"),
            round_places(F.avg("daily_return"), places or RETURN_PLACES).alias("avg_daily_return"),
            round_places(F.avg("ma_5"), places or MA_PLACES).alias("avg_ma_5"),
            round_places(F.avg("ma_20"), places or MA_PLACES).alias("avg_ma_20"),
        ]
    else:
        def mean(col, unit_dec, places):
            u = to_units(F.col(col), unit_dec, exact=col == "close_price")
            return units_mean_rounded(F.sum(u), F.count(u), unit_dec, places)
        aggs = [
            mean("close_price", price_decimals, CLOSE_PLACES).alias("avg_close_price"),
            mean("daily_return", RETURN_UNIT_DECIMALS, RETURN_PLACES).alias("avg_daily_return"),
            mean("ma_5", MA_UNIT_DECIMALS, MA_PLACES).alias("avg_ma_5"),
            mean("ma_20", MA_UNIT_DECIMALS, MA_PLACES).alias("avg_ma_20"),
        ]
    out = joined.groupBy("symbol_key", "year", "month").agg(
        *aggs,
        F.sum("volume").cast("bigint").alias("total_volume"),
        F.count(F.lit(1)).alias("trading_days"),
    )
    return out.select(
        "symbol_key", "year", "month",
        (F.col("year") * 100 + F.col("month")).alias("month_key"),
        "avg_close_price", "avg_daily_return", "avg_ma_5", "avg_ma_20",
        "total_volume", "trading_days",
    )


_MONTH_MEASURES = (("close_price", CLOSE_PLACES), ("daily_return", RETURN_PLACES), ("ma_5", MA_PLACES), ("ma_20", MA_PLACES))


def _unit_decimals(column: str, price_decimals: int) -> int:
    return {"close_price": price_decimals, "daily_return": RETURN_UNIT_DECIMALS}.get(column, MA_UNIT_DECIMALS)


def monthly_state(view: DataFrame, *, price_decimals: int | None = None, start: str = CALENDAR_START,
                  end: str = CALENDAR_END) -> DataFrame:
    """Sums and counts of each (symbol, exchange, month) from which the monthly fact
    is divided: integer units with ``price_decimals``, else doubles. Days beyond the
    calendar have no month. States of parts of a month add up; keyed by names, they
    outlive symbol keys, which change when a ticker is added."""
    days = view.where(F.col("trading_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    sums = []
    for column, _ in _MONTH_MEASURES:
        x = F.col(column) if price_decimals is None else to_units(
            F.col(column), _unit_decimals(column, price_decimals), exact=column == "close_price")
        sums += [F.sum(x).alias(f"{column}_sum"), F.count(x).alias(f"{column}_n")]
    return days.groupBy("symbol", "exchange", F.to_date(F.trunc("trading_date", "month")).alias("month_start")).agg(
        *sums, F.sum("volume").cast("bigint").alias("total_volume"), F.count(F.lit(1)).alias("trading_days"))


def monthly_fact(state: DataFrame, symbols: DataFrame, *, price_decimals: int | None = None) -> DataFrame:
    """The monthly fact (as ``fact_monthly``) of states, by the current symbol keys."""
    def mean(column: str, places: int):
        total, n = F.col(f"{column}_sum"), F.col(f"{column}_n")
        value = (round_places(total / F.nullif(n, F.lit(0)), places) if price_decimals is None
                 else units_mean_rounded(total, n, _unit_decimals(column, price_decimals), places))
        return value.alias(f"avg_{column}")

    year, month = F.year("month_start").cast("bigint"), F.month("month_start").cast("bigint")
    return state.join(sized(symbols), ["symbol", "exchange"]).select(
        "symbol_key", year.alias("year"), month.alias("month"), (year * 100 + month).alias("month_key"),
        *[mean(c, places) for c, places in _MONTH_MEASURES], "total_volume", "trading_days")


def fact_yearly(monthly: DataFrame, *, exact: bool = False, places: int | None = None,
                units: int | None = None) -> DataFrame:
    """Yearly roll-up FROM the monthly fact: day-weighted mean of the rounded
    monthly close, unweighted means of the monthly return / MAs, sums.

    ``exact``: the monthly values are already rounded to 2 / 4 places, so they
    are read back as integers of those units and averaged exactly. Else ``places``
    replaces the reported decimals. ``units``: the monthly values are read as integers
    of ``10^-units`` and averaged exactly, whatever order they're summed in.
    """
    days = F.col("trading_days")
    if exact or units is not None:
        own = CLOSE_PLACES if units is None else units
        close_u = to_units(F.col("avg_close_price"), own)
        close = units_mean_rounded(F.sum(close_u * days), F.sum(days), own, places or CLOSE_PLACES)

        def mean(col, reported):
            own = reported if units is None else units
            u = to_units(F.col(col), own)
            return units_mean_rounded(F.sum(u), F.count(u), own, places or reported)
        ret = mean("avg_daily_return", RETURN_PLACES)
        ma5 = mean("avg_ma_5", MA_PLACES)
        ma20 = mean("avg_ma_20", MA_PLACES)
    else:
        close = round_places(F.sum(F.col("avg_close_price") * days) /
                             F.nullif(F.sum(days), F.lit(0)), places or CLOSE_PLACES)
        ret = round_places(F.avg("avg_daily_return"), places or RETURN_PLACES)
        ma5 = round_places(F.avg("avg_ma_5"), places or MA_PLACES)
        ma20 = round_places(F.avg("avg_ma_20"), places or MA_PLACES)
    return monthly.groupBy("symbol_key", "year").agg(
        close.alias("avg_close_price"),
        ret.alias("avg_daily_return"),
        ma5.alias("avg_ma_5"),
        ma20.alias("avg_ma_20"),
        F.sum("total_volume").cast("bigint").alias("total_volume"),
        F.sum(days).cast("bigint").alias("trading_days"),
    )
