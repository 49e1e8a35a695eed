"""BI reports over the star schema.

Aggregations are pushed below the dimension joins where the aggregate is
decomposable (sums, counts): the fact is reduced to one row per
(symbol_key, year) or per symbol_key with map-side partial aggregation before
it meets ``dim_symbol``, so the join and the final aggregate see a few rows
per ticker instead of the whole fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.exprs import round_places, to_units, units_mean_rounded

AVG_PLACES = 2


def volume_by_exchange_year(fact: DataFrame, dates: DataFrame, symbols: DataFrame,
                            top_n: int | None = None) -> DataFrame:
    """SUM(volume) by (year, exchange) over fact x dim_date x dim_symbol,
    ordered by total volume (descending; year, exchange break ties).
    ``top_n`` keeps only the first rows of the report."""
    d = F.broadcast(dates.select("date_key", "year"))  # bounded calendar
    per_key = (fact.join(d, "date_key")
                   .groupBy("symbol_key", "year")
                   .agg(F.sum("volume").alias("_v")))
    out = (per_key.join(symbols.select("symbol_key", "exchange"), "symbol_key")
                  .groupBy("year", "exchange")
                  .agg(F.sum("_v").cast("bigint").alias("total_volume")))
    ordered = out.orderBy(F.col("total_volume").desc(), "year", "exchange")
    return ordered.limit(top_n) if top_n else ordered


def _avg_close(sum_col, cnt_col, price_decimals, places=AVG_PLACES):
    if price_decimals is None:
        return round_places(F.col(sum_col) / F.col(cnt_col), places)
    return units_mean_rounded(F.col(sum_col), F.col(cnt_col), price_decimals, AVG_PLACES)


def _close_sum(price_decimals):
    c = F.col("close_price")
    return F.sum(c if price_decimals is None else to_units(c, price_decimals, exact=True))


def top_symbols_last_dates(fact: DataFrame, dates: DataFrame, symbols: DataFrame, *,
                           n_dates: int = 30, k: int = 10, price_decimals: int | None = None,
                           places: int = AVG_PLACES) -> DataFrame:
    """Top-k (exchange, symbol) by average close over the ``n_dates`` newest
    calendar days on or before the latest fact day.

    The date list is a LIMIT of the calendar (n_dates rows) -> broadcast
    semi-join; the fact is then reduced per symbol_key before the dimension
    join. Ties on the average are broken by exchange, symbol.
    """
    latest = fact.agg(F.max("date_key")).scalar()  # uncorrelated scalar subquery
    recent = (dates.select("date_key")
                   .where(F.col("date_key") <= latest)
                   .orderBy(F.col("date_key").desc())
                   .limit(n_dates))
    # the calendar has every day, so its n newest ones reach back n - 1 days; the
    # bound keeps older files of a fact stored by month unread
    bounded = fact.where(F.col("date_key") >= F.date_sub(latest, n_dates - 1))
    per_key = (bounded.join(F.broadcast(recent), "date_key", "left_semi")
                   .groupBy("symbol_key")
                   .agg(_close_sum(price_decimals).alias("_s"),
                        F.count("close_price").alias("_n")))
    out = (per_key.join(symbols, "symbol_key")
                  .select("exchange", "symbol",
                          _avg_close("_s", "_n", price_decimals, places).alias("avg_close_30d")))
    return out.orderBy(F.col("avg_close_30d").desc_nulls_last(), "exchange", "symbol").limit(k)


def recent_avg_close(view: DataFrame, *, anchor: str | None = None, days: int = 30,
                     k: int = 10, price_decimals: int | None = None) -> DataFrame:
    """Top-k symbols by average close since ``anchor - days`` (anchor: a
    YYYY-MM-DD text, None = current_date(), or ``'max'`` = latest gold day,
    taken by an uncorrelated scalar subquery)."""
    td = F.col("trading_date")
    if anchor == "max":
        latest = view.agg(F.max("trading_date")).scalar()
        scoped = view.where(td >= F.date_sub(latest, days))
    else:
        a = F.current_date() if anchor is None else F.lit(anchor).cast("date")
        scoped = view.where(td >= F.date_sub(a, days))
    per_symbol = (scoped.groupBy("symbol")
                        .agg(_close_sum(price_decimals).alias("_s"),
                             F.count("close_price").alias("_n")))
    out = per_symbol.select("symbol", _avg_close("_s", "_n", price_decimals).alias("avg_close_30d"))
    return out.orderBy(F.col("avg_close_30d").desc_nulls_last(), "symbol").limit(k)
