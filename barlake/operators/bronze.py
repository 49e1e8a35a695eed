"""Bronze: landed bars restricted to valid tickers inside a date window.

Replaces the reference's per-symbol fetch loop with one distributed scan:
ticker rule, lenient day parse, hard inclusive window, audit columns. The
window filter is a plain range predicate on ``trading_date``, so on a table
partitioned by day it becomes partition pruning.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.functions.exprs import (
    DATE_FORMATS, WINDOW_DATE_PATTERN, col_type, evaluated_once, first_present, is_valid_ticker, parse_date, strip_upper,
)

# --- fixed values ------------------------------------------------------------
SUPPORTED_EXCHANGES = ("HOSE", "HNX")
API_SOURCE = "vnstock:VCI"
DATE_COLUMN_CANDIDATES = ("time", "date")
# ---------------------------------------------------------------------------


def normalize_window_date(value: str | dt.date | None) -> str | None:
    """Window bounds must be ``YYYY-MM-DD``; None passes through."""
    if value is None:
        return None
    if isinstance(value, dt.datetime):
        return value.date().isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if not isinstance(value, str) or not re.match(WINDOW_DATE_PATTERN, value):
        raise ValueError(f"window bound {value!r} is not written YYYY-MM-DD")
    try:
        return dt.date.fromisoformat(value).isoformat()
    except ValueError as exc:
        raise ValueError(f"window bound {value!r} is no day") from exc


def check_exchanges(exchanges: Sequence[str]) -> list[str]:
    unknown = [e for e in exchanges if e not in SUPPORTED_EXCHANGES]
    if unknown:
        raise ValueError(f"venues not served: {unknown}")
    return list(exchanges)


def _date_source_column(df: DataFrame) -> str:
    name = first_present(df, DATE_COLUMN_CANDIDATES)
    if name is None:
        raise KeyError(f"landed bars need one of the day columns {list(DATE_COLUMN_CANDIDATES)}")
    return name


def with_trading_date(raw: DataFrame, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Add ``trading_date`` = lenient day parse of the bar time (null when
    unparseable)."""
    name = _date_source_column(raw)
    day = parse_date(raw, name, formats)
    return raw.withColumn("trading_date", evaluated_once(day) if isinstance(col_type(raw, name), T.StringType) else day)


def bronze_bars(
    raw: DataFrame,
    start_date: str,
    end_date: str,
    *,
    exchanges: Sequence[str] | None = None,
    listing: DataFrame | None = None,
    run_date: dt.date | None = None,
    api_source: str = API_SOURCE,
    formats: Sequence[str] = DATE_FORMATS,
    rejects: Observation | None = None,
    stored_text: bool = False,
) -> DataFrame:
    """Valid tickers, parseable day, ``start_date <= trading_date <= end_date``.

    ``rejects`` observes, during whatever job runs the result, the landed rows
    and how many were dropped for which reason (filters then stay above the
    scan).

    ``exchanges`` restricts venues (HOSE / HNX only, else ValueError before any
    read); ``listing`` keeps only listed (symbol, exchange) pairs via a
    left-semi join. Audit columns record the window and run date.

    ``stored_text``: the landed time is a stored text column, so ranges of texts that
    can be days of the window (``may_be_inside``) are filtered first and reach the
    scan; not with ``rejects``, which count every landed row.
    """
    start = normalize_window_date(start_date)
    end = normalize_window_date(end_date)
    if (start is None) != (end is None):
        raise ValueError("bronze window needs both start_date and end_date (or neither)")
    if exchanges is not None:
        check_exchanges(exchanges)
    df = raw
    if stored_text and rejects is None and start is not None:
        df = df.where(may_be_inside(F.col(_date_source_column(df)), start, end))
    if exchanges is not None:
        df = df.where(strip_upper(F.col("exchange")).isin(list(exchanges)))
    if rejects is not None:
        df = with_trading_date(df, formats)
        df = df.withColumn("_reason", reject_reason(start, end)).observe(
            rejects, F.count(F.lit(1)).alias("landed"),
            *[F.count_if(F.col("_reason") == name).alias(name) for name in REJECT_REASONS], unreadable_sample(df)).drop("_reason")
    df = df.where(is_valid_ticker(F.col("symbol")))
    if listing is not None:
        df = universe_semi_join(df, listing)
    def inside(day: Column) -> Column:
        return day.isNotNull() if start is None else day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))

    if rejects is None and isinstance(col_type(df, _date_source_column(df)), T.StringType):
        # a generator: the parse is one expression, evaluated once for filter and column
        parsed = parse_date(df, _date_source_column(df), formats)
        df = df.withColumn("trading_date", F.explode(F.filter(F.array(parsed), inside)))
    else:
        if rejects is None:
            df = with_trading_date(df, formats)
        df = df.where(inside(F.col("trading_date")))
    run_value = F.lit(run_date.isoformat()) if run_date else F.lit(None).cast("string")
    return df.select(
        "*",
        F.lit(api_source).alias("api_source"),
        F.lit(start).cast("string").alias("api_start_date"),
        F.lit(end).cast("string").alias("api_end_date"),
        run_value.alias("api_run_date"),
    )


def may_be_inside(text: Column, start: str, end: str) -> Column:
    """Whether a text can be a day of the window, by comparisons and prefixes that a
    scan can skip row groups by. True for every text that parses to such a day:
    those that start with a blank, the year-first layouts by year (by month in
    windows of up to a year), the month-first layout by month."""
    lo, hi = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    months = [(n // 12, n % 12 + 1) for n in range(lo.year * 12 + lo.month - 1, hi.year * 12 + hi.month)]
    # blanks sort before '!' or, beyond ASCII, from U+0085 on
    found = (text < F.lit("!")) | (text >= F.lit("\u0085"))
    if len(months) > 12:
        found |= (text >= F.lit(f"{lo.year:04d}")) & (text < F.lit(f"{hi.year + 1:04d}"))
    else:
        for y, m in months:
            for prefix in (f"{y:04d}-{m:02d}", f"{y:04d}/{m:02d}", f"{y:04d}{m:02d}", *(
                    (f"{y:04d}-{m}-", f"{y:04d}/{m}/") if m < 10 else ())):
                found |= text.startswith(prefix)
    for m in sorted({m for _, m in months}):
        found |= text.startswith(f"{m:02d}/")
        if m < 10:
            found |= text.startswith(f"{m}/")
    return found


def universe_semi_join(bars: DataFrame, listing: DataFrame) -> DataFrame:
    """Keep bars whose (symbol, venue) is listed. The listing is a distinct
    ticker list; AQE broadcasts it when its measured size is small and falls
    back to a shuffle join otherwise. Venues compare after strip+upper."""
    keys = (listing.select(F.col("symbol").alias("_ls"),
                           strip_upper(F.col("exchange")).alias("_le"))
                   .where(F.col("_ls").isNotNull() & F.col("_le").isNotNull())
                   .distinct())
    cond = [(bars["symbol"] == keys["_ls"]),
            (strip_upper(bars["exchange"]) == keys["_le"])]
    return bars.join(keys, cond, "left_semi")


REJECT_REASONS = ("invalid_symbol", "invalid_date", "outside_window")


def reject_reason(start: str | None, end: str | None) -> Column:
    """Why a row with a ``trading_date`` doesn't reach bronze, else ``kept``."""
    day = F.col("trading_date")
    reason = (F.when(~is_valid_ticker(F.col("symbol")), F.lit("invalid_symbol"))
               .when(day.isNull(), F.lit("invalid_date")))
    if start is not None:
        inside = day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
        reason = reason.when(~inside, F.lit("outside_window"))
    return reason.otherwise(F.lit("kept"))


UNREADABLE_SAMPLE = 5


def unreadable_sample(df: DataFrame) -> Column:
    """An aggregate of at most UNREADABLE_SAMPLE texts no day can be read from: the
    smallest of each hash class, so that a write can observe it."""
    text = F.coalesce(F.col(_date_source_column(df)).cast("string"), F.lit("None"))
    kind = F.pmod(F.xxhash64(text), F.lit(UNREADABLE_SAMPLE))
    bad = F.col("_reason") == "invalid_date"
    return F.array(*[F.min(F.when(bad & (kind == k), text)) for k in range(UNREADABLE_SAMPLE)]).alias("unreadable")


def check_days(days: Sequence[str], start_date: str, end_date: str) -> None:
    """The range rule over the days that a write observed."""
    if days and (days[0] < start_date or days[-1] > end_date):
        raise AssertionError(f"bronze holds days {days[0]} to {days[-1]}, beyond its window")


def unreadable_days(raw: DataFrame, limit: int = 5) -> list[str]:
    """Up to ``limit`` distinct texts no day can be read from."""
    text = F.coalesce(F.col(_date_source_column(raw)).cast("string"), F.lit("None")).alias("value")
    found = with_trading_date(raw).where(F.col("trading_date").isNull()).select(text).distinct().limit(limit)
    return sorted(r["value"] for r in found.collect())


def bronze_rejects(raw: DataFrame, start_date: str, end_date: str,
                   formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Why rows did not reach bronze: one row per reason with its count
    (``invalid_symbol`` / ``invalid_date`` / ``outside_window`` / ``kept``)."""
    start = normalize_window_date(start_date)
    end = normalize_window_date(end_date)
    df = with_trading_date(raw, formats)
    return df.groupBy(reject_reason(start, end).alias("reason")).agg(F.count(F.lit(1)).alias("rows"))


def bronze_range(bronze: DataFrame) -> DataFrame:
    """One-row post-condition summary: min / max day, row count and whether
    the data lies inside the recorded window."""
    return bronze.agg(
        F.min("trading_date").alias("min_date"),
        F.max("trading_date").alias("max_date"),
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(
            F.min(F.col("trading_date") >= F.col("api_start_date").cast("date")) &
            F.min(F.col("trading_date") <= F.col("api_end_date").cast("date")),
            F.lit(True)).alias("in_window"),
    )


def assert_bronze_range(bronze: DataFrame) -> None:
    """Driver-side check of ``bronze_range`` (a single-row aggregate)."""
    row = bronze_range(bronze).first()
    if row is not None and not row["in_window"]:
        raise AssertionError(
            f"bronze holds days {row['min_date']} to {row['max_date']}, beyond its window")
