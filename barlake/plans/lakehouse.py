"""Layers and reports over one input location (M13 build order:
view -> dimensions -> facts -> checks -> BI).

Landing, bronze and silver are lazy. Gold, the dimensions and the facts are
written once per session and input as Parquet under the lake root, and
everything behind them reads those tables with pruned columns and pushed
filters, as a warehouse does.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from barlake.operators import bi, bronze, checks, gold, silver, warehouse
from barlake.session import checkpoint_dir, fingerprint, scratch_path
from barlake.sinks import tables
from barlake.sources import landing

LANDING_PARTITIONS_CONF = "spark.barlake.landing.partitions"

# --- fixed values of the test-table runs -----------------------------------
FIXTURE_WINDOW = ("2016-01-01", "2020-12-31")
FIXTURE_BATCH_TS = dt.datetime(2026, 1, 1, 0, 0, 0)
FIXTURE_RUN_DATE = dt.date(2026, 1, 1)
# landed prices are quoted in cents -> exact fixed-point averages
FIXTURE_PRICE_DECIMALS = 2
# ---------------------------------------------------------------------------

#: Stored tables by (application, input files' state, settings, name), each a frame that reads its files.
_STORED: dict[tuple, DataFrame] = {}
#: Test tables that each source reads.
_INPUTS = {"tpch": ("lineitem", "part", "supplier", "nation"), "events": ("events",)}


class Lakehouse:
    """All layers over the landed bars of ``sf_dir`` (``source`` = ``tpch``:
    line items as bars; ``events``: the event stream as intraday bars).
    ``partitions`` spreads an unsplittable input file (off by default; the session
    setting ``spark.barlake.landing.partitions`` is its default)."""

    def __init__(self, spark: SparkSession, sf_dir: str, *, source: str = "tpch",
                 window: tuple[str, str] | None = FIXTURE_WINDOW,
                 price_decimals: int | None = FIXTURE_PRICE_DECIMALS,
                 batch_ts: dt.datetime = FIXTURE_BATCH_TS,
                 run_date: dt.date | None = FIXTURE_RUN_DATE,
                 partitions: int | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.source = source
        self.window = window
        self.price_decimals = price_decimals
        self.batch_ts = batch_ts
        self.run_date = run_date
        default = spark.conf.get(LANDING_PARTITIONS_CONF, None)
        self.partitions = partitions if partitions is not None or default is None else int(default)

    @cached_property
    def _input_state(self) -> tuple:
        return tuple(fingerprint(self.spark, f"{self.sf_dir.rstrip('/')}/{t}.parquet") for t in _INPUTS[self.source])

    def _stored(self, name: str, build: Callable[[], DataFrame], clustered: Callable[[], bool] = lambda: False,
                **clustering) -> DataFrame:
        key = (self.spark.conf.get("spark.app.id", ""), self.sf_dir, self._input_state, self.source, self.window,
               self.price_decimals, self.batch_ts, self.run_date, name)
        if key not in _STORED:
            checkpoint_dir(self.spark)
            _STORED[key] = tables.materialize(build(), scratch_path(self.spark, name), clustered=clustered(), **clustering)
        return _STORED[key]

    # -- landing -------------------------------------------------------------
    @cached_property
    def raw(self) -> DataFrame:
        if self.source == "tpch":
            return landing.raw_bars_from_tpch(self.spark, self.sf_dir, self.partitions)
        if self.source == "events":
            return landing.raw_bars_from_events(self.spark, self.sf_dir, self.partitions)
        raise ValueError(f"unknown source {self.source!r}")

    @cached_property
    def listing(self) -> DataFrame:
        return landing.listing_from_tpch(self.spark, self.sf_dir, self.partitions)

    # -- medallion -----------------------------------------------------------
    @cached_property
    def bronze(self) -> DataFrame:
        start, end = self.window if self.window else (None, None)
        return bronze.bronze_bars(self.raw, start, end, run_date=self.run_date)

    @cached_property
    def silver(self) -> DataFrame:
        # bronze's typed day is taken over
        return silver.silver_bars(self.bronze, batch_ts=self.batch_ts)

    @cached_property
    def landing_table(self) -> DataFrame:
        """The landed bars as stored text, sorted by the written time."""
        return self._stored("landing", lambda: self.raw.repartitionByRange("time").sortWithinPartitions("time"))

    @cached_property
    def landed(self) -> DataFrame:
        """The landed bars as stored text, for jobs that run over them more than once."""
        return self._stored("landed", lambda: self.raw)

    @cached_property
    def silver_table(self) -> DataFrame:
        """Silver as its contract is checked: stored, clustered by month."""
        return self._stored("silver", lambda: self.silver, month_of="trading_date", sort=("symbol", "exchange"))

    @cached_property
    def gold(self) -> DataFrame:
        return gold.gold_bars(self.silver, price_decimals=self.price_decimals)

    @cached_property
    def gold_table(self) -> DataFrame:
        """Gold as the warehouse reads it: clustered by month, sorted by day."""
        return self._stored("gold", lambda: self.gold, month_of="trading_date", sort=("symbol", "exchange"))

    # -- warehouse -----------------------------------------------------------
    @cached_property
    def view(self) -> DataFrame:
        return warehouse.gold_view(self.gold_table)

    @cached_property
    def dim_date(self) -> DataFrame:
        return warehouse.dim_date(self.spark)

    @cached_property
    def dim_symbol(self) -> DataFrame:
        return self._stored("dim_symbol", lambda: warehouse.dim_symbol(self.view))

    @cached_property
    def fact(self) -> DataFrame:
        """The daily fact, clustered by month: where the symbols are broadcast, its rows
        come from gold's month files and are written as they are, without a shuffle."""
        return self._stored("fact_stock_price", lambda: warehouse.fact_daily(self.view, self.dim_symbol),
                            clustered=lambda: warehouse.is_few(self.dim_symbol), month_of="date_key", sort=("symbol_key",))

    @cached_property
    def monthly(self) -> DataFrame:
        return self._stored("fact_stock_price_monthly", lambda: warehouse.fact_monthly(
            self.fact, self.dim_date, price_decimals=self.price_decimals))

    @cached_property
    def yearly(self) -> DataFrame:
        return self._stored("fact_stock_price_yearly", lambda: warehouse.fact_yearly(
            self.monthly, exact=self.price_decimals is not None))

    @cached_property
    def broken_fact(self) -> DataFrame:
        return checks.broken_fact(self.fact)

    # -- reports -------------------------------------------------------------
    def integrity(self, fact: DataFrame | None = None) -> DataFrame:
        return checks.integrity_report(fact if fact is not None else self.fact,
                                       self.dim_date, self.dim_symbol, self.monthly, self.yearly)

    def volume_by_exchange_year(self, top_n: int | None = None) -> DataFrame:
        return bi.volume_by_exchange_year(self.fact, self.dim_date, self.dim_symbol, top_n=top_n)

    def top_symbols_30d(self) -> DataFrame:
        return bi.top_symbols_last_dates(self.fact, self.dim_date, self.dim_symbol,
                                         price_decimals=self.price_decimals)

    def recent_avg_close(self, anchor: str | None = "max") -> DataFrame:
        return bi.recent_avg_close(self.view, anchor=anchor, price_decimals=self.price_decimals)
