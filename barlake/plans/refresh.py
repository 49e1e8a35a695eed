"""Incremental warehouse: what a run of the job has changed, and no more.

State lives in three snapshot tables beside gold: the known (symbol, exchange) keys,
and per month the sums and counts of every series. A refresh reads the gold months
that the run wrote, replaces those months' states and adds the keys that are new.
Dimension, monthly and yearly facts are derived from the state, which has a row
per series and month; gold of other months isn't read.
"""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.ranking import dense_rank_distinct
from barlake.operators import warehouse
from barlake.sinks.snapshots import SnapshotTable

_KEY = ("symbol", "exchange")


class WarehouseState:
    """State under ``root`` of the gold snapshot table at ``gold_path``."""

    def __init__(self, spark: SparkSession, gold_path: str, root: str, *, price_decimals: int | None = None):
        self.spark, self.price_decimals = spark, price_decimals
        self.gold = SnapshotTable(spark, gold_path)
        self.keys = SnapshotTable(spark, f"{root}/symbols")
        self.months = SnapshotTable(spark, f"{root}/months", "month_start")

    def refresh(self, days: Sequence[str]) -> None:
        """Take up gold of the months of ``days`` (the days a run has written). Running
        it again, or for more days than were written, changes nothing."""
        if not days:
            return
        year, month = map(int, max(days)[:7].split("-"))
        last = dt.date(year, month, calendar.monthrange(year, month)[1])
        view = warehouse.gold_view(self.gold.read(min(days)[:7] + "-01", last.isoformat()))
        state = self.months.stage(warehouse.monthly_state(view, price_decimals=self.price_decimals), _KEY)
        self.months.publish(state)
        found = state.read().select(*_KEY).distinct()
        known = self.keys.read()
        if known is not None:
            same = [F.col(f"found.{c}").eqNullSafe(F.col(f"known.{c}")) for c in _KEY]
            found = found.alias("found").join(known.alias("known"), same, "left_anti")
        fresh = self.keys.stage(found)
        if fresh.rows or known is None:
            self.keys.publish(fresh, "append")
        else:
            fresh.discard()

    def dim_symbol(self) -> DataFrame:
        """Dense keys over the known names: no pass over gold."""
        return dense_rank_distinct(self.keys.read(), list(_KEY), "symbol_key").select("symbol_key", *_KEY)

    def monthly(self) -> DataFrame:
        return warehouse.monthly_fact(self.months.read(), self.dim_symbol(), price_decimals=self.price_decimals)

    def yearly(self) -> DataFrame:
        return warehouse.fact_yearly(self.monthly(), exact=self.price_decimals is not None)
