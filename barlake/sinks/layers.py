"""Bronze, silver and gold sinks: one writer with a gate per layer.

A gate names the day column's candidates, the columns a layer must have and the
order of rows in its files. A layer is a snapshot table keyed by day and venue, so
a run over some venues replaces theirs alone. A write is staged first and can be
read and checked before it's published; publishing moves no bytes.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.exprs import TEMPORAL_TYPES, col_type, first_present, strip_upper
from barlake.sinks import tables
from barlake.sinks.snapshots import SnapshotTable, Staged

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Layer:
    name: str
    day_column: str
    day_candidates: tuple[str, ...]
    required: tuple[str, ...] = ()
    sort: tuple[str, ...] = ()


# --- fixed values ------------------------------------------------------------
DAY_COLUMN_CANDIDATES = ("trading_date", "date", "time")
BRONZE = Layer("bronze", "data_date", DAY_COLUMN_CANDIDATES)
SILVER = Layer("silver", "trading_date", DAY_COLUMN_CANDIDATES, ("trading_date", "symbol"))
GOLD = Layer("gold", "trading_date", ("trading_date",), ("symbol", "trading_date", "close_price", "volume"),
             ("symbol", "exchange"))
VENUE = "venue"  # clean venue code: the key below the day
# ---------------------------------------------------------------------------


def stage(df: DataFrame, path: str, layer: Layer, *, fmt: str = "parquet",
          measures: Mapping[str, Column] | None = None, clustered: bool = False) -> Staged:
    """Write one layer's rows without publishing them (``clustered``: see
    ``SnapshotTable.stage``). The day column is the first
    candidate present; it must be temporal and is never coerced from text."""
    day = first_present(df, layer.day_candidates)
    if day is None:
        raise ValueError(f"{layer.name}: no day column among {list(layer.day_candidates)}")
    if not isinstance(col_type(df, day), TEMPORAL_TYPES):
        raise ValueError(f"{layer.name}: {day} must be a date or timestamp")
    if layer.day_column == "trading_date" and day != "trading_date":
        df = df.withColumnRenamed(day, "trading_date")
    elif layer.day_column != day:
        df = df.withColumn(layer.day_column, F.to_date(day))
    below = ()
    if "exchange" in df.columns:
        df, below = df.withColumn(VENUE, strip_upper(F.col("exchange").cast("string"))), (VENUE,)
    tables.check_sink_schema(df, layer.day_column, list(layer.required) or None)
    table = SnapshotTable(df.sparkSession, path, layer.day_column, below, fmt)
    return table.stage(df, [c for c in layer.sort if c in df.columns], measures, clustered=clustered)


def publish(staged: Staged, layer: Layer, run_date: dt.date | None, *, mode: str = "dynamic_overwrite") -> dict | None:
    """Make staged rows part of the layer and leave a row in its run manifest; None
    (and no new version) when there are none."""
    if not staged.rows:
        staged.discard()
        log.warning("%s: nothing to write", layer.name)
        return None
    path = staged.table.path
    version = staged.table.publish(staged, mode)
    result = {"rows": staged.rows, "path": path, "keys": staged.keys, "version": version}
    tables.record_run(staged.table.spark, path + "_run_manifest", layer.name, run_date, result)
    return result


def save(df: DataFrame, path: str, layer: Layer, run_date: dt.date | None, *, fmt: str = "parquet",
         mode: str = "dynamic_overwrite") -> dict | None:
    """Stage and publish one layer; None when it had no rows (known from the write
    itself, not from a pass before it)."""
    return publish(stage(df, path, layer, fmt=fmt), layer, run_date, mode=mode)


def save_bronze(df: DataFrame, path: str, run_date: dt.date | None, *, fmt: str = "parquet",
                mode: str = "dynamic_overwrite") -> dict | None:
    """Bronze keeps its own day column and adds ``data_date``; Parquet, or JSON
    with days as text."""
    return save(df, path, BRONZE, run_date, fmt=fmt, mode=mode)


def save_silver(df: DataFrame, path: str, run_date: dt.date | None, *,
                mode: str = "dynamic_overwrite") -> dict | None:
    return save(df, path, SILVER, run_date, mode=mode)


def save_gold(df: DataFrame, path: str, *, run_date: dt.date | None = None,
              mode: str = "dynamic_overwrite") -> dict | None:
    """Gold files are sorted by symbol, exchange within a day."""
    return save(df, path, GOLD, run_date, mode=mode)
