"""End-to-end jobs.

``run_medallion`` (M1): landed bars -> bronze table -> silver table (contract
gate) -> gold table (contract gate). Each layer is staged as a file group, checked
as staged and published by its manifest, so bytes are written once, re-runs
replace the days and venues they bring, and every layer boundary cuts lineage at
files on shared storage: a lost executor only recomputes from the last layer.

``build_warehouse`` (M13): gold table -> view -> dimensions -> facts ->
integrity report -> BI reports, with the dimension and fact tables written
(replaced on rebuild) under the lake root.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barlake.functions.exprs import strip_upper
from barlake.operators import bi, bronze, checks, contracts, gold, silver, warehouse
from barlake.operators.tails import Tails
from barlake.sinks import layers, tables
from barlake.sinks.snapshots import SnapshotTable, Staged, observed

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class MedallionConfig:
    lake_root: str
    start_date: str
    end_date: str
    exchanges: Sequence[str] | None = None
    run_date: dt.date | None = None
    source: str = silver.DEFAULT_SOURCE
    strict: bool = True
    write_mode: str = "dynamic_overwrite"
    bronze_format: str = "parquet"  # or "json"
    price_decimals: int | None = None
    #: Landed time is a stored text column: only row groups that can hold days of the
    #: window are read. What else has landed then isn't counted (no reject counts).
    prune_landing: bool = False

    def path(self, layer: str) -> str:
        return f"{self.lake_root.rstrip('/')}/{layer}"


def run_medallion(spark: SparkSession, raw: DataFrame, cfg: MedallionConfig, *,
                  listing: DataFrame | None = None,
                  batch_ts: dt.datetime | None = None) -> dict:
    """Run bronze -> silver -> gold for one window; returns per-layer stats.

    A layer is built from exactly the rows this run wrote below it, so days left
    by earlier runs don't come back, and a run over some venues leaves the others'
    rows alone. Counts, day range, samples of unreadable days and written keys are
    observed by the writes: no layer is scanned for them. Gold takes each series'
    preceding rows from its tails (``operators.tails``), so a short window gets the
    same values as a full rebuild. Rows of days after the window aren't rewritten.

    Without bars to keep the status is ``no_rows``, without gold rows
    ``no_gold``; a contract violation raises when ``cfg.strict``, before the layer's
    new rows are published.
    """
    run_date = cfg.run_date or dt.date.today()
    stats: dict = {"run_date": run_date.isoformat(), "status": "no_rows"}

    # bronze
    rejects = None if cfg.prune_landing else Observation(f"rejects_{uuid.uuid4().hex}")
    b = bronze.bronze_bars(raw, cfg.start_date, cfg.end_date, exchanges=cfg.exchanges, listing=listing,
                           run_date=run_date, rejects=rejects, stored_text=cfg.prune_landing)
    staged = layers.stage(b, cfg.path("bronze"), layers.BRONZE, fmt=cfg.bronze_format)
    if rejects is not None:
        stats |= _rejects(raw, cfg, observed(rejects))
    bronze.check_days(staged.days(), cfg.start_date, cfg.end_date)
    if layers.publish(staged, layers.BRONZE, run_date, mode=cfg.write_mode) is None:
        return stats
    stats["bronze_rows"], stats["bronze_keys"] = staged.rows, staged.keys
    stored = staged.read().withColumn("trading_date", F.col("data_date")).drop("data_date", layers.VENUE)

    # silver
    usable = F.count_if(F.col("close_price").isNotNull() & F.col("volume").isNotNull())
    staged = layers.stage(silver.silver_bars(stored, source=cfg.source, batch_ts=batch_ts), cfg.path("silver"),
                          layers.SILVER, measures={"usable": usable},
                          clustered=True)  # bronze's files are
    s = staged.read()
    stats["silver_violations"] = _validated(staged, contracts.SILVER_CONTRACT, cfg.strict)
    layers.publish(staged, layers.SILVER, run_date, mode=cfg.write_mode)
    stats["silver_rows"], stats["silver_keys"] = staged.rows, staged.keys
    stats["silver_dropped"] = stats["bronze_rows"] - stats["silver_rows"]
    usable_rows = staged.measures["usable"] or 0
    stats["gold_null_dropped"] = stats["silver_rows"] - usable_rows
    if not usable_rows:
        stats["gold_violations"], stats["status"] = [], "no_gold"
        return stats

    # gold
    table = SnapshotTable(spark, cfg.path("gold"), layers.GOLD.day_column, (layers.VENUE,))
    before, tails = table.current(), Tails(table)
    history = tails.history(dt.date.fromisoformat(cfg.start_date))
    g = gold.gold_bars(s, price_decimals=cfg.price_decimals, history=history, since=cfg.start_date)
    staged = layers.stage(g, cfg.path("gold"), layers.GOLD)
    stats["gold_violations"] = _validated(staged, contracts.GOLD_CONTRACT, cfg.strict)
    layers.publish(staged, layers.GOLD, run_date, mode=cfg.write_mode)
    tails.update(staged.days(), before and before.version)
    stats["gold_rows"], stats["gold_keys"] = staged.rows, staged.keys
    stats["duplicates_removed"] = usable_rows - staged.rows
    stats["status"] = "ok"
    return stats


def _rejects(raw: DataFrame, cfg: MedallionConfig, seen: dict) -> dict:
    """Landed and rejected rows, and some of the texts without a readable day."""
    if not seen:  # an empty result leaves the plan without its observation: count by itself
        served = raw if cfg.exchanges is None else raw.where(strip_upper(F.col("exchange")).isin(list(cfg.exchanges)))
        seen = {r["reason"]: r["rows"] for r in bronze.bronze_rejects(served, cfg.start_date, cfg.end_date).collect()}
        seen["landed"] = sum(seen.values())
        if seen.get("invalid_date"):
            seen["unreadable"] = bronze.unreadable_days(served)
    stats: dict = {"landed_rows": seen.get("landed") or 0,
                   "rejected": {name: seen.get(name) or 0 for name in bronze.REJECT_REASONS}}
    if stats["rejected"]["invalid_date"]:
        stats["unreadable_days"] = sorted(x for x in seen.get("unreadable") or [] if x is not None)
        log.warning("bronze: %s rows without a readable day, such as %s",
                    stats["rejected"]["invalid_date"], stats["unreadable_days"])
    return stats


def _validated(staged: Staged, contract: contracts.Contract, strict: bool) -> list[dict]:
    """The contract's violations in staged rows; rows that it refuses are discarded,
    and the layer stays as it was."""
    try:
        return contracts.validate(staged.read(), contract, strict=strict)
    except ValueError:
        staged.discard()
        raise


GOLD_VIEW = "v_gold_stock_price_daily"


def build_warehouse(spark: SparkSession, gold_table: DataFrame | str, warehouse_root: str, *,
                    price_decimals: int | None = None) -> dict[str, DataFrame]:
    """Dimensions and facts written under ``warehouse_root`` (replaced on
    rebuild), plus the integrity and BI report frames over them. With the path of
    a gold table its view is stored as well: later sessions open it by name
    (``tables.open_view``)."""
    root = warehouse_root.rstrip("/")
    if isinstance(gold_table, str):
        venues = ", ".join(f"'{v}'" for v in warehouse.GOLD_VIEW_EXCHANGES)
        tables.save_view(spark, root, GOLD_VIEW, gold_table, warehouse.GOLD_VIEW_COLUMNS, f"exchange IN ({venues})")
        view = tables.open_view(spark, root, GOLD_VIEW)
    else:
        view = tables.register_view(warehouse.gold_view(gold_table), GOLD_VIEW)
    dates = tables.materialize(warehouse.dim_date(spark), f"{root}/dim_date")
    symbols = tables.materialize(warehouse.dim_symbol(view), f"{root}/dim_symbol")
    fact = tables.materialize(warehouse.fact_daily(view, symbols), f"{root}/fact_stock_price",
                              month_of="date_key", sort=("symbol_key",))
    monthly = tables.materialize(warehouse.fact_monthly(fact, dates, price_decimals=price_decimals),
                                 f"{root}/fact_stock_price_monthly")
    yearly = tables.materialize(warehouse.fact_yearly(monthly, exact=price_decimals is not None),
                                f"{root}/fact_stock_price_yearly")
    return {
        "view": view, "dim_date": dates, "dim_symbol": symbols, "fact": fact,
        "monthly": monthly, "yearly": yearly,
        "integrity": checks.integrity_report(fact, dates, symbols, monthly, yearly),
        "volume_by_exchange_year": bi.volume_by_exchange_year(fact, dates, symbols),
        "top_symbols_30d": bi.top_symbols_last_dates(fact, dates, symbols,
                                                     price_decimals=price_decimals),
    }
