"""Declarative data contracts evaluated as Spark aggregations.

A contract lists columns (type + nullable), partition columns, primary key
and quality checks. ``contract_report`` evaluates it with:

* schema-level rules (missing columns, types) from ``df.schema`` - no job;
* every row-level counter (nulls, integer-valued, midnight, negatives, PK
  nulls) as ONE aggregate over the frame;
* PK uniqueness as one ``groupBy(pk)`` with map-side partial counts.

The report is a DataFrame ``(table, seq, rule, column, violations)`` in
evaluation order; ``enforce`` collects it (one row per rule) and raises on the
first violation when strict, warns otherwise.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.functions.exprs import (
    FRACTIONAL_TYPES, INTEGRAL_TYPES, NUMERIC_TYPES, STRING_TYPES, TEMPORAL_TYPES,
    lenient_number, nan_to_null,
)

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str | None
    nullable: bool = True


@dataclass(frozen=True)
class Contract:
    table: str
    columns: tuple[ColumnSpec, ...]
    partition_by: tuple[str, ...] = ()
    primary_key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    always_fail_empty: bool = field(default=False)

    @classmethod
    def from_dict(cls, spec: dict, *, always_fail_empty: bool = False) -> "Contract":
        """Build from the YAML layout (``columns``, ``partition_by``,
        ``primary_key``, ``quality_checks.not_null`` / ``positive_values``)."""
        cols = tuple(ColumnSpec(name, (rules or {}).get("type"), (rules or {}).get("nullable", True))
                     for name, rules in (spec.get("columns") or {}).items())
        quality = spec.get("quality_checks") or {}
        return cls(spec.get("table", "table"), cols,
                   tuple(spec.get("partition_by") or ()), tuple(spec.get("primary_key") or ()),
                   tuple(quality.get("not_null") or ()), tuple(quality.get("positive_values") or ()),
                   always_fail_empty)


def load_contract(path: str, *, always_fail_empty: bool = False) -> Contract:
    """Read a YAML contract file on the driver (PyYAML when installed)."""
    try:
        import yaml
    except ImportError as exc:  # pragma: no cover
        raise RuntimeError("PyYAML is needed to read contract files") from exc
    with open(path, encoding="utf-8") as fh:
        return Contract.from_dict(yaml.safe_load(fh), always_fail_empty=always_fail_empty)


# --- fixed values: the silver and gold contracts -----------------------------
SILVER_CONTRACT = Contract(
    table="stock_price_silver",
    columns=(
        ColumnSpec("symbol", "string", False),
        ColumnSpec("trading_date", "date", False),
        ColumnSpec("open", "float", True),
        ColumnSpec("high", "float", True),
        ColumnSpec("low", "float", True),
        ColumnSpec("close_price", "float", False),
        ColumnSpec("volume", "bigint", False),
        ColumnSpec("exchange", "string", False),
        ColumnSpec("source", "string", False),
        ColumnSpec("ingestion_time", "timestamp", False),
    ),
    partition_by=("trading_date",),
    primary_key=("symbol", "trading_date"),
    not_null=("symbol", "trading_date", "ingestion_time", "close_price", "volume"),
    non_negative=("open", "high", "low", "close_price", "volume"),
)

GOLD_CONTRACT = Contract(
    table="stock_price_daily",
    columns=(
        ColumnSpec("symbol", "string", False),
        ColumnSpec("trading_date", "date", False),
        ColumnSpec("close_price", "float", False),
        ColumnSpec("volume", "bigint", False),
        ColumnSpec("daily_return", "float", True),
        ColumnSpec("ma_5", "float", True),
        ColumnSpec("ma_20", "float", True),
    ),
    partition_by=("trading_date",),
    primary_key=("symbol", "trading_date"),
    not_null=("symbol", "trading_date", "close_price", "volume"),
    non_negative=("volume",),
    always_fail_empty=True,
)
# ---------------------------------------------------------------------------


# --- row-level predicates (each returns a Column of violation counts) --------

def _is_missing(c: Column, dtype: T.DataType) -> Column:
    return (c.isNull() | F.isnan(c)) if isinstance(dtype, FRACTIONAL_TYPES) else c.isNull()


def integer_valued_violations(c: Column, dtype: T.DataType) -> Column:
    """Rows that are not integer-valued (nulls ignored; inf / NaN text fail)."""
    if isinstance(dtype, INTEGRAL_TYPES):
        return 0
    if isinstance(dtype, FRACTIONAL_TYPES):
        v = nan_to_null(c.cast("double"))
        return F.count_if(F.coalesce(~(v % 1 == 0), F.lit(False)))
    if isinstance(dtype, T.DecimalType):
        return F.count_if(F.coalesce(c % 1 != 0, F.lit(False)))
    if isinstance(dtype, STRING_TYPES):
        n = lenient_number(c)
        return F.count_if(F.coalesce(~(n % 1 == 0), c.isNotNull()))
    return F.count_if(c.isNotNull())


def midnight_violations(c: Column, dtype: T.DataType) -> Column:
    """Timestamps carrying a time of day (a DATE is midnight by type)."""
    if isinstance(dtype, T.DateType):
        return 0
    return F.count_if(F.coalesce(F.to_date(c).cast(dtype) != c, F.lit(False)))


def negative_violations(c: Column, dtype: T.DataType) -> Column:
    """Values below zero (the 'positive_values' rule accepts 0; nulls pass)."""
    return F.count_if(F.coalesce(c < 0, F.lit(False)))


def _type_ok(kind: str, dtype: T.DataType) -> bool | None:
    if kind == "string":
        return isinstance(dtype, STRING_TYPES)
    if kind == "float":
        return isinstance(dtype, NUMERIC_TYPES)
    if kind == "timestamp":
        return isinstance(dtype, TEMPORAL_TYPES)
    if kind == "date":
        return isinstance(dtype, TEMPORAL_TYPES)
    return None


# --- report ------------------------------------------------------------------

def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """Evaluate ``contract`` on ``df``; one row per rule, in evaluation order.
    When the frame is empty only the ``empty`` rule is reported.

    Every row-level counter is part of one global aggregate, summed in the map
    tasks; the key's repeats are a second, narrow aggregate."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    rules: list[tuple[str, str, object]] = []  # (rule, column, int constant | agg Column)

    def add(rule: str, column: str, value) -> None:
        rules.append((rule, column, value))

    for spec in contract.columns:
        if spec.name not in schema:
            add("missing_column", spec.name, 1)
    for pcol in contract.partition_by:
        if pcol not in schema:
            add("missing_partition_column", pcol, 1)

    for spec in contract.columns:
        if spec.name not in schema:
            continue
        dtype = schema[spec.name]
        c = F.col(spec.name)
        if not spec.nullable:
            add("not_nullable", spec.name, F.count_if(_is_missing(c, dtype)))
        kind = spec.type
        if kind in ("int", "bigint"):
            add("integer_valued", spec.name, integer_valued_violations(c, dtype))
        elif kind == "date":
            ok = _type_ok(kind, dtype)
            add("date_type", spec.name, 0 if ok else 1)
            if ok:
                add("date_midnight", spec.name, midnight_violations(c, dtype))
        elif kind in ("string", "float", "timestamp"):
            add(f"{kind}_type", spec.name, 0 if _type_ok(kind, dtype) else 1)
        else:
            add("unknown_type", spec.name, 1)

    pk = list(contract.primary_key)
    pk_complete = bool(pk) and all(k in schema for k in pk)
    for k in pk:
        if k in schema:
            add("pk_null", k, F.count_if(_is_missing(F.col(k), schema[k])))
        else:
            add("pk_missing_column", k, 1)
    if pk_complete:
        add("pk_duplicate", ",".join(pk), None)  # filled from the per-key counts

    for k in contract.not_null:
        if k in schema:
            add("not_null", k, F.count_if(_is_missing(F.col(k), schema[k])))
    for k in contract.non_negative:
        if k in schema:
            dtype = schema[k]
            add("non_negative", k,
                negative_violations(F.col(k), dtype) if isinstance(dtype, NUMERIC_TYPES) else 1)

    measured = [(i, v) for i, (_, _, v) in enumerate(rules) if isinstance(v, Column)]
    counters = df.agg(F.count(F.lit(1)).alias("_rows"), *[v.alias(f"_v{i}") for i, v in measured])
    if pk_complete:
        # only the key crosses the shuffle
        repeats = (df.groupBy(*pk).agg(F.count(F.lit(1)).alias("_c"))
                     .agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("_dup")))
        counters = counters.withColumn("_dup", repeats.scalar())

    def value_sql(i: int, v) -> str:
        if v is None:
            return "_dup"
        if isinstance(v, Column):
            return f"_v{i}"
        return str(int(v))

    entries = [(0, "empty", "", "CASE WHEN _rows = 0 THEN 1 ELSE 0 END")]
    entries += [(i + 1, rule, column, value_sql(i, v)) for i, (rule, column, v) in enumerate(rules)]
    stack_args = ", ".join(f"{seq}, '{rule}', '{column}', CAST({value} AS BIGINT)"
                           for seq, rule, column, value in entries)
    report = counters.select(
        F.col("_rows"),
        F.expr(f"stack({len(entries)}, {stack_args}) AS (seq, rule, column, violations)"))
    report = report.where((F.col("_rows") > 0) | (F.col("rule") == "empty"))
    return report.select(F.lit(contract.table).alias("table"), F.col("seq").cast("int"),
                         "rule", "column", "violations")


def enforce(report: DataFrame, *, strict: bool = True, always_fail_empty: bool = False) -> list[dict]:
    """Collect the (small) report; strict raises on the first violated rule in
    evaluation order, lenient logs each one. An empty table always raises when
    ``always_fail_empty`` (the gold rule)."""
    rows = sorted(report.collect(), key=lambda r: r["seq"])
    violated = [r.asDict() for r in rows if r["violations"] and r["violations"] > 0]
    for r in violated:
        msg = f"{r['table']}: rule {r['rule']} failed on {r['column'] or 'table'} ({r['violations']})"
        if strict or (always_fail_empty and r["rule"] == "empty"):
            raise ValueError(msg)
        log.warning(msg)
    return violated


def validate(df: DataFrame, contract: Contract, *, strict: bool = True) -> list[dict]:
    return enforce(contract_report(df, contract), strict=strict,
                   always_fail_empty=contract.always_fail_empty)


# --- single-rule reports used on their own --------------------------------------

def _rule_report(df: DataFrame, rule: str, columns: list[str], fn) -> DataFrame:
    schema = {f.name: f.dataType for f in df.schema.fields}
    def agg(c):
        v = fn(F.col(c), schema[c])
        return (v if isinstance(v, Column) else F.lit(int(v))).cast("bigint")
    exprs = [agg(c).alias(f"_v{i}") for i, c in enumerate(columns)]
    one = df.agg(*exprs)
    args = ", ".join(f"'{c}', _v{i}" for i, c in enumerate(columns))
    return one.select(F.expr(f"stack({len(columns)}, {args}) AS (column, violations)")).select(
        F.lit(rule).alias("rule"), "column", "violations")


def integer_valued_report(df: DataFrame, columns: list[str]) -> DataFrame:
    return _rule_report(df, "integer_valued", columns, integer_valued_violations)


def midnight_report(df: DataFrame, columns: list[str]) -> DataFrame:
    return _rule_report(df, "date_midnight", columns, midnight_violations)


def non_negative_report(df: DataFrame, columns: list[str]) -> DataFrame:
    return _rule_report(df, "non_negative", columns, negative_violations)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row, with their row counts."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
              .where(F.col("copies") > 1))
