"""Partitioned table writers (bronze / silver / gold), run manifest, views.

Writes go through one function, ``write_partitioned``:

* day-partitioned layout (``<col>=YYYY-MM-DD``); the layers of the job use file
  groups under a manifest instead (``snapshots``);
* ``REBALANCE`` on the partition column before the write: AQE splits a hot
  day into several tasks (a day holding a third of all rows does not land in
  one task) and coalesces small ones, so files stay few and sized;
* ``dynamic_overwrite`` (default) replaces only the days present in the
  batch -> idempotent re-runs; ``append`` adds files (the reference's
  behaviour with unique file names); ``overwrite`` replaces the table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.functions.exprs import TEMPORAL_TYPES
from barlake.sinks.snapshots import SnapshotTable, is_table, observed, render_dates_as_text

WRITE_MODES = ("dynamic_overwrite", "append", "overwrite")
FORMATS = ("parquet", "json")


def check_sink_schema(df: DataFrame, partition_col: str,
                      required_columns: Sequence[str] | None = None) -> None:
    """Sink gate: required columns present; partition column present and
    temporal (never coerced here)."""
    if required_columns:
        missing = set(required_columns) - set(df.columns)
        if missing:
            raise ValueError(f"the table must have the columns {sorted(missing)}")
    if partition_col not in df.columns:
        raise ValueError(f"no column {partition_col!r} to partition by")
    dtype = df.schema[partition_col].dataType
    if not isinstance(dtype, TEMPORAL_TYPES):
        raise AssertionError(f"{partition_col!r} partitions by day and can't be {dtype}")


def write_partitioned(df: DataFrame, path: str, partition_col: str, *,
                      mode: str = "dynamic_overwrite", fmt: str = "parquet",
                      required_columns: Sequence[str] | None = None,
                      sort_cols: Sequence[str] = (),
                      extra_partition_cols: Sequence[str] = ()) -> dict:
    """Write ``df`` partitioned by the DAY of ``partition_col``; returns
    ``{"rows": n, "path": path, "keys": [...]}``: the row count and the written
    partitions as tuples, both observed during the write (no extra job; keys are
    bounded by days x sub-partitions). ``extra_partition_cols`` nest below the
    day (a venue, or a stream's batch id, so that a replayed batch overwrites
    only its own sub-partitions)."""
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}")
    check_sink_schema(df, partition_col, required_columns)
    out = df.withColumn(partition_col, F.to_date(F.col(partition_col)))
    if fmt == "json":
        out = render_dates_as_text(out, keep=(partition_col,))
    keys = [partition_col, *extra_partition_cols]
    obs = Observation(f"write_{uuid.uuid4().hex}")
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"),
                      F.collect_set(F.struct(*[F.col(c).cast("string").alias(c) for c in keys])).alias("keys"))
    out = out.hint("rebalance", *keys)
    if sort_cols:
        out = out.sortWithinPartitions(partition_col, *sort_cols)
    writer = out.write.partitionBy(partition_col, *extra_partition_cols).format(fmt)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    if mode == "dynamic_overwrite":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == "overwrite":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "static")
    else:
        writer = writer.mode("append")
    writer.save(path)
    seen = observed(obs)
    return {"rows": int(seen.get("rows") or 0), "path": path,
            "keys": sorted((tuple(k) for k in seen.get("keys") or []), key=lambda k: tuple(x or "" for x in k))}


def read_layer(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    """A table's rows: those of the newest snapshot where the path has a manifest
    (which knows format and schema), else all files under it."""
    if is_table(spark, path):
        return SnapshotTable(spark, path).read()
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def partition_manifest(spark: SparkSession, path: str, partition_col: str,
                       fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Rows per written partition, read back from the table (JSON with a schema:
    without one Spark would read the layer twice)."""
    return (read_layer(spark, path, fmt, schema)
            .groupBy(partition_col).agg(F.count(F.lit(1)).alias("rows")))


def written_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Distinct data files of a table with their row counts (the written
    keys), from the ``_metadata`` column - no data columns are read."""
    return (read_layer(spark, path, fmt)
            .select(F.col("_metadata.file_path").alias("file_path"))
            .groupBy("file_path").agg(F.count(F.lit(1)).alias("rows")))


MANIFEST_SCHEMA = T.StructType([
    T.StructField("layer", T.StringType()),
    T.StructField("run_date", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("path", T.StringType()),
    T.StructField("written_at", T.TimestampType()),
])


def record_run(spark: SparkSession, manifest_path: str, layer: str,
               run_date: dt.date | None, result: dict) -> None:
    """Append one completion row per layer write to the run manifest (the
    reference's ``run_date=.../_SUCCESS`` marker, kept outside the data)."""
    now = dt.datetime.now(dt.timezone.utc)  # aware: the session zone doesn't shift it
    row = [(layer, run_date.isoformat() if run_date else None, int(result["rows"]),
            result["path"], now)]
    spark.createDataFrame(row, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(manifest_path)


def materialize(df: DataFrame, path: str, month_of: str | None = None,
                sort: Sequence[str] = (), clustered: bool = False) -> DataFrame:
    """Write a table (replace on rebuild) and return a frame reading it back:
    lineage is cut at files on shared storage. The new files are complete before
    the manifest switches to them, and a frame of the version before goes on
    reading its own; a failed rebuild changes nothing. ``month_of`` clusters the
    rows by the month of that day column, sorted by day, so that a filter on the
    day leaves most files and row groups unread; ``clustered``: they are already (see
    ``SnapshotTable.stage``)."""
    table = SnapshotTable(df.sparkSession, path, month_of)
    table.publish(table.stage(df, sort, clustered=clustered), "overwrite")
    return table.read()


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def save_view(spark: SparkSession, root: str, name: str, table: str, columns: Sequence[str], condition: str) -> None:
    """Store a view's definition under ``root``: columns and condition over the table at
    a path. It outlives the session; the newest definition of a name counts."""
    definition = SnapshotTable(spark, f"{root.rstrip('/')}/views/{name}")
    row = spark.createDataFrame([(table, list(columns), condition)], "path string, columns array<string>, condition string")
    definition.publish(definition.stage(row.coalesce(1)), "overwrite")


def open_view(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The rows of a stored view over its table's present state, registered under its
    name in this session."""
    stored = SnapshotTable(spark, f"{root.rstrip('/')}/views/{name}").read()
    if stored is None:
        raise KeyError(f"no view {name!r} under {root}")
    definition = stored.first()
    rows = read_layer(spark, definition["path"]).where(definition["condition"]).select(*definition["columns"])
    return register_view(rows, name)
