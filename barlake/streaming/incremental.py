"""Incremental landing -> bronze -> silver with Structured Streaming.

The batch job re-runs a whole window; this is the same work as a stream over
the landing folder: each micro-batch holds only newly landed files, runs the
same bronze and silver operators and the silver contract, and writes both
layers partitioned by (day, ``ingest_batch``) with dynamic partition
overwrite: new files add rows to existing days, and a replayed batch (after a
failure the checkpoint re-delivers it) rewrites only its own sub-partitions
instead of duplicating rows. The stream has layers of its own
(``bronze_stream``, ``silver_stream``): the batch job partitions by venue, so one
folder can't hold both. Keys are checked within a micro-batch; across batches
``start_replay_stream`` counts them in state under a watermark. Gold depends on
whole series, so ``gold_from_stream`` builds it from all streamed silver, which
keeps the last arrival of a key across batches.

``trigger(availableNow=True)`` processes everything landed so far in bounded
micro-batches and stops, which suits a scheduled job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barlake.functions.exprs import is_valid_ticker, strip_upper
from barlake.operators import bronze, contracts, gold, silver
from barlake.sinks import tables


def _process_batch(batch: DataFrame, batch_id: int, *, lake_root: str, start_date: str,
                   end_date: str, exchanges: Sequence[str] | None, source: str,
                   strict: bool, run_date: dt.date | None) -> None:
    if batch.isEmpty():
        return
    b = bronze.bronze_bars(batch, start_date, end_date, exchanges=exchanges, run_date=run_date)
    b = b.withColumn("data_date", F.col("trading_date"))
    tag = F.lit(int(batch_id)).cast("bigint")
    tables.write_partitioned(b.drop("trading_date").withColumn("ingest_batch", tag),
                             f"{lake_root}/bronze_stream", "data_date",
                             extra_partition_cols=["ingest_batch"])
    # the micro-batch's own rows: one ingestion timestamp per batch
    s = silver.silver_bars(b.drop("data_date"), source=source,
                           batch_ts=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
                           on_bad_date="drop")
    contracts.validate(s, contracts.SILVER_CONTRACT, strict=strict)
    tables.write_partitioned(s.withColumn("ingest_batch", tag), f"{lake_root}/silver_stream",
                             "trading_date", required_columns=["trading_date", "symbol"],
                             extra_partition_cols=["ingest_batch"])


def start_silver_stream(spark: SparkSession, landing_path: str, schema: T.StructType,
                        lake_root: str, checkpoint_location: str, *,
                        start_date: str, end_date: str, fmt: str = "parquet",
                        exchanges: Sequence[str] | None = None,
                        source: str = silver.DEFAULT_SOURCE, strict: bool = False,
                        run_date: dt.date | None = None,
                        max_files_per_trigger: int | None = None,
                        available_now: bool = True) -> StreamingQuery:
    """Start the landing -> bronze -> silver stream and return its handle.

    ``checkpoint_location`` must be on shared storage (it records which files
    each micro-batch consumed)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    landed = reader.load(landing_path)

    def handle(batch: DataFrame, batch_id: int) -> None:
        _process_batch(batch, batch_id, lake_root=lake_root.rstrip("/"), start_date=start_date,
                       end_date=end_date, exchanges=exchanges, source=source, strict=strict,
                       run_date=run_date)

    writer = (landed.writeStream.foreachBatch(handle)
                    .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()


def start_replay_stream(spark: SparkSession, landing_path: str, schema: T.StructType,
                        lake_root: str, checkpoint_location: str, *, horizon: str = "30 days",
                        fmt: str = "parquet", max_files_per_trigger: int | None = None,
                        available_now: bool = True) -> StreamingQuery:
    """Keys (symbol, venue, day) that landed more than once, whichever micro-batches
    brought their copies: written to ``replayed_keys`` with the copies so far, once
    for every batch that adds one.

    A key's count is aggregation state: summed in the map tasks, so a key of many
    copies costs a task a row, kept in the checkpoint over restarts, and dropped
    once its day is further than ``horizon`` behind the newest day. A copy that lands
    later than that isn't counted. Rows without a ticker or a readable day have no key.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    landed = bronze.with_trading_date(reader.load(landing_path)).where(
        is_valid_ticker(F.col("symbol")) & F.col("trading_date").isNotNull())
    keyed = landed.select(strip_upper(F.col("symbol")).alias("symbol"), strip_upper(F.col("exchange")).alias("exchange"),
                          F.col("trading_date").cast("timestamp").alias("day"))
    counted = (keyed.withWatermark("day", horizon).groupBy("day", "symbol", "exchange")
               .agg(F.count(F.lit(1)).alias("copies")))

    def handle(batch: DataFrame, batch_id: int) -> None:
        again = batch.where(F.col("copies") > 1).select(
            F.to_date("day").alias("trading_date"), "symbol", "exchange", "copies",
            F.lit(int(batch_id)).cast("bigint").alias("ingest_batch"))
        tables.write_partitioned(again, f"{lake_root.rstrip('/')}/replayed_keys", "trading_date",
                                 extra_partition_cols=["ingest_batch"])

    writer = (counted.writeStream.outputMode("update").foreachBatch(handle)
                     .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def gold_from_stream(spark: SparkSession, lake_root: str, *, price_decimals: int | None = None) -> DataFrame:
    """Gold over everything the stream has brought to silver so far. A later
    batch arrives later; within one, ``ingest_seq`` decides."""
    streamed = tables.read_layer(spark, f"{lake_root.rstrip('/')}/silver_stream")
    order = F.struct("ingest_batch", "ingest_seq") if "ingest_seq" in streamed.columns else F.struct("ingest_batch")
    return gold.gold_bars(streamed.withColumn("arrival", order), price_decimals=price_decimals, order_by="arrival")
