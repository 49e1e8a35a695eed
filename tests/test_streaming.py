"""availableNow stream over landed files: two landing drops, replay-safe."""
from pyspark.sql import functions as F

from barlake.operators.gold import gold_bars
from barlake.plans.lakehouse import Lakehouse
from barlake.sinks import tables
from barlake.streaming.incremental import gold_from_stream, start_replay_stream, start_silver_stream

from conftest import SF_SMALL


def test_stream_matches_batch_silver(spark, tmp_path):
    lh = Lakehouse(spark, SF_SMALL)
    raw = lh.raw
    landing = str(tmp_path / "landing")
    # two landing drops: rows split by order key parity
    raw.where(F.col("ingest_seq.order_key") % 2 == 0).write.parquet(landing + "/drop1")
    schema = spark.read.parquet(landing + "/drop1").schema
    lake = str(tmp_path / "lake")
    ckpt = str(tmp_path / "ckpt")
    q = start_silver_stream(spark, landing + "/*", schema, lake, ckpt,
                            start_date="2016-01-01", end_date="2020-12-31")
    q.awaitTermination(300)
    raw.where(F.col("ingest_seq.order_key") % 2 == 1).write.parquet(landing + "/drop2")
    q = start_silver_stream(spark, landing + "/*", schema, lake, ckpt,
                            start_date="2016-01-01", end_date="2020-12-31")
    q.awaitTermination(300)
    got = tables.read_layer(spark, lake + "/silver_stream")
    assert got.count() == lh.silver.count() == 2612
    assert tables.read_layer(spark, lake + "/bronze_stream").count() == 2631
    gold = gold_from_stream(spark, lake, price_decimals=2)
    # the second drop arrived later, whatever its keys
    arrived = lh.silver.withColumn("arrival", F.struct(F.col("ingest_seq.order_key") % 2, "ingest_seq"))
    want = gold_bars(arrived, price_decimals=2, order_by="arrival")
    assert gold.exceptAll(want).count() == 0 and gold.count() == want.count() == lh.gold.count()


def test_keys_are_counted_across_batches(spark, tmp_path):
    schema = "symbol string, exchange string, time string"
    landing, lake, ckpt = (str(tmp_path / x) for x in ("landing", "lake", "ckpt"))

    def land(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{landing}/{name}")
        start_replay_stream(spark, landing + "/*", spark.read.parquet(f"{landing}/{name}").schema, lake, ckpt,
                            horizon="10 days").awaitTermination(300)
        found = tables.read_layer(spark, lake + "/replayed_keys", schema=REPLAYS)
        return sorted((r.ingest_batch, r.symbol, r.exchange, r.trading_date.isoformat(), r.copies) for r in found.collect())

    from pyspark.sql import types as T
    REPLAYS = T._parse_datatype_string("symbol string, exchange string, copies bigint, trading_date date, ingest_batch bigint")
    assert land("a", [("AAA", "HOSE", "2025-01-02"), ("BBB", "HNX", "2025-01-02"), ("CCC", "HNX", "2025/01/03"),
                      ("CCC", " hnx", "20250103"), ("toolong", "HNX", "2025-01-02"), ("AAA", "HOSE", "nope")]) == [
        (0, "CCC", "HNX", "2025-01-03", 2)]
    second = land("b", [("AAA", "hose", "2025-01-02T09:00:00"), ("BBB", "HOSE", "2025-01-02"), ("DDD", "HNX", "2025-01-30")])
    assert [r[1:] for r in second] == [("CCC", "HNX", "2025-01-03", 2), ("AAA", "HOSE", "2025-01-02", 2)]
    # the watermark has passed 2025-01-02: its keys are no longer held
    third = land("c", [("BBB", "HNX", "2025-01-02"), ("DDD", "HNX", "2025-01-30")])
    assert [r[1:] for r in third[2:]] == [("DDD", "HNX", "2025-01-30", 2)]
