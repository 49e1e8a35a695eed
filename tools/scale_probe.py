"""Scale / skew probe for the gold build (results recorded in SCALE.md).

1. Replication: silver derived from the sf tables is replicated k times as
   new tickers (``explode`` of a k-element sequence, no join) and gold is
   rebuilt; time per replication factor.
2. Skew: copies of ONE (symbol, exchange, day) key are added until they hold
   a third of all rows (increasing arrival order); gold must keep the last
   copy, and per-task times of the stages are read from the event log to
   show whether a straggler appears.

3. Cores: ``--cores SCRATCH`` rebuilds gold from the silver stored by a
   previous run (replicated x4) on local[1], local[2], local[4] and local[8],
   each in its own process (a JVM per core count).

Usage: python tools/scale_probe.py [sf_dir] [scratch_dir]
       python tools/scale_probe.py --cores scratch_dir
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)

from pyspark.sql import functions as F  # noqa: E402

from barlake.operators import gold  # noqa: E402
from barlake.plans.lakehouse import Lakehouse  # noqa: E402
from barlake.session import build_session  # noqa: E402


def _noop(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 2)


def _stage_tasks(logdir: str, since_ms: float) -> list[dict]:
    import zstandard
    tasks: dict[int, list[float]] = {}
    names: dict[int, str] = {}
    for f in sorted(glob.glob(logdir + "/*/events*")):
        stream = zstandard.ZstdDecompressor().stream_reader(open(f, "rb")) \
            if f.endswith(".zstd") else open(f, "rb")
        for line in io.TextIOWrapper(stream, encoding="utf-8"):
            e = json.loads(line)
            if e["Event"] == "SparkListenerTaskEnd" and e["Task Info"]["Launch Time"] >= since_ms:
                ti = e["Task Info"]
                tasks.setdefault(e["Stage ID"], []).append((ti["Finish Time"] - ti["Launch Time"]) / 1000)
            elif e["Event"] == "SparkListenerStageCompleted":
                names[e["Stage Info"]["Stage ID"]] = e["Stage Info"]["Stage Name"][:40]
    out = []
    for sid, ts in sorted(tasks.items()):
        if len(ts) > 1:
            ts.sort()
            out.append({"stage": sid, "tasks": len(ts), "max_s": round(ts[-1], 3),
                        "median_s": round(ts[len(ts) // 2], 3)})
    return out


def _cores_child(silver_path: str, cores: int) -> None:
    spark = build_session(f"local[{cores}]", shuffle_partitions=max(cores, 2),
                          extra_conf={"spark.driver.memory": "16g"})
    base = spark.read.parquet(silver_path)
    rep = (base.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(3))))
               .withColumn("symbol", F.concat("symbol", F.col("_k").cast("string")))
               .withColumn("ingest_seq", F.struct("s1", "s2", "s3", "s4", "s5")).drop("_k"))
    _noop(gold.gold_bars(rep, price_decimals=2))
    print(json.dumps({"cores": cores, "silver_rows": rep.count(),
                      "gold_seconds": _noop(gold.gold_bars(rep, price_decimals=2))}))
    spark.stop()


def cores(scratch: str) -> None:
    import subprocess
    silver_path = os.path.join(scratch, "silver")
    for n in (1, 2, 4, 8):
        out = subprocess.run([sys.executable, __file__, "--cores-child", silver_path, str(n)],
                             capture_output=True, text=True, timeout=900)
        line = [ln for ln in out.stdout.splitlines() if ln.startswith("{")]
        print(line[-1] if line else out.stderr[-500:])


def main() -> None:
    if len(sys.argv) > 1 and sys.argv[1] == "--cores":
        cores(sys.argv[2])
        return
    if len(sys.argv) > 1 and sys.argv[1] == "--cores-child":
        _cores_child(sys.argv[2], int(sys.argv[3]))
        return
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="scale-", dir="/tmp")
    logdir = tempfile.mkdtemp(prefix="evlog-", dir=scratch)
    spark = build_session("local[8]", shuffle_partitions=8, extra_conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
        "spark.driver.memory": "16g"})
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    lh = Lakehouse(spark, sf_dir)
    silver_path = os.path.join(scratch, "silver")
    lh.silver.select("symbol", "exchange", "trading_date", "close_price", "volume",
                     F.col("ingest_seq.order_key").alias("s1"),
                     F.col("ingest_seq.line").alias("s2"),
                     F.col("ingest_seq.part_key").alias("s3"),
                     F.col("ingest_seq.supp_key").alias("s4"),
                     F.col("ingest_seq.price").alias("s5")).write.parquet(silver_path)
    base = spark.read.parquet(silver_path)
    n_base = base.count()
    seq = F.struct("s1", "s2", "s3", "s4", "s5")
    results: dict = {"sf_dir": sf_dir, "silver_rows": n_base, "replication": [], "skew": {}}

    for k in (1, 4, 16):
        rep = (base.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
                   .withColumn("symbol", F.concat("symbol", F.col("_k").cast("string")))
                   .withColumn("ingest_seq", seq).drop("_k"))
        _noop(gold.gold_bars(rep, price_decimals=2))  # warm-up
        secs = _noop(gold.gold_bars(rep, price_decimals=2))
        results["replication"].append({"factor": k, "silver_rows": n_base * k, "gold_seconds": secs})

    # hot group of copies: half as many extra rows as the base -> 1/3 of all rows
    hot_n = n_base // 2
    hot = (spark.range(hot_n)
                .select(F.lit("HOT").alias("symbol"), F.lit("HOSE").alias("exchange"),
                        F.lit("2018-06-01").cast("date").alias("trading_date"),
                        (F.col("id") % 1000 + 1).cast("double").alias("close_price"),
                        F.lit(1.0).alias("volume"), F.col("id").alias("s1"), F.lit(0).alias("s2"),
                        F.lit(0).cast("bigint").alias("s3"), F.lit(0).cast("bigint").alias("s4"),
                        F.lit(0.0).alias("s5")))
    skewed = base.unionByName(hot).withColumn("ingest_seq", seq)
    _noop(gold.gold_bars(skewed, price_decimals=2))  # warm-up
    since = time.time() * 1000
    secs = _noop(gold.gold_bars(skewed, price_decimals=2))
    kept = gold.gold_bars(skewed, price_decimals=2).where("symbol = 'HOT'").collect()
    spark.stop()
    results["skew"] = {
        "hot_rows": hot_n, "total_rows": n_base + hot_n, "gold_seconds": secs,
        "hot_key_rows_kept": len(kept),
        "kept_close_is_last_copy": bool(kept) and kept[0]["close_price"] == float((hot_n - 1) % 1000 + 1),
        "stages": _stage_tasks(logdir, since),
    }
    print(json.dumps(results, indent=1))


if __name__ == "__main__":
    main()
