"""What a large run costs: line items cross one shuffle unsorted, plain texts skip the
general patterns, the job's runs share one landing, silver's and the fact's writes aren't dealt anew."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from barlake.functions import exprs
from barlake.operators import warehouse
from barlake.plans import lakehouse
from barlake.sinks.snapshots import SnapshotTable
from barlake.sources import landing


def _tables(spark, root):
    """Line items with a missing and a repeated part, a repeated supplier, null keys."""
    day = dt.datetime(1997, 3, 5)
    items = [(1, 10, 1, 1), (2, 11, 2, 1), (3, 99, 1, 1), (4, 10, 9, 2), (None, None, 1, 1), (5, 12, None, 1), (6, 12, 3, 2)]
    spark.createDataFrame([(*k, 3.0, 10.5, day) for k in items],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp"
                          ).write.parquet(f"{root}/lineitem.parquet")
    spark.createDataFrame([(10, "Brand#11"), (11, "Brand#12"), (12, "Brand#13"), (12, "Brand#14"), (None, "x")],
                          "p_partkey long, p_brand string").write.parquet(f"{root}/part.parquet")
    spark.createDataFrame([(1, 0), (2, 1), (2, 1), (3, 2), (None, 0)], "s_suppkey long, s_nationkey long").write.parquet(f"{root}/supplier.parquet")
    spark.createDataFrame([(0, 0), (1, 1), (2, 3)], "n_nationkey long, n_regionkey long").write.parquet(f"{root}/nation.parquet")
    return root


@pytest.mark.parametrize("most", [500_000, 2])
def test_line_items_cross_one_shuffle(spark, tmp_lake, monkeypatch, most):
    monkeypatch.setattr(landing, "BROADCAST_SUPPLIERS", most)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with large parts
    try:
        raw = landing.raw_bars_from_tpch(spark, _tables(spark, tmp_lake))
        got = sorted((r.ingest_seq.order_key, r.symbol, r.exchange.strip(), r.time) for r in raw.collect())
        plan = raw._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [(1, "00A", "hose", "2017-03-05"), (2, "00B", "hnx", "2017-03-05"), (2, "00B", "hnx", "2017-03-05"),
                   (6, "Brand#13", "OTC", "2017-03-05"), (6, "Brand#14", "OTC", "2017-03-05")]
    assert "ShuffledHashJoin" in plan and ("SortMergeJoin" in plan) == (most == 2)


TEXTS = ["1", "-5", "+5", "1.", "1.25", ".5", "-.5", "1e3", " 7 ", "7\n", "\n7", "7\x01", "1d", "1f", "0x1", "inf", "-Infinity", " inf", "nan", "--1", "1-1", "",
         " ", "1,0", "\u0661", "1.2.3", ".", "-", "n/a", None, "2024-01-02", "2024-01-02\n", "\n2024-01-02", "2024-1-2", "2024-13-01", "2024-02-30", "2024/01/02",
         "20240102", "\u00a02024-01-02", "2024-01-2\x01", "0000-01-01", "AB1", "ab1", " ab1 ", "AB1\n", "\u00a0AB1", "a\u00e91", "\u01c6ab", "A B", "ABCD", "\x00AB"]


def test_plain_texts_give_what_the_patterns_give(spark):
    """Against the general forms alone."""
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string").repartition(1)
    t, upper = F.col("t"), F.upper(exprs.strip(F.col("t")))
    pattern, written = exprs._any_layout()
    pairs = {"number": (exprs.lenient_number(t), exprs.nan_to_null(F.regexp_extract(t, exprs.NUMBER_PATTERN, 1).try_cast("double"))),
             "day": (exprs.parse_text_date(t), F.regexp_replace(exprs.strip(t), F.lit(pattern), F.lit(written)).try_cast("date")),
             "code": (exprs.strip_upper(t), upper),
             "ticker": (exprs.is_valid_ticker(t), F.coalesce(upper.rlike(exprs.TICKER_PATTERN), F.lit(False)))}
    for name, (now, general) in pairs.items():
        wrong = df.where(~now.eqNullSafe(general)).collect()
        assert not wrong, (name, wrong)
        assert df.where(general.cast("string").isNotNull()).count() > 3
    # the short match stands before the general one
    assert str(exprs.parse_text_date(t)).count("CASE WHEN rlike") == str(exprs.lenient_number(t)).count("CASE WHEN rlike") == 1


def test_runs_share_one_landing(spark, tmp_lake, monkeypatch):
    read, run = [], entry.run_medallion

    def watched(session, raw, cfg, **more):
        read.append(raw.inputFiles())
        return run(session, raw, cfg, **more)

    monkeypatch.setattr(entry, "run_medallion", watched)
    rows = entry.queries()["gold_incremental"](spark, _tables(spark, tmp_lake)).collect()
    assert sorted((r.symbol, r.exchange, r.trading_date.isoformat()) for r in rows) == [
        ("00A", "HOSE", "2017-03-05"), ("00B", "HNX", "2017-03-05")]
    assert len(read) == 3 and all("/landed-" in f for files in read for f in files) and read[0] == read[1] == read[2] != []


def test_a_clustered_write_has_no_shuffle(spark, tmp_lake):
    days = [(f"S{i % 7}", dt.date(2024, 1 + i % 5, 1 + i % 28), "HNX", i) for i in range(400)] + [("T", None, None, -1)]
    first = SnapshotTable(spark, tmp_lake + "/a", "day", ("venue",))
    one = first.stage(spark.createDataFrame(days, "symbol string, day date, venue string, n long"), ["symbol"])
    second = SnapshotTable(spark, tmp_lake + "/b", "day", ("venue",))
    two = second.stage(one.read().withColumn("n", F.col("n") * 2), ["symbol"], clustered=True)
    assert two.rows == one.rows == 401 and two.keys == one.keys
    assert sorted(map(str, two.read().collect())) == sorted(map(str, one.read().withColumn("n", F.col("n") * 2).collect()))
    # a file a month, as in the group it reads, and compressed
    assert len(two.read().inputFiles()) == len(one.read().inputFiles()) == 6
    assert all(f.endswith(".zstd.parquet") for f in two.read().inputFiles())


@pytest.mark.parametrize("most", [500_000, 1])
def test_the_fact_takes_over_golds_months(spark, tmp_lake, monkeypatch, most):
    staged, stage = [], SnapshotTable.stage

    def watched(table, df, sort=(), measures=None, *, clustered=False):
        if table.day == "date_key":
            staged.append(clustered)
        return stage(table, df, sort, measures, clustered=clustered)

    monkeypatch.setattr(SnapshotTable, "stage", watched)
    monkeypatch.setattr(warehouse, "BROADCAST_SYMBOLS", most)
    monkeypatch.setattr(lakehouse, "_STORED", {})
    lh = lakehouse.Lakehouse(spark, _tables(spark, tmp_lake))
    rows = sorted(tuple(r) for r in lh.fact.select("date_key", "symbol_key", "close_price", "volume").collect())
    day = dt.date(2017, 3, 5)
    assert rows == [(day, 1, 10.5, 3), (day, 2, 10.5, 3)]
    # joined by shuffle, the rows have lost gold's months
    assert staged == [most > 1]
    assert len(lh.fact.inputFiles()) == 1
