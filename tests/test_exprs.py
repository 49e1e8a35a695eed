"""Hand rows for the scalar rules (ticker, dates, numbers, volume, venue,
rounding)."""
import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.functions import exprs as X


def _one_col(spark, values, dtype=T.StringType()):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", dtype)]))


def test_ticker_rule_keeps_value(spark):
    vals = ["VNM", " vnm ", "VN30", "V-M", "", None, "AB1\n", "\tAB1"]
    df = _one_col(spark, vals)
    got = [(r.v, r.ok) for r in df.select("v", X.is_valid_ticker(F.col("v")).alias("ok")).collect()]
    assert [ok for _, ok in got] == [True, True, False, False, False, False, True, True]
    assert [v for v, _ in got] == vals


def test_lenient_day_parse(spark):
    df = _one_col(spark, ["2025-01-02", "bad", None, "2025-01-02 09:15:00", "2025-02-30"])
    got = [r.d for r in df.select(X.parse_date(df, "v").alias("d")).collect()]
    assert got == [dt.date(2025, 1, 2), None, None, dt.date(2025, 1, 2), None]
    ts = spark.createDataFrame([(dt.datetime(2025, 1, 2, 9, 15),)], "v timestamp")
    assert ts.select(X.parse_date(ts, "v").alias("d")).first().d == dt.date(2025, 1, 2)


def test_declared_layouts(spark):
    texts = ["2025/01/02", "01/02/2025", "20250102", "2025-01-02T09:15:00Z", "2025-01-02 09:15:00+07:00", "2025/1/2 23:59",
             "\u00a02025-01-02\u3000", "2025130", "20251301", "31/12/2025", "2025-01-02 noon"]
    got = [r.d for r in _one_col(spark, texts).select(X.parse_text_date(F.col("v")).alias("d")).collect()]
    assert got == [dt.date(2025, 1, 2)] * 7 + [None] * 4
    df = _one_col(spark, ["2 Jan 2025"])
    assert df.select(X.parse_text_date(F.col("v"), ["d MMM yyyy"]).alias("d")).first().d == dt.date(2025, 1, 2)


def test_lenient_numbers(spark):
    vals = ["1e3", " 1.5 ", "1,000", "1d", "1f", "0x10", "1_000", "", "NaN", "inf", "+5", ".5", "5."]
    df = _one_col(spark, vals)
    got = [r.n for r in df.select(X.parse_number(df, "v").alias("n")).collect()]
    assert got == [1000.0, 1.5, None, None, None, None, None, None, None, float("inf"), 5.0, 0.5, 5.0]


def test_volume_clamp(spark):
    df = _one_col(spark, [None, "-5", "x", "7"])
    got = [r.v for r in df.select(X.non_negative_clamp(X.parse_number(df, "v")).alias("v")).collect()]
    assert got == [0.0, 0.0, 0.0, 7.0]


def test_strip_upper_venue(spark):
    df = _one_col(spark, [" hose ", None])
    assert [r.e for r in df.select(X.strip_upper(F.col("v")).alias("e")).collect()] == ["HOSE", None]


def test_round_half_away_on_binary_value(spark):
    df = _one_col(spark, [1.005, 2.675, -1.005], T.DoubleType())
    got = [r.r for r in df.select(X.round_places(F.col("v"), 2).alias("r")).collect()]
    assert got == [1.0, 2.68, -1.0]


def test_units_mean_rounded_follows_binary_average(spark):
    # exact sum 2.01 -> average 1.005, whose double lies below the tie -> 1.0
    # (what ROUND(AVG(v), 2) over doubles gives); order does not matter
    df = spark.createDataFrame([(1.00,), (1.01,), (2.50,), (2.51,)], "v double")
    u = X.to_units(F.col("v"), 2)
    pair = df.where("v < 2").agg(X.units_mean_rounded(F.sum(u), F.count(u), 2, 2).alias("m"))
    assert pair.first().m == round(((1.00 + 1.01) / 2) * 100) / 100 == 1.0
    for parts in (1, 3):
        got = df.repartition(parts).agg(X.units_mean_rounded(F.sum(u), F.count(u), 2, 2)).first()[0]
        assert got == 1.76


def test_cluster_conf_scales_with_input():
    from barlake.session import cluster_conf
    small = cluster_conf(10 << 30)
    large = cluster_conf(100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert cluster_conf(1 << 40)["spark.sql.shuffle.partitions"] == "4096"
    # half of the scanned bytes reach the shuffle; maps x reducers stay bounded
    maps = -(-(100 << 40) // int(large["spark.sql.files.maxPartitionBytes"]))
    assert maps * int(large["spark.sql.shuffle.partitions"]) <= 2.1e9
    half = cluster_conf(1 << 40, shuffled_share=0.5)
    assert half["spark.sql.shuffle.partitions"] == "2048"
