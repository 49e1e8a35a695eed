"""Integrity checks on a corrupted fact, and partitioned writes run twice."""
import datetime as dt

from pyspark.sql import functions as F

from barlake.operators import checks
from barlake.sinks import tables

D = dt.date


def test_orphans_count_null_keys(spark):
    fact = spark.createDataFrame([(D(2025, 1, 2), 1), (D(2025, 1, 2), None), (D(2050, 1, 1), 1),
                                  (None, 9)], "date_key date, symbol_key bigint")
    dates = spark.createDataFrame([(D(2025, 1, 2),), (D(2025, 1, 3),)], "date_key date")
    symbols = spark.createDataFrame([(1, "AAA", "HOSE")], "symbol_key bigint, symbol string, exchange string")
    assert checks.check_orphan_dates(fact, dates).first().value == 2
    assert checks.check_orphan_symbols(fact, symbols).first().value == 2
    assert checks.check_null_keys(fact).first().value == 2
    assert checks.check_dup_daily(fact.where("symbol_key = 1")).first().value == 0


def _frame(spark, days, tag):
    return spark.createDataFrame([(d, "AAA", tag) for d in days], "trading_date date, symbol string, tag string")


def test_dynamic_overwrite_is_idempotent_and_keeps_other_days(spark, tmp_lake):
    path = tmp_lake + "/t"
    tables.write_partitioned(_frame(spark, [D(2025, 1, 1), D(2025, 1, 2)], "a"), path, "trading_date")
    res = tables.write_partitioned(_frame(spark, [D(2025, 1, 2)], "b"), path, "trading_date")
    assert res["rows"] == 1
    tables.write_partitioned(_frame(spark, [D(2025, 1, 2)], "b"), path, "trading_date")
    got = sorted((r.trading_date, r.tag) for r in tables.read_layer(spark, path).collect())
    assert got == [(D(2025, 1, 1), "a"), (D(2025, 1, 2), "b")]


def test_append_doubles(spark, tmp_lake):
    path = tmp_lake + "/a"
    df = _frame(spark, [D(2025, 1, 1)], "a")
    tables.write_partitioned(df, path, "trading_date", mode="append")
    tables.write_partitioned(df, path, "trading_date", mode="append")
    assert tables.read_layer(spark, path).count() == 2
    assert tables.written_files(spark, path).agg(F.sum("rows")).first()[0] == 2


def test_json_bronze_renders_dates_as_text(spark, tmp_lake):
    path = tmp_lake + "/j"
    df = spark.createDataFrame([(D(2025, 1, 1), D(2025, 1, 1), None)],
                               "data_date date, trading_date date, open string")
    tables.write_partitioned(df, path, "data_date", fmt="json")
    back = tables.read_layer(spark, path, "json").first()
    assert back.trading_date == "2025-01-01" and "open" in back


def test_sink_gate(spark, tmp_lake):
    import pytest
    df = spark.createDataFrame([("2025-01-01", "AAA")], "trading_date string, symbol string")
    with pytest.raises(AssertionError):
        tables.write_partitioned(df, tmp_lake + "/x", "trading_date")
    with pytest.raises(ValueError):
        tables.write_partitioned(df, tmp_lake + "/x", "nope")
