"""Contract rules: clean data passes, each seeded bad row fires only its
rule, strict / lenient / empty behaviour."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from barlake.operators import contracts as C

D = dt.date
TS = dt.datetime(2026, 1, 1)
SILVER_DDL = ("symbol string, trading_date date, open double, high double, low double, "
              "close_price double, volume double, exchange string, source string, "
              "ingestion_time timestamp")


def _good_rows():
    return [("AAA", D(2025, 1, 2), 1.0, 2.0, 0.5, 1.5, 0.0, "HOSE", "vnstock", TS),
            ("BBB", D(2025, 1, 2), None, 2.0, 0.5, 1.5, 10.0, "HNX", "vnstock", TS)]


def _violated(report):
    return {(r.rule, r.column) for r in report.collect() if r.violations > 0}


def test_clean_silver_passes(spark):
    df = spark.createDataFrame(_good_rows(), SILVER_DDL)
    assert _violated(C.contract_report(df, C.SILVER_CONTRACT)) == set()
    assert C.validate(df, C.SILVER_CONTRACT, strict=True) == []


@pytest.mark.parametrize("row,expected", [
    (("CCC", D(2025, 1, 3), -1.0, 2.0, 0.5, 1.5, 1.0, "HOSE", "vnstock", TS), {("non_negative", "open")}),
    (("CCC", D(2025, 1, 3), 1.0, 2.0, 0.5, 1.5, 1.5, "HOSE", "vnstock", TS), {("integer_valued", "volume")}),
    (("CCC", D(2025, 1, 3), 1.0, 2.0, 0.5, float("nan"), 1.0, "HOSE", "vnstock", TS),
     {("not_nullable", "close_price"), ("not_null", "close_price")}),
    (("CCC", D(2025, 1, 3), 1.0, 2.0, 0.5, 1.0, 1.0, None, "vnstock", TS), {("not_nullable", "exchange")}),
    (("AAA", D(2025, 1, 2), 1.0, 2.0, 0.5, 1.0, 1.0, "HNX", "vnstock", TS),
     {("pk_duplicate", "symbol,trading_date")}),
])
def test_each_rule_fires_alone(spark, row, expected):
    df = spark.createDataFrame(_good_rows() + [row], SILVER_DDL)
    assert _violated(C.contract_report(df, C.SILVER_CONTRACT)) == expected
    with pytest.raises(ValueError):
        C.validate(df, C.SILVER_CONTRACT, strict=True)
    assert len(C.validate(df, C.SILVER_CONTRACT, strict=False)) == len(expected)


def test_missing_and_mistyped_columns(spark):
    df = spark.createDataFrame(_good_rows(), SILVER_DDL).drop("source").withColumn(
        "exchange", F.lit(1))
    v = _violated(C.contract_report(df, C.SILVER_CONTRACT))
    assert ("missing_column", "source") in v and ("string_type", "exchange") in v


def test_midnight_and_integer_valued_rules(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2025, 1, 2), "3", 1.0), (dt.datetime(2025, 1, 2, 9, 15), "x", 1.5),
         (dt.datetime(2025, 1, 3), None, float("inf"))],
        "t timestamp, s string, f double")
    mid = {r.column: r.violations for r in C.midnight_report(df, ["t"]).collect()}
    iv = {r.column: r.violations for r in C.integer_valued_report(df, ["s", "f"]).collect()}
    assert mid == {"t": 1} and iv == {"s": 1, "f": 2}


def test_pk_duplicate_with_null_part(spark):
    df = spark.createDataFrame([("AAA", None), ("AAA", None)], "symbol string, trading_date date")
    assert C.duplicate_keys(df, ["symbol", "trading_date"]).first().copies == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], SILVER_DDL)
    rows = C.contract_report(df, C.SILVER_CONTRACT).collect()
    assert [r.rule for r in rows if r.violations > 0] == ["empty"]
    assert C.validate(df, C.SILVER_CONTRACT, strict=False)
    gold_empty = spark.createDataFrame([], "symbol string, trading_date date, close_price double, "
                                           "volume bigint, daily_return double, ma_5 double, ma_20 double")
    with pytest.raises(ValueError):
        C.validate(gold_empty, C.GOLD_CONTRACT, strict=False)


def test_contract_from_yaml_layout():
    spec = {"table": "t", "columns": {"a": {"type": "string", "nullable": False}, "b": {"type": "float"}},
            "primary_key": ["a"], "partition_by": ["a"],
            "quality_checks": {"not_null": ["a"], "positive_values": ["b"]}}
    c = C.Contract.from_dict(spec)
    assert c.columns[0] == C.ColumnSpec("a", "string", False) and c.columns[1].nullable
    assert c.non_negative == ("b",)


def test_load_contract_yaml(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("table: t\ncolumns:\n  a:\n    type: string\n    nullable: false\n"
                    "primary_key: [a]\nquality_checks:\n  not_null: [a]\n")
    c = C.load_contract(str(path), always_fail_empty=True)
    assert c.table == "t" and c.primary_key == ("a",) and c.always_fail_empty
