"""Lenient number parsing vs pandas ``to_numeric(errors="coerce")`` on
generated strings (digits, signs, dots, exponents, blanks, suffix letters,
infinity words)."""
import math

import pandas as pd
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from barlake.functions import exprs as X

PIECES = st.sampled_from(["0", "1", "7", "42", "3.", ".5", "+", "-", "e", "E", "e-", "e+",
                          " ", "\t", "inf", "Infinity", "d", "f", "x", "0x1", ",", "_", "nan"])
TEXT = st.lists(PIECES, min_size=1, max_size=5).map("".join)


def _pandas(values):
    out = pd.to_numeric(pd.Series(values, dtype=object), errors="coerce")
    return [None if (v is None or (isinstance(v, float) and math.isnan(v))) else float(v)
            for v in out.tolist()]


@settings(max_examples=5, deadline=None, phases=[Phase.generate],
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TEXT, min_size=50, max_size=120))
def test_parse_number_matches_pandas(spark, values):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", T.StringType())]))
    got = [r.n for r in df.select(X.parse_number(df, "v").alias("n")).collect()]
    expected = _pandas(values)

    def same(g, e):
        # same accept/reject decision; values equal up to pandas' fast
        # (not always correctly rounded) string parser, i.e. within 1e-15
        if g is None or e is None or math.isinf(g) or math.isinf(e):
            return g == e
        return math.isclose(g, e, rel_tol=1e-15, abs_tol=0.0)
    mismatches = [(v, g, e) for v, g, e in zip(values, got, expected) if not same(g, e)]
    assert not mismatches, mismatches[:10]


def _ticker_oracle(s):
    import re
    if not s:
        return False
    return re.fullmatch(r"[A-Z0-9]{3}", s.strip().upper()) is not None


@settings(max_examples=4, deadline=None, phases=[Phase.generate],
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aZ09x-_. \t\n\r", max_size=6)),
                min_size=50, max_size=120))
def test_ticker_rule_matches_python_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", T.StringType())]))
    got = [r.ok for r in df.select(X.is_valid_ticker(df["v"]).alias("ok")).collect()]
    expected = [_ticker_oracle(v) for v in values]
    mismatches = [(v, g, e) for v, g, e in zip(values, got, expected) if g != e]
    assert not mismatches, mismatches[:10]
