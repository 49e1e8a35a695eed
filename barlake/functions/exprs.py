"""Column-expression helpers shared by every layer.

All helpers return Catalyst expressions (no Python UDFs), so they stay inside
whole-stage codegen and run on the executors.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values that must match the pipeline being reproduced ----------
# Ticker rule: exactly three upper-case letters or digits after strip+upper.
TICKER_PATTERN = r"\A[A-Z0-9]{3}\z"
# Lenient number text: optional sign, digits with optional fraction (or a
# bare fraction) and optional exponent, with surrounding blanks allowed; or a
# signed infinity word with no blanks. The group is the number without blanks.
NUMBER_PATTERN = (
    r"(?i)\A(?:\s*(?=[+-]?[\d.]))?"
    r"([+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?(?=\s*\z)|inf(?:inity)?(?=\z)))\s*\z"
)
# A time of day with an optional zone may follow a day; the day is the written
# one, whatever the zone.
_TIME_OF_DAY = r"([ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?( ?(Z|UTC|[+-]\d{2}:?\d{2}))?)?"
# Declared day layouts: text pattern -> the groups that hold year, month, day.
DATE_LAYOUTS = {
    r"\A(\d{4})-(\d{1,2})-(\d{1,2})" + _TIME_OF_DAY + r"\z": (1, 2, 3),
    r"\A(\d{4})/(\d{1,2})/(\d{1,2})" + _TIME_OF_DAY + r"\z": (1, 2, 3),
    r"\A(\d{4})(\d{2})(\d{2})\z": (1, 2, 3),
    r"\A(\d{1,2})/(\d{1,2})/(\d{4})" + _TIME_OF_DAY + r"\z": (3, 1, 2),
}
# Texts that need none of the above, as most are: one short match each.
_PLAIN_NUMBER = r"\A[+-]?[0-9]+(?:\.[0-9]*)?\z"
_PLAIN_DAY = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_PLAIN_CODE = r"\A[!-`{-~]*\z"  # ASCII without blanks and lower case
# Further ``to_timestamp`` formats tried when no layout fits (``formats=``).
DATE_FORMATS: tuple[str, ...] = ()
# Window-bound text format accepted by the bronze reader.
WINDOW_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
# ---------------------------------------------------------------------------

# Blanks removed from both ends by strip(): those of Unicode
_BLANKS = (" \t\n\r\f\u000b\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
           "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")

NUMERIC_TYPES = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType,
    T.FloatType, T.DoubleType, T.DecimalType,
)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL_TYPES = (T.FloatType, T.DoubleType)
TEMPORAL_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)
STRING_TYPES = (T.StringType, T.VarcharType, T.CharType)


def first_present(df: DataFrame, names: Sequence[str]) -> str | None:
    """The first of ``names`` that is a column of ``df``."""
    return next((n for n in names if n in df.columns), None)


def col_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def strip(c: Column) -> Column:
    """Trim blanks of any kind on both ends; Spark's ``trim`` removes spaces only."""
    return F.btrim(c, F.lit(_BLANKS))


def strip_upper(c: Column) -> Column:
    """Stripped and upper-cased; a text that already is stays as it is."""
    return F.when(c.rlike(_PLAIN_CODE), c).otherwise(F.upper(strip(c)))


def is_valid_ticker(c: Column) -> Column:
    """True when the stripped, upper-cased value is a 3-char alphanumeric
    ticker; null / empty give False. The value itself is not modified."""
    return F.coalesce(c.rlike(TICKER_PATTERN) | F.upper(strip(c)).rlike(TICKER_PATTERN), F.lit(False))


def nan_to_null(c: Column) -> Column:
    """NaN never enters a layer: Spark treats NaN as a value (NaN > 0 is true,
    one NaN poisons an average), so it is mapped to null right away."""
    return F.nanvl(c, F.lit(None).cast("double"))


def parse_number(df: DataFrame, name: str) -> Column:
    """Lenient text-to-double: unparseable -> null (never an ANSI error).

    Numeric columns only lose NaN. Only what ``NUMBER_PATTERN`` matches is cast,
    because Spark's cast also accepts forms such as ``'1d'`` or ``'1f'``.
    """
    dtype = col_type(df, name)
    c = F.col(name)
    if isinstance(dtype, NUMERIC_TYPES):
        return nan_to_null(c.cast("double"))
    if isinstance(dtype, T.BooleanType):
        return c.cast("double")
    return lenient_number(c)


def lenient_number(c: Column) -> Column:
    """Number of a text of ``NUMBER_PATTERN``, else null (no match gives an empty
    text). Plain digits, a subset of the pattern, are cast as they are."""
    text = c.cast("string")
    return nan_to_null(F.when(text.rlike(_PLAIN_NUMBER), text.try_cast("double"))
                       .otherwise(F.regexp_extract(text, NUMBER_PATTERN, 1).try_cast("double")))


def _any_layout() -> tuple[str, str]:
    """One pattern of all declared layouts, and of any other text, with the
    replacement that writes year-month-day: groups of layouts that don't match
    are empty, so another text becomes ``--``."""
    alternatives, written, before = [], ("", "", ""), 0
    for pattern, groups in DATE_LAYOUTS.items():
        alternatives.append(pattern.removeprefix(r"\A").removesuffix(r"\z"))
        written = tuple(f"{w}${before + g}" for w, g in zip(written, groups))
        before += re.compile(alternatives[-1]).groups
    return r"(?s)\A(?:" + "|".join(alternatives) + r"|.*)\z", "-".join(written)


def parse_text_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Day of a text date/time, null when unparseable. All declared layouts are one
    match that writes the day as year-month-day, read by one cast; a text that is
    written so is cast as it is. ``formats`` are tried in order for other texts
    (``coalesce`` is lazy)."""
    stripped = strip(text)
    pattern, written = _any_layout()
    day = F.when(text.rlike(_PLAIN_DAY), text.try_cast("date")).otherwise(
        F.regexp_replace(stripped, F.lit(pattern), F.lit(written)).try_cast("date"))
    others = [F.to_date(F.try_to_timestamp(stripped, F.lit(fmt))) for fmt in formats]
    return F.coalesce(day, *others) if others else day


def evaluated_once(c: Column) -> Column:
    """A generator of the one value of ``c``: what reads the column doesn't get the
    expression copied into it by the optimizer."""
    return F.explode(F.array(c))


def parse_date(df: DataFrame, name: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Lenient day parse of a column of any type: temporal values are
    truncated to midnight, text is parsed, anything unparseable is null."""
    dtype = col_type(df, name)
    c = F.col(name)
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    return parse_text_date(c.cast("string"), formats)


def round_places(x: Column, places: int) -> Column:
    """Round half away from zero on the binary value: ``round(x*10^n)/10^n``.

    ``F.round(x, n)`` rounds the shortest decimal text of the double instead
    (1.005 -> 1.01) while SQL engines that work on the binary value give 1.0.
    """
    scale = float(10 ** places)
    return F.round(x * F.lit(scale)) / F.lit(scale)


def to_units(x: Column, decimals: int, *, exact: bool = False) -> Column:
    """Fixed-point view of a double: integer count of ``10^-decimals``.
    ``exact`` fails on a value that has more decimals, or is infinite, instead
    of rounding it."""
    scaled = x * F.lit(float(10 ** decimals))
    units = F.round(scaled)
    if exact:
        fits = (F.abs(units) < F.lit(9e15)) & (F.abs(scaled - units) <= F.lit(1e-9) * F.greatest(F.abs(units), F.lit(1.0)))
        units = F.when(x.isNull() | fits, units).otherwise(F.raise_error(F.concat(
            F.lit(f"price does not fit {decimals} decimals: "), x.cast("string"))).cast("double"))
    return units.cast("bigint")


def units_mean_rounded(sum_units: Column, count: Column, unit_decimals: int,
                       places: int) -> Column:
    """``ROUND(AVG(x), places)`` from an exact integer sum of ``x`` in
    ``10^-unit_decimals`` units.

    The sum is exact and order-independent; the rest repeats the double
    operations of ``round(avg * 10^n) / 10^n`` on the correctly rounded sum,
    so decimal ties (1.005) round the way the binary average does (1.0), as in
    SQL engines working on doubles. Each step is one IEEE operation: the same
    bits in every engine.
    """
    mean = sum_units / F.lit(float(10 ** unit_decimals)) / F.nullif(count, F.lit(0))
    return round_places(mean, places)


def non_negative_clamp(x: Column) -> Column:
    """null -> 0 and negative -> 0 (volume rule)."""
    return F.greatest(F.coalesce(x, F.lit(0.0)), F.lit(0.0))
