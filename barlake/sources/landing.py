"""Landed bar sources.

The reference pulls bars from a vendor HTTP API symbol by symbol; here the
bars are already landed as files or tables and are read in one distributed
scan. Two adapters map the driver's test tables onto the landing schema so
every layer runs on data whose size grows with the scale factor:

* ``raw_bars_from_tpch``: lineitem x part x supplier x nation, one bar per
  line item, with deliberately dirty values (bad dates, 'n/a' prices,
  negative / missing volume, lower-case padded exchanges, 8-char non-tickers).
* ``raw_bars_from_events``: the events stream, exercising intraday
  timestamps (truncation to the day) and zero prices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.functions.exprs import strip_upper

# Landing schema: vendor fields as text until silver parses them.
RAW_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("exchange", T.StringType()),
    T.StructField("time", T.StringType()),
    T.StructField("open", T.StringType()),
    T.StructField("high", T.StringType()),
    T.StructField("low", T.StringType()),
    T.StructField("close", T.StringType()),
    T.StructField("volume", T.StringType()),
])

# --- fixed values of the test-table mapping --------------------------------
# region key -> listing venue; region 3 yields 8-char "Brand#NN" names that are
# not tickers and must be filtered out.
NO_TICKER_REGION = 3
TICKERS = 36 ** 3
REGION_EXCHANGE = {0: "HOSE", 1: "HNX", 2: "UPCOM", 3: "OTC", 4: "HNX"}
# order-key moduli that inject dirty values
BAD_DATE_MOD = 101      # time = 'not-a-date'
SLASH_DATE_MOD = 97     # time = 'yyyy/MM/dd'
COMPACT_DATE_MOD = 89   # time = 'yyyyMMdd'
BAD_CLOSE_MOD = 103     # close = 'n/a'
NEGATIVE_VOLUME_MOD = 107   # volume = '-5'
NULL_VOLUME_MOD = 109   # volume = null
NULL_OPEN_MOD = 113     # open = null
DATE_SHIFT_MONTHS = 240  # ship dates + 20 years -> bars in 2015..2021
LISTED_MAX_BRAND = 20    # listing holds brands 1..20
# Suppliers (two integers each) that are broadcast at most.
BROADCAST_SUPPLIERS = 500_000
# ---------------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Deal the rows of an unsplittable file out to ``partitions`` tasks by their
    scan position (even, and the same when a task is run again). Off unless a
    number is given: a large scan has splits enough, and a shuffle below the
    filters would keep them from the scan."""
    return df if partitions is None else df.repartition(partitions, F.monotonically_increasing_id())


def _case(key: Column, mapping: dict) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == k, F.lit(v)) if expr is None else expr.when(key == k, F.lit(v))
    return expr


def _tpch_base(spark: SparkSession, sf_dir: str, partitions: int | None) -> DataFrame:
    li = spread(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", F.to_date("l_shipdate").alias("l_shipdate")), partitions)
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # nation is the fixed 25-row TPC-H dimension at every scale: safe to broadcast.
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    supp_region = supp.join(F.broadcast(nation), supp.s_nationkey == nation.n_nationkey)
    # part / supplier grow with the scale factor. Suppliers are broadcast only after
    # they've been counted; parts are hashed within their shuffle partitions, so line
    # items cross one shuffle and aren't sorted for it.
    few = supp.limit(BROADCAST_SUPPLIERS + 1).count() <= BROADCAST_SUPPLIERS
    return (li.join(F.broadcast(supp_region) if few else supp_region, li.l_suppkey == supp_region.s_suppkey)
              .join(part.hint("shuffle_hash"), li.l_partkey == part.p_partkey))


def ticker(key: Column) -> Column:
    """Three base-36 characters of a key: 46,656 tickers, so series grow with the
    tables until then."""
    return F.lpad(F.conv((key % TICKERS).cast("string"), 10, 36), 3, "0")


def raw_bars_from_tpch(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """One landed bar per line item (text fields, dirty on purpose) plus the
    ``ingest_seq`` struct that gives keep-last de-duplication a total order, and
    the brand that the listing is drawn from."""
    base = _tpch_base(spark, sf_dir, partitions)
    region = F.col("n_regionkey")
    okey = F.col("l_orderkey")
    price = F.col("l_extendedprice")
    qty = F.col("l_quantity")
    venue = _case(region, REGION_EXCHANGE)
    shifted = F.add_months(F.to_date(F.col("l_shipdate")), DATE_SHIFT_MONTHS)
    return base.select(
        F.when(region == NO_TICKER_REGION, F.col("p_brand")).otherwise(ticker(F.col("l_partkey"))).alias("symbol"),
        F.when(F.col("l_linenumber") == 1, F.concat(F.lit(" "), F.lower(venue), F.lit(" ")))
         .otherwise(venue).alias("exchange"),
        F.when(okey % BAD_DATE_MOD == 0, F.lit("not-a-date"))
         .when(okey % SLASH_DATE_MOD == 0, F.date_format(shifted, "yyyy/MM/dd"))
         .when(okey % COMPACT_DATE_MOD == 0, F.date_format(shifted, "yyyyMMdd"))
         .otherwise(shifted.cast("string")).alias("time"),
        F.when(okey % NULL_OPEN_MOD == 0, F.lit(None).cast("string"))
         .otherwise(price.cast("string")).alias("open"),
        (price + qty).cast("string").alias("high"),
        (price - qty).cast("string").alias("low"),
        F.when(okey % BAD_CLOSE_MOD == 0, F.lit("n/a"))
         .otherwise(price.cast("string")).alias("close"),
        F.when(okey % NEGATIVE_VOLUME_MOD == 0, F.lit("-5"))
         .when(okey % NULL_VOLUME_MOD == 0, F.lit(None).cast("string"))
         .otherwise(qty.cast("bigint").cast("string")).alias("volume"),
        F.struct(okey.alias("order_key"), F.col("l_linenumber").alias("line"),
                 F.col("l_partkey").alias("part_key"), F.col("l_suppkey").alias("supp_key"),
                 price.alias("price")).alias("ingest_seq"),
    )


def _listed_bars(spark: SparkSession, sf_dir: str, partitions: int | None) -> DataFrame:
    base = _tpch_base(spark, sf_dir, partitions)
    return base.where((F.col("n_regionkey") != NO_TICKER_REGION)
                      & (F.regexp_replace("p_brand", "Brand#", "").cast("int") <= LISTED_MAX_BRAND)).select(
        ticker(F.col("l_partkey")).alias("symbol"), _case(F.col("n_regionkey"), REGION_EXCHANGE).alias("exchange"))


def listing_from_tpch(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Symbol universe: distinct (symbol, exchange) of brands up to
    LISTED_MAX_BRAND. A distinct aggregate with map-side combine."""
    return _listed_bars(spark, sf_dir, partitions).distinct()


def raw_bars_from_events(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Events as intraday bars: user -> ticker (of every user), event type ->
    venue, ts -> bar time (kept as a timestamp), value -> close, event id ->
    volume."""
    ev = spread(read_table(spark, sf_dir, "events")
                .select("event_id", "ts", "user_id", "event_type", "value"), partitions)
    return ev.select(
        ticker(F.col("user_id")).alias("symbol"),
        F.col("event_type").alias("exchange"),
        F.col("ts").alias("time"),
        F.col("value").alias("close"),
        (F.col("event_id") % 1000).alias("volume"),
        F.struct(F.col("event_id").alias("event_id")).alias("ingest_seq"),
    )
