"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.session import checkpoint_dir, scratch_path

#: Rows that one Arrow batch holds at most. A batch of documents stays some
#: megabytes even where the texts are long.
BATCH_ROWS = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def typed(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, cast to the given types; a missing one is null.

    Extra columns are left behind, so none of them can clash with the names
    that an operator derives.
    """
    have = set(df.columns)
    return df.select(*[
        (F.col(f"`{name}`").cast(kind) if name in have else F.lit(None).cast(kind)).alias(name)
        for name, kind in columns.items()])


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of the Arrow batches sent to Python workers."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


#: A key is hot where it holds more than one in HOT_KEYS of the rows, so fewer than
#: HOT_KEYS keys are; its rows are dealt out over SALTS tasks.
HOT_KEYS, SALTS = 1000, 64


def looked_up(left: DataFrame, right: DataFrame, key: str, count: str, how: str = "left") -> DataFrame:
    """Joins ``right``'s columns to ``left`` on ``key``; column ``count`` of ``right``
    says how many rows of ``left`` hold the key, and isn't returned.

    Hot keys are named in a broadcast of fewer than HOT_KEYS rows, their rows of
    ``left`` are dealt out by position and those of ``right`` repeated, so that no
    task joins more than a SALTS-th of a hot key. ``left`` must read files or
    shuffled rows of a fixed order, as positions must be the same when a task
    runs again. A null key joins nothing."""
    total = right.agg(F.sum(count)).first()[0] or 0
    is_hot = F.col(count) * HOT_KEYS > F.lit(total)
    hot = right.where(is_hot).select(F.col(key).alias("_hot")).distinct()
    dealt = (left.withColumn("_spot", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
             .join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
             .withColumn("_salt", F.when(F.col("_hot").isNotNull(), F.col("_spot")).otherwise(0)).drop("_spot", "_hot"))
    repeated = right.withColumn("_salt", F.explode(
        F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop(count)
    return dealt.join(repeated, [key, "_salt"], how).drop("_salt")


def smallest_hashes(df: DataFrame, group: str, hashed: str, limit: int) -> DataFrame:
    """Of each group the ``limit`` rows with the smallest distinct 64-bit hashes, taken
    from the share of the hash range that should hold twice as many: so the ranking
    gets about 2 x limit rows a group at any scale. Groups are few (they're classes
    to learn), and copies of a row count once."""
    sizes = df.groupBy(group).agg(F.approx_count_distinct(hashed).alias("_distinct"))
    low = (F.col(hashed).cast("double") / 2.0 ** 64 + 0.5) * F.col("_distinct") < 2.0 * limit
    near = df.join(F.broadcast(sizes), group).where(low).drop("_distinct").dropDuplicates([group, hashed])
    place = F.row_number().over(Window.partitionBy(group).orderBy(hashed))
    return near.withColumn("_place", place).where(F.col("_place") <= limit).drop("_place")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: lineage is cut
    with files that every executor sees."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
