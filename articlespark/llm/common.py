"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# fixed values: white space and words as the contracts define them
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sums_before(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str], value: str,
                name: str, many: bool = False) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same group that come earlier.

    ``bucket`` cuts the order of a group into consecutive runs: a row with a smaller bucket comes
    first. Only one bucket has to be sorted in a task; between buckets just their totals are summed, so
    that a group of any size is spread over as many tasks as it has buckets. With ``many`` buckets, a number
    that grows with the data, their totals are summed the same way. Group columns hold no nulls.
    """
    keys = [*group, bucket]
    offsets = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    if many:
        offsets = sums_before(offsets.withColumn("_block", F.shiftright(bucket, 12)), group, "_block", [bucket],
                              "_total", "_outer").drop("_total", "_block").withColumnRenamed("_outer", "_offset")
    else:
        before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
        offsets = offsets.withColumn("_offset", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.join(offsets, keys)
            .withColumn(name, F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .drop("_offset"))
