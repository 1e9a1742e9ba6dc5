"""Column profiles, each from one pass over the data."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .aggregates import count_if
from .ordering import SKETCH_ACCURACY, exact_quantiles


def _long(row: DataFrame, names: Sequence[str], value: str) -> DataFrame:
    """A one-row frame with a column per name as rows (column, value)."""
    pairs = F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"`{n}`").alias(value)) for n in names])
    return row.select(F.explode(pairs).alias("p")).select("p.*")


def null_counts(df: DataFrame) -> DataFrame:
    return _long(df.agg(*[count_if(F.col(c).isNull()).alias(c) for c in df.columns]), df.columns, "nulls")


def has_nulls(df: DataFrame) -> bool:
    """Whether any value is missing; the gate before a final table is saved."""
    return null_counts(df).agg(F.sum("nulls")).first()[0] > 0


def unique_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column.

    The exact form counts each column's values separately: (column, value) pairs are reduced per
    task, then per pair, and only pair counts are summed up. Long values travel as digests."""
    if approximate:
        row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in df.columns])
        return _long(row, df.columns, "uniques")
    def brief(c: str) -> Column:
        v = F.col(c).cast("string")
        return F.when(F.length(v) > 64, F.sha2(v, 256)).otherwise(v)

    pairs = F.array(*[F.struct(F.lit(c).alias("column"), brief(c).alias("value")) for c in df.columns])
    values = df.select(F.explode(pairs).alias("p")).select("p.*").distinct()
    return values.groupBy("column").agg(F.count("value").alias("uniques"))


def duplicate_columns(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    """Repeated column names with how often they occur."""
    repeated = [(name, n) for name, n in Counter(columns).items() if n > 1]
    return spark.createDataFrame(repeated, "column string, occurrences int")


def describe(df: DataFrame, cols: Sequence[str], approximate: bool = False, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column.

    Exact quartiles sort the distinct values of all columns; ``approximate`` ones come from sketches in the same aggregate as
    the rest, as values of the data whose ranks are off by no more than the count divided by ``accuracy``."""
    if approximate:
        def summary(c: str) -> Column:
            v = F.col(c).cast("double")
            v = F.when(~F.isnan(v), v)
            q = F.percentile_approx(v, [0.25, 0.5, 0.75], accuracy)
            return F.struct(F.lit(c).alias("column"), F.count(v).alias("count"), F.min(v).alias("min"), F.get(q, F.lit(0)).alias("p25"),
                            F.get(q, F.lit(1)).alias("p50"), F.get(q, F.lit(2)).alias("p75"), F.max(v).alias("max"),
                            F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"))
        row = df.agg(*[summary(c).alias(f"_{i}") for i, c in enumerate(cols)])
        return row.select(F.explode(F.array(*[f"_{i}" for i in range(len(cols))])).alias("p")).select("p.*").filter("count > 0")
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    long = df.select(F.explode(pairs).alias("p")).select("p.*").dropna()
    moments = long.groupBy("column").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    q = exact_quantiles(long, "column", "value", (0.0, 0.25, 0.5, 0.75, 1.0)).select(
        "column", F.col("n_rows").alias("count"), F.col("q0").alias("min"), F.col("q1").alias("p25"),
        F.col("q2").alias("p50"), F.col("q3").alias("p75"), F.col("q4").alias("max"))
    return q.join(moments, "column")


def stage_counts(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """Rows left after each cumulative cleaning step, from one aggregate over step conditions."""
    passed = F.lit(True)
    aggs = []
    for name, condition in steps.items():
        passed = passed & condition
        aggs.append(count_if(passed).alias(name))
    return _long(df.agg(*aggs), list(steps), "rows_left").withColumnRenamed("column", "step")


def watched(df: DataFrame, steps: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` unchanged, and what will hold ``stage_counts`` once a job has run over all of it: the counts are taken along the
    way, without a pass of their own. See ``watched_counts``."""
    seen = Observation()
    passed, counts = F.lit(True), []
    for i, condition in enumerate(steps.values()):
        passed = passed & condition
        counts.append(count_if(F.coalesce(passed, F.lit(False))).alias(f"s{i}"))
    return df.observe(seen, *counts), seen


def watched_counts(spark: SparkSession, seen: Observation, steps: Mapping[str, Column]) -> DataFrame:
    """(step, rows_left) after the job; waits for it if it has not run."""
    found = seen.get
    return spark.createDataFrame([(name, int(found[f"s{i}"] or 0)) for i, name in enumerate(steps)], "step string, rows_left long")
