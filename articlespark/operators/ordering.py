"""Distributed running sums over a total order, and what follows from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize, shuffle_width, small


#: Quantile sketches keep ranks within the rows divided by this.
SKETCH_ACCURACY = 10_000


def running_total(df: DataFrame, order: Sequence[str], weight: Column, name: str = "before") -> DataFrame:
    """Add the summed weight of all rows that come strictly earlier in the order.

    Rows are range-partitioned, each range gets the total of the ranges before it, and only the
    sums inside a range need sorting. The ranges are written down first, because their limits are
    sampled and could come out differently when a lost task is run again. ``order`` has to be
    unique so that ranges stay even.
    """
    ranges = shuffle_width(df.sparkSession)
    placed = materialize(
        df.repartitionByRange(ranges, *order)
          .withColumn("_range", F.spark_partition_id())
          .withColumn("_weight", weight),
        "ranges")
    offsets = _offsets(placed.groupBy("_range").agg(F.sum("_weight").alias("_total")))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (placed.join(F.broadcast(offsets), "_range")
            .withColumn(name, F.col("_offset") + F.coalesce(F.sum("_weight").over(inside), F.lit(0)))
            .drop("_range", "_weight", "_offset"))


def dense_ids(df: DataFrame, order: Sequence[str], name: str = "article_id", codec: str | None = None) -> DataFrame:
    """Consecutive ids from 0 in the given unique order.

    Rows are sorted within ranges and numbered as they are written, so the full rows are shuffled
    once; afterwards each range only has to be shifted by the rows before it.
    """
    ranges = shuffle_width(df.sparkSession)
    placed = materialize(
        df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
          .withColumn("_spot", F.monotonically_increasing_id()),
        "ids", codec)
    # the generated number holds the partition above bit 33 and the row's place below
    placed = placed.withColumns({"_range": F.shiftright("_spot", 33),
                                 "_place": F.col("_spot").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_total"))
    return (placed.join(F.broadcast(_offsets(sizes)), "_range")
            .withColumn(name, F.col("_offset") + F.col("_place"))
            .drop("_range", "_spot", "_place", "_offset"))


def _offsets(totals: DataFrame) -> DataFrame:
    """(_range, _offset) from the total per range; there are only as many rows as shuffle partitions."""
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))


def keep_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Of the rows with equal ``key`` (nulls are equal) the first by the unique, non-null ``order``.

    The groups are reduced to a digest and the smallest order value before any shuffle, so a text
    copied into a third of all rows costs one small row per task.
    """
    first = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    firsts = df.groupBy(F.sha2(F.col(key), 256).alias("_digest")).agg(F.min(first).alias("_first"))
    firsts = firsts.select(*([F.col("_first").alias(order[0])] if len(order) == 1
                             else [F.col(f"_first.{c}").alias(c) for c in order]))
    return df.join(firsts, list(order), "left_semi")


def exact_quantiles(df: DataFrame, by: str, value: str, probs: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles per group as columns ``q0``, ``q1``, ... next to the row number.

    Equal values are counted first; ranks come from the distributed running total, so neither a
    large group nor a frequent value has to fit into one task.
    """
    counts = df.dropna(subset=[by, value]).groupBy(by, value).agg(F.count("*").alias("_n"))
    ranked = running_total(counts, [by, value], F.col("_n"), name="_before")
    groups = small(ranked.groupBy(by).agg(F.min("_before").alias("_start"), F.sum("_n").alias("n_rows")))
    ranked = ranked.join(groups, by).withColumn("_rank", F.col("_before") - F.col("_start"))

    def at(rank: Column) -> Column:
        hit = (F.col("_rank") <= rank) & (rank < F.col("_rank") + F.col("_n"))
        return F.max(F.when(hit, F.col(value).cast("double")))

    aggs = [F.first("n_rows").alias("n_rows")]
    for i, p in enumerate(probs):
        spot = (F.col("n_rows") - 1) * F.lit(float(p))
        aggs += [at(F.floor(spot)).alias(f"_lo{i}"), at(F.ceil(spot)).alias(f"_hi{i}"),
                 F.first(spot - F.floor(spot)).alias(f"_f{i}")]
    out = ranked.groupBy(by).agg(*aggs)
    return out.select(by, "n_rows", *[
        (F.col(f"_lo{i}") + F.col(f"_f{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(f"q{i}")
        for i in range(len(probs))])
