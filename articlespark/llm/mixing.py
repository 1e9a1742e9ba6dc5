"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize, small
from .common import sums_before

#: Rows that are sorted in one task, about: the orders of a source and of the mix are cut into as many runs as that takes.
RUN_ROWS = 1 << 17


def source_targets(sizes: DataFrame, weights: Sequence[float], budget: float, max_repeats: int) -> DataFrame:
    """Add ``rank`` (code point order, null last), ``weight``, ``target`` and the whole ``budget`` to (source, source_size).

    ``budget`` is a multiple of the size of all sources, shared by weight. No target may exceed
    ``max_repeats`` times its source; the excess is reshared by weight until none does. In the order of
    size per weight the capped sources come first, so one running sum finds the level at which the
    rest is served. There is one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                               (F.col("rank") % len(weights) + 1).cast("int")))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    level = ranked.withColumns({
        "_spot": F.row_number().over(order),
        "_left": F.sum("source_size").over(everything) * F.lit(float(budget))
        - F.coalesce(F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * max_repeats,
        "_weights": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))})
    level = level.withColumn("_level", F.col("_left") / F.col("_weights"))
    free = F.col("source_size") * max_repeats > F.col("weight") * F.col("_level")
    first = F.min(F.when(free, F.struct("_spot", "_level"))).over(everything)
    return (level.withColumn("_first", first)
            .withColumn("target", F.when(F.col("_spot") >= F.col("_first._spot"), F.col("weight") * F.col("_first._level"))
                        .otherwise((F.col("source_size") * max_repeats).cast("double")))
            .withColumn("budget", F.floor(F.sum("source_size").over(everything) * F.lit(float(min(budget, max_repeats)))))
            .select("source", "source_size", "rank", "weight", "target", "budget"))


def mix(docs: DataFrame, size: Column, key: Column, source: str = "source", weights: Sequence[float] = (1.0,),
        budget: float = 1.0, max_repeats: int = 1, seed: str = "mix") -> DataFrame:
    """The mixed stream: every input column in the struct ``row``, and

    ``size``, ``source_size``, ``target`` (of its source), ``part`` and ``spot`` (together the row's own
    number), ``epoch`` (which repeat), ``finish`` (virtual finish time), ``position`` (words of the
    mix before it), ``taken`` (words taken from this repeat).

    Each source's rows stand in the order of a digest of ``key``, ``max_repeats`` times over. A row finishes at the words its source
    has delivered by then, divided by the source's target, so that sources are served in proportion to
    their targets. All rows are sorted by finish time over all sources and cut off at the total budget and nowhere else: a
    row under way there gives only its first words. Sources come within a row of their targets, which they reach together
    at virtual time 1. The sort runs in ranges of the finish time; the rows beyond the cut are sorted like others.

    Rows of size 0 and rows never reached stay, once, with ``taken`` 0 and no finish time. A null source is a
    source of its own; null keys and repeated rows are mixed like others (equal rows are interchangeable).
    An empty table gives an empty mix. Same input and seed, same result.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col(source).alias("source"), size.cast("long").alias("size"),
                       F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")))).alias("digest"))
    sizes = materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")), "sources")
    runs = 1 + (sizes.agg(F.sum("rows")).first()[0] or 0) // RUN_ROWS
    targets = small(materialize(source_targets(sizes.drop("rows"), weights, budget, max_repeats), "targets"))
    digits = max(1, (16 * runs - 1).bit_length() // 4)
    rows = rows.withColumn("part", F.conv(F.substring("digest", 1, digits), 16, 10).cast("long"))
    # joined on the name rather than numbered in the rows; a null name only equals itself
    named = rows.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    named = named.drop("source", "_source")
    order = ["digest", "size"]
    numbered = sums_before(named, ["rank"], "part", order, "size", "start", many=True).withColumn(
        "spot", F.row_number().over(Window.partitionBy("rank", "part").orderBy(*order)))

    repeats = numbered.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
    served = F.col("epoch") * F.col("source_size") + F.col("start") + F.col("size")
    repeats = repeats.withColumn("finish", F.when((F.col("size") > 0) & (F.col("target") > 0), served / F.col("target")))
    # each run of finish times holds as many words of the mix
    width = 8 * runs
    run = F.when(F.col("finish").isNull(), -1 - F.pmod(F.xxhash64("digest"), F.lit(width))).otherwise(F.floor(F.col("finish") * width))
    stream = sums_before(repeats.withColumn("_run", run.cast("long")), [], "_run", ["finish", "rank", "epoch", "digest", "spot"],
                         "size", "position", many=True)
    left = F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - F.col("position")))
    taken = F.when(F.col("finish").isNull(), F.lit(0)).otherwise(left)
    return (stream.withColumn("taken", taken).where((F.col("epoch") == 0) | (F.col("taken") > 0))
            .withColumn("finish", F.when(F.col("taken") > 0, F.col("finish")))
            .select("row", "size", "source_size", "target", "rank", "part", "spot", "epoch", "finish", "position", "taken"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word."""
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")


def mixed_documents(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The rows of the mix with the columns of the documents: repeats as repeated rows, a row that is
    cut off with its first words only."""
    taken = mixed.where(F.col("taken") > 0)
    names = taken.schema["row"].dataType.names
    cut = F.when(F.col("taken") < F.col("size"), first_words(F.col("row").getField(text), F.col("taken")))
    return taken.select(*[F.coalesce(cut, F.col("row").getField(c)).alias(c) if c == text else
                          F.col("row").getField(c).alias(c) for c in names])


def mix_documents(docs: DataFrame, size: Column, key: Column, source: str = "source", text: str = "text", **options) -> DataFrame:
    """``mixed_documents`` of ``mix`` with the columns of the documents; the mix is decided on sizes, keys and row numbers, and the
    texts are joined to it once. Cases as in ``mix``."""
    numbered = materialize(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("_number"),
                                       F.col(source).alias("_source"), size.alias("_size"), key.alias("_key")), "numbered")
    mixed = mix(numbered.select("_number", "_source", "_size", "_key"), F.col("_size"), F.col("_key"), "_source", **options)
    taken = mixed.where(F.col("taken") > 0).select(F.col("row._number").alias("_number"), "taken", "size")
    return mixed_documents(numbered.select("_number", "row").join(taken, "_number"), text)
