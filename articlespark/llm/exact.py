"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize, small
from .common import SPACES

PREFIX_CHARS = 64


def normalized(text: Column) -> Column:
    """Runs of white space as one space; a null text counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def refine(rows: DataFrame) -> DataFrame:
    """Of rows with ``length`` and ``prefix`` those whose length, and then whose length and prefix, occur
    again. The keys are counted before the shuffle, so a frequent one costs a row per task."""
    again = F.count("*") > 1
    lengths = rows.groupBy("length").agg(again.alias("_again")).where("_again").drop("_again")
    heads = (rows.join(lengths, "length", "left_semi").groupBy("length", "prefix").agg(again.alias("_again"))
             .where("_again").drop("_again"))
    return rows.join(heads, ["length", "prefix"], "left_semi")


def text_groups(rows: DataFrame) -> DataFrame:
    """(sha, keep_id, group_size) of the digests that occur more than once; null ids come last."""
    return (rows.groupBy("sha").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
            .where("group_size > 1"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    The text is read once into lengths, prefix hashes and digests; only rows whose length and prefix
    occur again take part in the grouping by digest, all others are groups of one. Texts are equal when their digests of
    the normalised text are. Of equal texts the row with the smallest id stays; a null id is the largest,
    and of repeated rows with the same id and text exactly one stays. Null, empty and blank-free texts
    are ordinary texts (null equals empty). Other columns are not touched; an empty table gives no rows.
    """
    norm = normalized(F.col(text_col))
    scanned = (docs.select(F.col(id_col).alias("id"), norm.alias("norm"))
               .select("id", F.length("norm").alias("length"),
                       F.xxhash64(F.substring("norm", 1, PREFIX_CHARS)).alias("prefix"),
                       F.sha2("norm", 256).alias("sha")))
    rows = materialize(scanned, "exact")
    groups = text_groups(refine(rows))
    copy = F.row_number().over(Window.partitionBy("sha", "id").orderBy(F.lit(0)))
    numbered = rows.select("id", "sha", copy.alias("copy"))
    return (numbered.join(groups, "sha", "left")
            .select(F.col("id").alias(id_col),
                    F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    (F.col("group_size").isNull() | (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)))
                    .alias("kept"),
                    F.col("sha").alias("text_sha256")))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without their exact copies, all columns kept; cases as in ``exact_groups``.

    The first pass numbers the rows and leaves their lengths and prefix hashes. Only documents whose length, and then whose length and
    prefix, occur again are read once more and hashed in full. What goes is decided on numbers; a text is shuffled only where
    the numbers that go are too many to be broadcast.
    """
    norm = normalized(F.col(text_col))
    numbered = materialize(docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("number"), F.length(norm).alias("length"),
        F.xxhash64(F.substring(norm, 1, PREFIX_CHARS)).alias("prefix")), "numbered")
    heads = materialize(numbered.groupBy("length", "prefix").agg(F.count("*").alias("n")), "heads")
    lengths = heads.groupBy("length").agg((F.sum("n") > 1).alias("_again")).where("_again").drop("_again")
    repeated = small(materialize(heads.where("n > 1").join(lengths, "length", "left_semi").select("length", "prefix"), "repeated"))
    hashed = materialize(numbered.join(repeated, ["length", "prefix"], "left_semi").select(
        "id", "number", F.sha2(normalized(F.col(f"row.`{text_col}`")), 256).alias("sha")), "hashed")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "number"))
    kept = hashed.groupBy("sha").agg(first["number"].alias("number")).select("number")
    gone = materialize(hashed.select("number").join(kept, "number", "left_anti"), "gone")
    return numbered.join(small(gone), "number", "left_anti").select("row.*")
