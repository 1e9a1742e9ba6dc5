"""Joins that keep the pandas rules (first match, null keys) without depending on key balance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import small


def first_match(lookup: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key: the earliest by ``order``. Null keys never match, so they go."""
    rest = [c for c in lookup.columns if c != key]
    best = (lookup.dropna(subset=[key]).groupBy(key)
            .agg(F.min_by(F.struct(*rest), F.col(order)).alias("_best")))
    return best.select(key, *[F.col(f"_best.{c}").alias(c) for c in rest])


def lookup_first(df: DataFrame, lookup: DataFrame, on: str, key: str, order: str) -> DataFrame:
    """Left join to the first matching lookup row."""
    reduced = first_match(lookup, key, order)
    if key != on:
        reduced = reduced.withColumnRenamed(key, on)
    return df.join(small(reduced), on, "left")


def member_flag(df: DataFrame, col: str, members: DataFrame, member_col: str, name: str = "ignore") -> DataFrame:
    """0 where the value is among the members, else 1."""
    known = (members.select(F.col(member_col).alias(col)).dropna().distinct()
             .withColumn("_known", F.lit(True)))
    return (df.join(small(known), col, "left")
            .withColumn(name, F.when(F.col("_known").isNull(), 1).otherwise(0)).drop("_known"))


def lookup_left_mentions(places: DataFrame, mentions: DataFrame, key: str = "location") -> DataFrame:
    """``places LEFT JOIN mentions`` on the lower-cased key, one row per place and mention.

    A place may own a large part of all mentions, and an outer join cannot split that side. The
    matching part is an inner join against the (size-checked) places; the unmatched places are
    found from the distinct mentioned keys alone.
    """
    matched = mentioned_places(places, mentions, key)
    places = places.withColumn(key, F.lower(key)).dropna(subset=[key])
    lonely = places.join(mentions.select(F.lower(key).alias(key)).distinct(), key, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)


def mentioned_places(places: DataFrame, mentions: DataFrame, key: str = "location") -> DataFrame:
    """Mentions with the columns of their place, joined on the lower-cased key; null keys never match."""
    places = places.withColumn(key, F.lower(key)).dropna(subset=[key])
    return mentions.withColumn(key, F.lower(key)).join(small(places), key)


def article_locations_join(articles: DataFrame, located: DataFrame) -> DataFrame:
    """Articles with one row per place; articles without a place stay."""
    return articles.join(located.dropna(subset=["article_id"]), "article_id", "left")


def outer_counts(left: DataFrame, right: DataFrame, keys: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """Full outer join of two count tables; a missing count is 0."""
    return left.join(right, list(keys), "full_outer").fillna(0, subset=list(counts))


def word_classes(words: DataFrame, one: int = 1, other: int = 0) -> DataFrame:
    """(word, one, other): a word's counts in both classes, null in a class that does not have it, from (label, word, cnt).
    Which class has a word is then a matter of its own row."""
    return words.groupBy("word").agg(F.sum(F.when(F.col("label") == one, F.col("cnt"))).alias("one"),
                                     F.sum(F.when(F.col("label") == other, F.col("cnt"))).alias("other"))


def word_subsets(classes: DataFrame, only_one: str = "true_only", only_other: str = "false_only", common: str = "common") -> DataFrame:
    """(subset, word, cnt): words that only one class has, and words of both with their total, from ``word_classes``."""
    one, other = F.col("one"), F.col("other")
    subset = F.when(other.isNull(), F.lit(only_one)).when(one.isNull(), F.lit(only_other)).otherwise(F.lit(common))
    return (classes.where(one.isNotNull() | other.isNotNull())
            .select(subset.alias("subset"), "word", (F.coalesce(one, F.lit(0)) + F.coalesce(other, F.lit(0))).alias("cnt")))


def shared_words(classes: DataFrame, one: int = 1, other: int = 0) -> DataFrame:
    """(label, word, cnt) of the words that both classes have, from ``word_classes``."""
    counts = F.array(F.struct(F.lit(one).alias("label"), F.col("one").alias("cnt")), F.struct(F.lit(other).alias("label"), F.col("other").alias("cnt")))
    return (classes.where(F.col("one").isNotNull() & F.col("other").isNotNull())
            .select("word", F.explode(counts).alias("c")).select("c.label", "word", "c.cnt"))


def words_in_both(words: DataFrame, one: int, other: int) -> DataFrame:
    """Counted words of class ``one`` that class ``other`` also has; ``words`` has (label, word, cnt)."""
    return (words.filter(F.col("label") == one)
            .join(words.filter(F.col("label") == other).select("word"), "word", "left_semi"))


def words_only_in(words: DataFrame, one: int, other: int) -> DataFrame:
    return (words.filter(F.col("label") == one)
            .join(words.filter(F.col("label") == other).select("word"), "word", "left_anti"))


def words_in_neither_only(words: DataFrame, one: int, other: int) -> DataFrame:
    """Words of all rows that are exclusive to neither class, with their total count."""
    exclusive = (words_only_in(words, one, other).select("word")
                 .unionByName(words_only_in(words, other, one).select("word")))
    return (words.groupBy("word").agg(F.sum("cnt").alias("cnt"))
            .join(exclusive, "word", "left_anti"))


def rest_of(df: DataFrame, part: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``part``."""
    return df.join(part.select(key), key, "left_anti")


def update_from(df: DataFrame, results: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Overwrite columns with the non-null values of a results table (one row per key)."""
    fresh = results.select(key, *[F.col(c).alias(f"_new_{c}") for c in cols]).dropna(subset=[key])
    joined = df.join(small(fresh), key, "left")
    joined = joined.withColumns({c: F.coalesce(F.col(f"_new_{c}"), F.col(c)) for c in cols})
    return joined.drop(*[f"_new_{c}" for c in cols])
