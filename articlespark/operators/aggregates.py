"""Counts and statistics. pandas drops null group keys, and so do these."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import measures as ms

MAP_KEYS = ["year", "month", "day", "date", "state", "country", "continent", "subcontinent"]
MAP_LEVELS = {
    "day": MAP_KEYS,
    "state": ["year", "month", "state", "country", "continent", "subcontinent"],
    "country": ["year", "month", "country", "continent", "subcontinent"],
}
DASHBOARD_MEASURES = {
    "overall_polarity_value": "overall_polarity",
    "overall_subjectivity_value": "overall_subjectivity",
    "article_polarity_value": "article_polarity",
    "article_subjectivity_value": "article_subjectivity",
    "title_polarity_value": "title_polarity",
    "title_subjectivity_value": "title_subjectivity",
    "contradiction_subjectivity_value": "contradiction_subjectivity",
    "contradiction_polarity_value": "contradiction_polarity",
    "polarity_variations_value": "polarity_variations",
    "subjectivity_variations_value": "subjectivity_variations",
}
DASHBOARD_KEYS = [
    "source_name", "subject", "day_of_week", "day_label", "month", "year", "media_type", "label",
    "sentiment_overall", "overall_polarity_value", "overall_subjectivity_value",
    "article_polarity_value", "article_subjectivity_value", "sentiment_article",
    "title_polarity_value", "title_subjectivity_value", "sentiment_title",
    "contradiction_subjectivity_value", "contradiction_polarity_value",
    "polarity_variations_value", "subjectivity_variations_value",
    "count_of_locations", "title_length", "text_length_value",
]


def count_by(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias(name))


def count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0)).cast("bigint")


def dimension_counts(df: DataFrame, dims: Sequence[str], label: str = "label") -> DataFrame:
    """(dim, value, label, count) for several dimensions in one pass; nulls do not count."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("value")) for d in dims])
    long = df.select(label, F.explode(pairs).alias("p")).select("p.dim", "p.value", label)
    return count_by(long, ["dim", "value", label])


def with_share(counts: DataFrame, dim: str, count: str = "count", name: str = "percentage") -> DataFrame:
    """Percentage of each row's count within its dimension value (input is already aggregated)."""
    whole = F.sum(count).over(Window.partitionBy(dim))
    return counts.withColumn(name, ms.share_percent(F.col(count), whole))


def map_counts(df: DataFrame, keys: Sequence[str] = tuple(MAP_KEYS), real_label: int = 1) -> DataFrame:
    """Real and dubious articles per place and day; rows with other labels do not count."""
    real = F.col("label") == real_label
    dubious = F.col("label") == 1 - real_label
    return (df.filter(real | dubious).dropna(subset=list(keys)).groupBy(*keys)
            .agg(count_if(dubious).alias("fake_count"), count_if(real).alias("real_count")))


def map_counts_levels(df: DataFrame, levels: Mapping[str, Sequence[str]] = MAP_LEVELS, real_label: int = 1) -> DataFrame:
    """``map_counts`` by several lists of keys in one aggregate: (level, keys, counts), keys a level does not have are null.

    Every row is counted once per level before the only shuffle."""
    columns = list(dict.fromkeys(c for keys in levels.values() for c in keys))
    # the grouping id has a bit per column, the first one highest, set where the column is not grouped by
    ids = {name: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys) for name, keys in levels.items()}
    if len(set(ids.values())) < len(ids):
        raise ValueError("two levels have the same keys")
    real, dubious = F.col("label") == real_label, F.col("label") == 1 - real_label
    counted = (df.filter(real | dubious).groupingSets([[F.col(c) for c in keys] for keys in levels.values()], *[F.col(c) for c in columns])
               .agg(F.grouping_id().alias("_level"), count_if(dubious).alias("fake_count"), count_if(real).alias("real_count")))
    whole = reduce(or_, [(F.col("_level") == ids[name]) & reduce(and_, [F.col(c).isNotNull() for c in keys]) for name, keys in levels.items()])
    name = F.coalesce(*[F.when(F.col("_level") == i, F.lit(n)) for n, i in ids.items()])
    return counted.filter(whole).select(name.alias("level"), *columns, "fake_count", "real_count")


def dashboard_measures(df: DataFrame, empty_list_is_one: bool = False) -> DataFrame:
    """Rounded measures the dashboard groups by."""
    return df.withColumns({
        **{name: ms.round_half_even(F.col(src)) for name, src in DASHBOARD_MEASURES.items()},
        "count_of_locations": ms.list_count(F.col("locationsfromarticle"), empty_list_is_one),
        "text_length_value": ms.round_to_tens(F.col("text_length")),
    })


def dashboard_counts(df: DataFrame, keys: Sequence[str] = tuple(DASHBOARD_KEYS)) -> DataFrame:
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("article_id").alias("article_id"))


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Frequency table, most frequent first; ties by value."""
    return count_by(df, [col], name).orderBy(F.desc(name), col)


def date_bounds(df: DataFrame, col: str) -> DataFrame:
    return (df.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"))
            .withColumn("min_year", F.year("min_date")).withColumn("max_year", F.year("max_date")))


def centroid(cities: DataFrame, key: str) -> DataFrame:
    """Mean position of the cities per key."""
    return (cities.dropna(subset=[key]).groupBy(key)
            .agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude")))


def nonzero_stats(count: Column, condition: Column, suffix: str, places: int = 4) -> list[Column]:
    """Largest, mean and population deviation of the positive counts; 0 where there are none."""
    c = F.when(condition & (count > 0), count)
    return [
        F.coalesce(F.max(c), F.lit(0)).cast("bigint").alias(f"max_{suffix}"),
        ms.round_half_even(F.coalesce(F.avg(c), F.lit(0.0)), places).alias(f"mean_{suffix}"),
        ms.round_half_even(F.coalesce(F.stddev_pop(c), F.lit(0.0)), places).alias(f"stdev_{suffix}"),
    ]


def count_sums(count: Column, condition: Column, suffix: str) -> list[Column]:
    """What the statistics of positive counts follow from, all whole numbers: their sum, number, largest and sum of squares."""
    c = F.when(condition & (count > 0), count.cast("bigint"))
    return [F.coalesce(F.sum(c), F.lit(0)).alias(f"count_{suffix}"), F.count(c).alias(f"_n_{suffix}"),
            F.coalesce(F.max(c), F.lit(0)).alias(f"max_{suffix}"), F.sum(c * c).alias(f"_squares_{suffix}")]


def stats_of_sums(suffix: str, places: int = 4) -> list[Column]:
    """The columns of ``nonzero_stats`` from those of ``count_sums``; the deviation's radicand is exact."""
    n, total = F.col(f"_n_{suffix}"), F.col(f"count_{suffix}")
    whole = "decimal(38,0)"
    spread = n.cast(whole) * F.col(f"_squares_{suffix}").cast(whole) - total.cast(whole) * total.cast(whole)
    none = F.lit(0.0)
    return [F.col(f"max_{suffix}"),
            ms.round_half_even(F.when(n > 0, total / n).otherwise(none), places).alias(f"mean_{suffix}"),
            ms.round_half_even(F.when(n > 0, F.sqrt(spread.cast("double")) / n).otherwise(none), places).alias(f"stdev_{suffix}")]


def class_words(df: DataFrame, tokens: Column, label: str = "label") -> DataFrame:
    """Counted words per class: (label, word, cnt). Stands for the class's concatenated text."""
    return (df.dropna(subset=[label]).select(F.col(label).alias("label"), F.explode(tokens).alias("word"))
            .groupBy("label", "word").agg(F.count("*").alias("cnt")))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).dropna().distinct()


def vocabulary_union(words: DataFrame) -> DataFrame:
    """Words of both classes with zero-filled counts, from (label, word, cnt)."""
    return (words.filter(F.col("label").isin(0, 1)).groupBy("word")
            .agg(F.sum(F.when(F.col("label") == 1, F.col("cnt")).otherwise(0)).alias("count_real"),
                 F.sum(F.when(F.col("label") == 0, F.col("cnt")).otherwise(0)).alias("count_dubious")))
