"""Tables the map and the dashboard read."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates, joins, locations, rows


def located_articles(articles: DataFrame, mentions: DataFrame, places: DataFrame,
                     start: date = rows.MAP_FROM) -> DataFrame:
    """Dated articles with one row per place, regions filled upwards, ignored places left out."""
    dated = rows.filter_from_date(articles.withColumn("date", F.col("date_clean")), "date", start)
    kept = locations.drop_ignored(rows.fill_region_hierarchy(places))
    # a place without mentions has no article to be joined to, so the inner part of the lookup is enough
    placed = joins.mentioned_places(kept, mentions)
    return joins.article_locations_join(
        dated.select("article_id", "label", "year", "month", "day", "date"), placed)


def map_levels(articles: DataFrame, mentions: DataFrame, places: DataFrame, real_label: int = 1,
               start: date = rows.MAP_FROM) -> DataFrame:
    """The map's counts by day, by state and month and by country and month, from one aggregate."""
    return aggregates.map_counts_levels(located_articles(articles, mentions, places, start), real_label=real_label)


def articles_for_map(articles: DataFrame, mentions: DataFrame, places: DataFrame, real_label: int = 1,
                     start: date = rows.MAP_FROM) -> DataFrame:
    """Real and dubious articles per place and day, in key order."""
    counted = aggregates.map_counts(located_articles(articles, mentions, places, start), real_label=real_label)
    return counted.orderBy(*aggregates.MAP_KEYS)


def dashboard(articles: DataFrame, empty_list_is_one: bool = False) -> DataFrame:
    """Articles counted by the 24 dashboard keys."""
    return aggregates.dashboard_counts(aggregates.dashboard_measures(articles, empty_list_is_one))
