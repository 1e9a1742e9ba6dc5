"""US holidays as a generated dimension, and the date columns that need it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _nth(year: Column, month: int, weekday: str, n: int) -> Column:
    """The n-th given weekday of a month."""
    before = F.date_sub(F.make_date(year, F.lit(month), F.lit(1)), 1)
    return F.date_add(F.next_day(before, weekday), 7 * (n - 1))


# No holiday has a rule before the first year; dates are readable up to the last.
FIRST_YEAR, LAST_YEAR = 1971, 2262


def us_holidays(spark: SparkSession, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> DataFrame:
    """(date, name) for every US federal holiday and its observed day in the years given, by default
    all years a readable date can have, so that no pass over the dates is needed first.

    A fixed holiday on a Saturday is observed the Friday before, on a Sunday the Monday after. One
    row per date; names sharing a date are joined by ``'; '``. The rules hold from 1971 on.
    """
    y = F.col("year")

    def day(month: int, d: int) -> Column:
        return F.make_date(y, F.lit(month), F.lit(d))

    # Names, rules and the first year of the holidays introduced after 1971.
    fixed = [("New Year's Day", day(1, 1), 1971), ("Juneteenth National Independence Day", day(6, 19), 2021),
             ("Independence Day", day(7, 4), 1971), ("Veterans Day", day(11, 11), 1978),
             ("Christmas Day", day(12, 25), 1971)]
    floating = [("Martin Luther King Jr. Day", _nth(y, 1, "MON", 3), 1986),
                ("Washington's Birthday", _nth(y, 2, "MON", 3), 1971),
                ("Memorial Day", F.date_sub(F.next_day(day(5, 31), "MON"), 7), 1971),
                ("Labor Day", _nth(y, 9, "MON", 1), 1971),
                ("Columbus Day", _nth(y, 10, "MON", 2), 1971),
                ("Thanksgiving Day", _nth(y, 11, "THU", 4), 1971)]

    def item(name: str, d: Column, since: int) -> Column:
        return F.when(y >= since, F.struct(d.alias("date"), F.lit(name).alias("name")))

    items = []
    for name, d, since in fixed:
        weekday = F.dayofweek(d)
        observed = F.when(weekday == 7, F.date_sub(d, 1)).when(weekday == 1, F.date_add(d, 1))
        items += [item(name, d, since), item(f"{name} (observed)", observed, since)]
    items += [item(name, d, since) for name, d, since in floating]

    # the year after the last one, because its New Year's Day can be observed on 31 December
    years = spark.range(first_year, last_year + 2).select(F.col("id").cast("int").alias("year"))
    rows = years.select(F.explode(F.array(*items)).alias("h")).select("h.date", "h.name").dropna()
    rows = rows.filter(F.year("date").between(first_year, last_year))
    # at most a handful of names per date
    return rows.groupBy("date").agg(F.array_join(F.sort_array(F.collect_list("name")), "; ").alias("name"))


def with_holidays(df: DataFrame, date_col: str, holidays: DataFrame) -> DataFrame:
    """Add ``holiday`` (0/1) and ``day_label`` (holiday name, else weekday name).

    ``holidays`` holds one row per date, a dozen or so per year and some 4,000 for all years, and so is
    always broadcast."""
    named = holidays.select(F.col("date").alias(date_col), F.col("name").alias("_holiday"))
    return (df.join(F.broadcast(named), date_col, "left")
            .withColumn("holiday", F.col("_holiday").isNotNull().cast("int"))
            .withColumn("day_label", F.coalesce(F.col("_holiday"), F.date_format(date_col, "EEEE")))
            .drop("_holiday"))
