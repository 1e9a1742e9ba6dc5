"""Dates, calendar features and holidays."""

from pyspark.sql import functions as F

from ..functions import dates as dt
from ..operators import calendar
from .core import (ARTICLES, ORDER_DATES, SP, WD, articles, no_punct_sql, order_dates, register, strip_sql)

_PATTERN = rf"([{WD}]+)[{SP}]+(\d+),?[{SP}]*(\d+)?"
_RAW = strip_sql(no_punct_sql("coalesce(raw_date, '1901-02-01 00:00:00')"))
_MONTHS = ("jan feb mar apr may jun jul aug sep oct nov dec".split(),
           "january february march april may june july august september october november december".split())
_MONTH_SQL = ("CASE lower(m) " + " ".join(f"WHEN '{n}' THEN '{i + 1}'" for names in _MONTHS for i, n in enumerate(names)
                                          if not (names is _MONTHS[1] and n == "may")) + " END")


def _parsed(source: str, key: str) -> str:
    return rf"""parts AS (SELECT {key}, {_RAW} AS raw FROM {source}),
cut AS (SELECT {key}, nullif(regexp_extract(raw, '{_PATTERN}', 1), '') AS m, nullif(regexp_extract(raw, '{_PATTERN}', 2), '') AS d,
        coalesce(nullif(regexp_extract(raw, '{_PATTERN}', 3), ''), '2020') AS y FROM parts),
parsed AS (SELECT {key}, CAST(try_strptime(
  CASE WHEN length(CASE WHEN length(y) = 2 THEN '20' || y ELSE y END) = 4 AND length(d) <= 2
       THEN CASE WHEN length(y) = 2 THEN '20' || y ELSE y END || '-' || ({_MONTH_SQL}) || '-' || d END, '%Y-%m-%d') AS DATE) AS parsed FROM cut)"""


@register("date_parse", f"WITH {ORDER_DATES}, {_parsed('order_dates', 'o_orderkey')} SELECT o_orderkey, parsed FROM parsed")
def date_parse(spark, d):
    return order_dates(spark, d).select("o_orderkey", dt.parse_date(F.col("raw_date"), 2020).alias("parsed"))


_DATED = ARTICLES + """, dated AS (SELECT article_id,
  CASE article_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Feb 30, 2017' ELSE strftime(date_clean, '%B %-d, %Y') END AS raw_date,
  CASE article_id % 8 WHEN 0 THEN article_text || ' seen 2016-0' || CAST(1 + article_id % 9 AS VARCHAR) || '-15'
                      WHEN 1 THEN article_text || ' 2016-13-45' ELSE article_text END AS article_text,
  CASE WHEN article_id % 8 = 4 THEN title || ' 2017-03-0' || CAST(1 + article_id % 9 AS VARCHAR) ELSE title END AS title FROM articles)"""


def _dated(spark, d):
    k = F.col("article_id")
    digit = (F.lit(1) + k % 9).cast("string")
    return articles(spark, d).select(
        "article_id",
        F.when(k % 4 == 0, F.lit(None).cast("string")).when(k % 4 == 1, "Feb 30, 2017")
         .otherwise(F.date_format("date_clean", "MMMM d, yyyy")).alias("raw_date"),
        F.when(k % 8 == 0, F.concat("article_text", F.lit(" seen 2016-0"), digit, F.lit("-15")))
         .when(k % 8 == 1, F.concat("article_text", F.lit(" 2016-13-45"))).otherwise(F.col("article_text")).alias("article_text"),
        F.when(k % 8 == 4, F.concat("title", F.lit(" 2017-03-0"), digit)).otherwise(F.col("title")).alias("title"))


_ISO = r"CAST(try_strptime(nullif(regexp_extract({}, '(\d{{4}}-\d{{2}}-\d{{2}})', 1), ''), '%Y-%m-%d') AS DATE)"


@register("date_fallback", f"""WITH {_DATED}, {_parsed('dated', 'article_id')}
SELECT article_id, coalesce(parsed, {_ISO.format('article_text')}, {_ISO.format('title')}, DATE '2000-02-01') AS date_clean
FROM dated JOIN parsed USING (article_id)""")
def date_fallback(spark, d):
    parsed = dt.parse_date(F.col("raw_date"), 2020)
    return _dated(spark, d).select("article_id", dt.date_with_fallback(
        parsed, F.col("article_text"), F.col("title")).alias("date_clean"))


@register("date_parts_raw", rf"""WITH {ORDER_DATES}, p AS (SELECT o_orderkey, {_RAW} AS raw FROM order_dates)
SELECT o_orderkey, nullif(regexp_extract(raw, '{_PATTERN}', 1), '') AS month_raw, nullif(regexp_extract(raw, '{_PATTERN}', 2), '') AS day_raw,
       nullif(regexp_extract(raw, '{_PATTERN}', 3), '') AS year_raw FROM p""")
def date_parts_raw(spark, d):
    month, day, year = dt.raw_date_parts(F.col("raw_date"))
    return order_dates(spark, d).select("o_orderkey", month.alias("month_raw"), day.alias("day_raw"), year.alias("year_raw"))


@register("date_features", f"""WITH {ARTICLES} SELECT article_id, dayname(date_clean) AS day_of_week,
CAST(week(date_clean) AS INT) AS week_of_year, CAST(dayofweek(date_clean) IN (0, 6) AS INT) AS is_weekend,
CAST(dayofweek(date_clean) NOT IN (0, 6) AS INT) AS is_weekday FROM articles""")
def date_features(spark, d):
    f = dt.date_features(F.col("date_clean"))
    return articles(spark, d).select("article_id", *[f[n].alias(n) for n in (
        "day_of_week", "week_of_year", "is_weekend", "is_weekday")])


@register("date_cyclic", f"""WITH {ARTICLES} SELECT article_id,
round(sin(2 * pi() * week(date_clean) / 52), 6) AS week_of_year_sin, round(cos(2 * pi() * week(date_clean) / 52), 6) AS week_of_year_cos,
round(sin(2 * pi() * day(date_clean) / 31), 6) AS day_of_month_sine, round(cos(2 * pi() * day(date_clean) / 31), 6) AS day_of_month_cos,
round(sin(2 * pi() * month(date_clean) / 12), 6) AS month_sin, round(cos(2 * pi() * month(date_clean) / 12), 6) AS month_cos FROM articles""")
def date_cyclic(spark, d):
    f = dt.date_features(F.col("date_clean"))
    return articles(spark, d).select("article_id", *[F.round(f[n], 6).alias(n) for n in (
        "week_of_year_sin", "week_of_year_cos", "day_of_month_sine", "day_of_month_cos", "month_sin", "month_cos")])


# The n-th weekday of a month: the first day moved forward to the weekday (0 = Sunday), plus weeks
def _nth_sql(month: int, weekday: int, n: int) -> str:
    first = f"make_date(y, {month}, 1)"
    return f"{first} + CAST(({weekday} - dayofweek({first}) + 7) % 7 + {7 * (n - 1)} AS INT)"


_FIXED = [("New Year''s Day", 1, 1, 0), ("Juneteenth National Independence Day", 6, 19, 2021), ("Independence Day", 7, 4, 0),
          ("Veterans Day", 11, 11, 0), ("Christmas Day", 12, 25, 0)]
_FLOATING = [("Martin Luther King Jr. Day", _nth_sql(1, 1, 3)), ("Washington''s Birthday", _nth_sql(2, 1, 3)),
             ("Memorial Day", "make_date(y, 5, 31) - CAST((dayofweek(make_date(y, 5, 31)) + 6) % 7 AS INT)"),
             ("Labor Day", _nth_sql(9, 1, 1)), ("Columbus Day", _nth_sql(10, 1, 2)), ("Thanksgiving Day", _nth_sql(11, 4, 4))]
HOLIDAYS = (ARTICLES + ", years AS (SELECT CAST(y AS BIGINT) AS y FROM (SELECT unnest(range((SELECT year(min(date_clean)) FROM articles), "
            "(SELECT year(max(date_clean)) FROM articles) + 2)) AS y)), named AS ("
            + " UNION ALL ".join(
                [f"SELECT make_date(y, {m}, {day}) AS date, '{n}' AS name FROM years WHERE y >= {since}" for n, m, day, since in _FIXED]
                + [f"SELECT CASE dayofweek(make_date(y, {m}, {day})) WHEN 6 THEN make_date(y, {m}, {day}) - 1 ELSE make_date(y, {m}, {day}) + 1 END, "
                   f"'{n} (observed)' FROM years WHERE y >= {since} AND dayofweek(make_date(y, {m}, {day})) IN (0, 6)" for n, m, day, since in _FIXED]
                + [f"SELECT {rule}, '{n}' FROM years" for n, rule in _FLOATING])
            + "), holidays AS (SELECT date, string_agg(name, '; ' ORDER BY name) AS name FROM named "
              "WHERE year(date) <= (SELECT year(max(date_clean)) FROM articles) GROUP BY date)")


def with_holidays(spark, df):
    return calendar.with_holidays(df, "date_clean", calendar.us_holidays(spark))


@register("holiday_flag", f"""WITH {HOLIDAYS} SELECT article_id, date_clean, CAST(h.name IS NOT NULL AS INT) AS holiday
FROM articles LEFT JOIN holidays h ON h.date = date_clean""")
def holiday_flag(spark, d):
    return with_holidays(spark, articles(spark, d)).select("article_id", "date_clean", "holiday")


@register("day_label", f"""WITH {HOLIDAYS} SELECT article_id, coalesce(h.name, dayname(date_clean)) AS day_label
FROM articles LEFT JOIN holidays h ON h.date = date_clean""")
def day_label(spark, d):
    return with_holidays(spark, articles(spark, d)).select("article_id", "day_label")
