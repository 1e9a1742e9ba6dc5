"""Grouped counts, statistics, shares and set operations."""

from pyspark.sql import functions as F

from ..functions import measures as ms
from ..functions import text as tx
from ..operators import aggregates as ag
from ..operators.charts import map_slices
from ..operators.joins import outer_counts
from ..plans.marts import articles_for_map, dashboard, located_articles, map_levels
from .core import ARTICLES, articles, measured, register, table, tokens_sql
from .dates import HOLIDAYS, with_holidays
from .locations import MENTIONS, PLACES, mentions, named_places
from .measures import MIXED
from .strings import MEDIA_COMBINED_SQL


@register("agg_loc_counts", f"""WITH {MENTIONS}
SELECT article_id, location, CAST(count(*) AS BIGINT) AS count FROM mentions GROUP BY ALL""")
def agg_loc_counts(spark, d):
    return ag.count_by(mentions(spark, d), ["article_id", "location"])


_LOCATED = f"""{PLACES}, filled AS (SELECT location, coalesce(state, country, subcontinent, continent) AS state,
  coalesce(country, subcontinent, continent) AS country, coalesce(subcontinent, continent) AS subcontinent, continent
  FROM places WHERE ignore <> 1),
located AS (SELECT a.article_id, a.label, a.date_clean AS date, f.state, f.country, f.subcontinent, f.continent
  FROM articles a LEFT JOIN (SELECT m.article_id, f.* FROM filled f JOIN mentions m USING (location)) f USING (article_id)
  WHERE a.date_clean >= DATE '2014-01-01')"""
_MAP_COUNTS = "CAST(count_if(label = 0) AS BIGINT) AS fake_count, CAST(count_if(label = 1) AS BIGINT) AS real_count"
_MAP_ROWS = "label IN (0, 1) AND state IS NOT NULL AND country IS NOT NULL AND continent IS NOT NULL AND subcontinent IS NOT NULL"


def _articles_with_parts(spark, d):
    return articles(spark, d).withColumns({"year": F.year("date_clean"), "month": F.month("date_clean"),
                                           "day": F.dayofmonth("date_clean")})


@register("agg_map_counts", f"""WITH {_LOCATED}
SELECT CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, CAST(day(date) AS INT) AS day, date, state, country, continent, subcontinent,
{_MAP_COUNTS} FROM located WHERE {_MAP_ROWS} GROUP BY ALL""")
def agg_map_counts(spark, d):
    return articles_for_map(_articles_with_parts(spark, d), mentions(spark, d), named_places(spark))


_LEVELS_SQL = " UNION ALL ".join(f"""SELECT '{level}' AS level, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month,
  {'CAST(day(date) AS INT)' if 'day' in keys else 'NULL'} AS day, {'date' if 'day' in keys else 'NULL'} AS date, {'state' if 'state' in keys else 'NULL'} AS state,
  country, continent, subcontinent, {_MAP_COUNTS} FROM located WHERE {_MAP_ROWS} GROUP BY ALL""" for level, keys in ag.MAP_LEVELS.items())


@register("agg_map_levels", f"WITH {_LOCATED} {_LEVELS_SQL}")
def agg_map_levels(spark, d):
    """Day, state and country level from one search for places and one aggregate."""
    return map_levels(_articles_with_parts(spark, d), mentions(spark, d), named_places(spark))


def _located(spark, d):
    return located_articles(_articles_with_parts(spark, d), mentions(spark, d), named_places(spark))


@register("agg_map_counts_by_state", f"""WITH {_LOCATED} SELECT CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, state, country,
continent, subcontinent, {_MAP_COUNTS} FROM located WHERE {_MAP_ROWS} GROUP BY ALL""")
def agg_map_counts_by_state(spark, d):
    return ag.map_counts(_located(spark, d), ["year", "month", "state", "country", "continent", "subcontinent"])


@register("chart_map_slices", f"""WITH {_LOCATED} SELECT CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, country,
continent, subcontinent, {_MAP_COUNTS} FROM located WHERE {_MAP_ROWS} GROUP BY ALL""")
def chart_map_slices(spark, d):
    return map_slices(_located(spark, d))


@register("join_outer_counts", f"""WITH {_LOCATED},
f AS (SELECT date, state, country, continent, subcontinent, count(*) AS n FROM located WHERE label = 0 AND {_MAP_ROWS} GROUP BY ALL),
r AS (SELECT date, state, country, continent, subcontinent, count(*) AS n FROM located WHERE label = 1 AND {_MAP_ROWS} GROUP BY ALL)
SELECT date, state, country, continent, subcontinent, CAST(coalesce(f.n, 0) AS BIGINT) AS fake_count, CAST(coalesce(r.n, 0) AS BIGINT) AS real_count
FROM f FULL JOIN r USING (date, state, country, continent, subcontinent)""")
def join_outer_counts(spark, d):
    keys = ["date", "state", "country", "continent", "subcontinent"]
    located = _located(spark, d)
    fake = ag.count_by(located.filter("label = 0"), keys, "fake_count")
    real = ag.count_by(located.filter("label = 1"), keys, "real_count")
    return outer_counts(fake, real, keys, ["fake_count", "real_count"])


def _band(c):
    return f"CASE WHEN {c} > 0 THEN 'positive' WHEN {c} < 0 THEN 'negative' ELSE 'neutral' END"


def _subj(c):
    return (f"CASE WHEN {c} > 0.8::DOUBLE THEN 'highly subjective' WHEN {c} > 0.6::DOUBLE THEN 'subjective' "
            f"WHEN {c} > 0.4::DOUBLE THEN 'neutral' WHEN {c} > 0.2::DOUBLE THEN 'objective' ELSE 'higly objective' END")


_DASH_KEYS_SQL = ", ".join(
    [f"round_even({src} * 100::DOUBLE, 0) / 100 AS {name}" for name, src in ag.DASHBOARD_MEASURES.items()]
    + [f"({_band(k + '_polarity')}) || ' ' || ({_subj(k + '_subjectivity')}) AS sentiment_{k}" for k in ("overall", "article", "title")])


@register("agg_dashboard", f"""WITH {MIXED}, m AS (
  SELECT m.*, l_orderkey * 10 + l_linenumber AS article_id, p_brand AS source_name, p_type AS subject, dayname(date_clean) AS day_of_week,
    dayname(date_clean) AS day_label, CAST(month(date_clean) AS INT) AS month, CAST(year(date_clean) AS INT) AS year, p_name AS media_type, len(string_split(p_name, ' ')) AS n
  FROM mixed m JOIN part ON l_partkey = p_partkey)
SELECT source_name, subject, day_of_week, day_label, month, year, media_type, label, title_length, CAST(n AS INT) AS count_of_locations,
  CAST(round_even(text_length / 10, 0) * 10 AS BIGINT) AS text_length_value, {_DASH_KEYS_SQL}, CAST(count(article_id) AS BIGINT) AS article_id
FROM m WHERE label IS NOT NULL GROUP BY ALL""")
def agg_dashboard(spark, d):
    c = F.col
    parts = table(spark, d, "part").select(
        c("p_partkey").alias("l_partkey"), c("p_brand").alias("source_name"), c("p_type").alias("subject"),
        c("p_name").alias("media_type"), F.split("p_name", " ").alias("locationsfromarticle"))
    mixed = measured(spark, d).withColumns(ms.sentiment_mix()).withColumn("article_id", c("l_orderkey") * 10 + c("l_linenumber"))
    mixed = mixed.withColumns({f"sentiment_{k}": tx.sentiment_label(c(f"{k}_polarity"), c(f"{k}_subjectivity"))
                               for k in ("overall", "article", "title")})
    mixed = mixed.withColumns({
        "day_of_week": F.date_format("date_clean", "EEEE"), "day_label": F.date_format("date_clean", "EEEE"),
        "month": F.month("date_clean"), "year": F.year("date_clean")})
    return dashboard(mixed.join(parts, "l_partkey"))


_DIM_SQL = {"subject": "subject", "source_name": "source_name", "media_type": MEDIA_COMBINED_SQL,
            "day_label": "coalesce((SELECT h.name FROM holidays h WHERE h.date = date_clean), dayname(date_clean))", "date_clean": "date_clean"}


def _dimension(spark, d, dim):
    a = articles(spark, d)
    if dim == "media_type":
        return a.withColumn(dim, tx.combined_media_type(tx.media_type(F.col("title")), tx.media_type(F.col("article_text"))))
    if dim == "day_label":
        return with_holidays(spark, a)
    if dim == "unique_location_count":
        n = mentions(spark, d).groupBy("article_id").agg(F.count("location").alias("n"))
        return a.join(n, "article_id", "left").withColumn(dim, F.coalesce("n", F.lit(0).cast("bigint")))
    return a


def _register_dim(dim, ctes, expr):
    @register(f"agg_by_{dim}", f"""WITH {ctes} SELECT {expr} AS {dim}, label, CAST(count(*) AS BIGINT) AS count
FROM articles WHERE label IS NOT NULL GROUP BY ALL""")
    def query(spark, d):
        return ag.count_by(_dimension(spark, d, dim), [dim, "label"])


for _dim, _expr in _DIM_SQL.items():
    _register_dim(_dim, HOLIDAYS if _dim == "day_label" else ARTICLES, _expr)
_register_dim("unique_location_count", MENTIONS,
              "coalesce((SELECT CAST(count(DISTINCT location) AS BIGINT) FROM mentions m WHERE m.article_id = articles.article_id), 0)")


@register("agg_dim_label", f"""WITH {ARTICLES}, p AS (SELECT label, unnest(['subject', 'source_name', 'date_clean']) AS dim,
  unnest([subject, source_name, CAST(date_clean AS VARCHAR)]) AS value FROM articles WHERE label IS NOT NULL)
SELECT dim, value, label, CAST(count(*) AS BIGINT) AS count FROM p GROUP BY ALL""")
def agg_dim_label(spark, d):
    return ag.dimension_counts(articles(spark, d), ["subject", "source_name", "date_clean"])


@register("win_share", f"""WITH {ARTICLES}, c AS (SELECT subject, label, CAST(count(*) AS BIGINT) AS count FROM articles
  WHERE label IS NOT NULL GROUP BY ALL)
SELECT subject, label, count, round(count / sum(count) OVER (PARTITION BY subject) * 100, 6) AS percentage FROM c""")
def win_share(spark, d):
    counts = ag.count_by(articles(spark, d), ["subject", "label"])
    return ag.with_share(counts, "subject").withColumn("percentage", F.round("percentage", 6))


@register("agg_minmax_date", f"""WITH {ARTICLES} SELECT min(date_clean) AS min_date, max(date_clean) AS max_date,
CAST(year(min(date_clean)) AS INT) AS min_year, CAST(year(max(date_clean)) AS INT) AS max_year FROM articles""")
def agg_minmax_date(spark, d):
    return ag.date_bounds(articles(spark, d), "date_clean")


@register("agg_centroid", """SELECT c_nationkey, round(avg(c_custkey), 6) AS latitude, round(avg(c_acctbal), 6) AS longitude FROM customer GROUP BY c_nationkey""")
def agg_centroid(spark, d):
    points = table(spark, d, "customer").select("c_nationkey", F.col("c_custkey").alias("latitude"), F.col("c_acctbal").alias("longitude"))
    return ag.centroid(points, "c_nationkey").select("c_nationkey", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"))


_RETURNED = "CASE WHEN l_returnflag = 'R' AND q > 0 THEN q END"


@register("agg_nonzero_stats", f"""SELECT l_partkey, CAST(coalesce(max({_RETURNED}), 0) AS BIGINT) AS max_real,
  round_even(coalesce(avg({_RETURNED}), 0) * 10000::DOUBLE, 0) / 10000 AS mean_real,
  round_even(coalesce(stddev_pop({_RETURNED}), 0) * 10000::DOUBLE, 0) / 10000 AS stdev_real
FROM (SELECT *, CAST(l_quantity AS INT) - 10 AS q FROM lineitem) GROUP BY l_partkey""")
def agg_nonzero_stats(spark, d):
    items = table(spark, d, "lineitem").withColumn("q", F.col("l_quantity").cast("int") - 10)
    return items.groupBy("l_partkey").agg(*ag.nonzero_stats(F.col("q"), F.col("l_returnflag") == "R", "real"))


@register("agg_value_counts", "SELECT source, CAST(count(*) AS BIGINT) AS count FROM documents GROUP BY source ORDER BY 2 DESC, 1")
def agg_value_counts(spark, d):
    return ag.value_counts(table(spark, d, "documents"), "source")


CLASS_WORDS = f"""class_words AS (SELECT label, word, CAST(count(*) AS BIGINT) AS cnt FROM (
  SELECT label, unnest({tokens_sql('article_text')}) AS word FROM articles WHERE label IS NOT NULL) GROUP BY ALL)"""


def class_words(spark, d):
    return ag.class_words(articles(spark, d), tx.word_tokens(F.col("article_text")))


@register("agg_concat_class", f"WITH {ARTICLES}, {CLASS_WORDS} SELECT label, word, cnt FROM class_words")
def agg_concat_class(spark, d):
    return class_words(spark, d)


@register("set_vocab_union", f"""WITH {ARTICLES}, {CLASS_WORDS}
SELECT coalesce(r.word, f.word) AS word, CAST(coalesce(r.cnt, 0) AS BIGINT) AS count_real, CAST(coalesce(f.cnt, 0) AS BIGINT) AS count_dubious
FROM (SELECT * FROM class_words WHERE label = 1) r FULL JOIN (SELECT * FROM class_words WHERE label = 0) f ON r.word = f.word""")
def set_vocab_union(spark, d):
    return ag.vocabulary_union(class_words(spark, d))


@register("distinct_locations", f"WITH {MENTIONS} SELECT DISTINCT location FROM mentions WHERE location IS NOT NULL")
def distinct_locations(spark, d):
    return ag.distinct_values(mentions(spark, d), "location")


@register("relevance", f"""WITH {ARTICLES}, {CLASS_WORDS}, v AS (SELECT word, CAST(sum(CASE WHEN label = 1 THEN cnt ELSE 0 END) AS BIGINT) AS r,
  CAST(sum(CASE WHEN label = 0 THEN cnt ELSE 0 END) AS BIGINT) AS f FROM class_words GROUP BY word)
SELECT word, round_even(abs(r - f) / (r + f) * 10000::DOUBLE, 0) / 10000 AS relevance_score FROM v""")
def relevance(spark, d):
    v = ag.vocabulary_union(class_words(spark, d))
    return v.select("word", ms.relevance(F.col("count_real"), F.col("count_dubious")).alias("relevance_score"))
