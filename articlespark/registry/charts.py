"""Chart tables."""

from datetime import date

from pyspark.sql import functions as F

from ..operators import charts, rows
from ..operators.ordering import SKETCH_ACCURACY
from .core import ARTICLES, MEASURED, articles, measured, register
from .measures import MIXED
from ..functions import measures as ms


def _mixed(spark, d):
    return measured(spark, d).withColumns(ms.sentiment_mix())


_PAIRS = [("title_polarity", "article_polarity"), ("title_subjectivity", "article_subjectivity"), ("title_length", "text_length"),
          ("article_subjectivity", "article_polarity"), ("title_subjectivity", "title_polarity"),
          ("contradiction_polarity", "polarity_variations"), ("contradiction_subjectivity", "subjectivity_variations")]


@register("chart_scatter", f"WITH {MIXED} " + " UNION ALL ".join(
    f"SELECT '{x}' AS pair, l_orderkey, l_linenumber, round(CAST({x} AS DOUBLE), 6) AS x, round(CAST({y} AS DOUBLE), 6) AS y, label FROM mixed "
    "WHERE date_clean BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'" for x, y in _PAIRS))
def chart_scatter(spark, d):
    points = charts.scatter_pairs(_mixed(spark, d), _PAIRS, "label", "date_clean", date(1998, 1, 1), date(1998, 12, 31), ["l_orderkey", "l_linenumber"])
    return points.withColumns({c: F.round(c, 6) for c in ("x", "y")})


@register("chart_box", f"""WITH {ARTICLES}, q AS (SELECT label, count(*) AS n, quantile_cont(CAST(length(article_text) AS DOUBLE), [0, 0.25, 0.5, 0.75, 1]) AS q
  FROM articles WHERE label IS NOT NULL GROUP BY label)
SELECT label, CAST(n AS BIGINT) AS n_rows, round(q[1], 6) AS low, round(q[2], 6) AS q1, round(q[3], 6) AS median, round(q[4], 6) AS q3, round(q[5], 6) AS high FROM q""")
def chart_box(spark, d):
    box = charts.box(articles(spark, d).withColumn("text_length", F.length("article_text")), "text_length")
    return box.select("label", "n_rows", *[F.round(c, 6).alias(c) for c in ("low", "q1", "median", "q3", "high")])


@register("chart_box_approx", f"""WITH {ARTICLES} SELECT label, CAST(count(*) AS BIGINT) AS n_rows, CAST(min(length(article_text)) AS DOUBLE) AS low,
CAST(max(length(article_text)) AS DOUBLE) AS high, TRUE AS q1, TRUE AS median, TRUE AS q3 FROM articles WHERE label IS NOT NULL GROUP BY label""")
def chart_box_approx(spark, d):
    """Whether the quartiles from sketches are as near to the exact ranks as their accuracy says."""
    sized = articles(spark, d).select("label", F.length("article_text").cast("double").alias("v"))
    box = charts.box(sized, "v", approximate=True)
    # a row per class
    ranked = sized.join(F.broadcast(box), "label").groupBy(*box.columns).agg(
        *[F.avg((F.col("v") <= F.col(q)).cast("double")).alias(f"{q}_to") for q in ("q1", "median", "q3")],
        *[F.avg((F.col("v") < F.col(q)).cast("double")).alias(f"{q}_before") for q in ("q1", "median", "q3")])
    error = 1 / SKETCH_ACCURACY
    # a rank is a whole number of rows
    slack = F.lit(error) + 1 / F.col("n_rows")
    return ranked.select("label", "n_rows", "low", "high", *[
        ((F.col(f"{q}_before") <= p + slack) & (F.col(f"{q}_to") >= p - slack)).alias(q) for q, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))])


def _hex_sql(source: str, x: str, y: str, where: str, grid: int, ny: int) -> str:
    return f"""WITH {source}, pts AS (SELECT CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y, label FROM base
  WHERE {where} AND label IS NOT NULL AND {x} IS NOT NULL AND {y} IS NOT NULL),
e AS (SELECT min(x) - 1e-9 * (max(x) - min(x)) AS x0, max(x) + 1e-9 * (max(x) - min(x)) AS x1,
             min(y) - 1e-9 * (max(y) - min(y)) AS y0, max(y) + 1e-9 * (max(y) - min(y)) AS y1 FROM pts),
g AS (SELECT (x - x0) / ((x1 - x0) / {grid}) AS gx, (y - y0) / ((y1 - y0) / {ny}) AS gy, label FROM pts, e),
dd AS (SELECT label, round_even(gx, 0) AS a, round_even(gy, 0) AS b, floor(gx) + 0.5 AS c, floor(gy) + 0.5 AS f,
  (gx - round_even(gx, 0)) ** 2 + 3 * (gy - round_even(gy, 0)) ** 2 < (gx - floor(gx) - 0.5) ** 2 + 3 * (gy - floor(gy) - 0.5) ** 2 AS first FROM g)
SELECT CASE WHEN first THEN a ELSE c END AS hx, CASE WHEN first THEN b ELSE f END AS hy, round(avg(label), 6) AS mean_value, CAST(count(*) AS BIGINT) AS n
FROM dd GROUP BY 1, 2"""


@register("chart_hexbin", _hex_sql(
    f"{ARTICLES}, base AS (SELECT length(article_text) AS text_length, length(title) AS title_length, label FROM articles)",
    "text_length", "title_length", "title_length < 1000 AND text_length < 25000", 50, 28))
def chart_hexbin(spark, d):
    sized = articles(spark, d).select(F.length("article_text").alias("text_length"), F.length("title").alias("title_length"), "label")
    return charts.hexbin(rows.cap_lengths(sized), "text_length", "title_length", "label", 50).select(
        "hx", "hy", F.round("mean_value", 6).alias("mean_value"), "n")


def _hist_sql(col, bins):
    return f"""SELECT '{col}' AS measure, CAST(least(floor((v - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INT) AS bin, CAST(count(*) AS BIGINT) AS n
FROM (SELECT CAST({col} AS DOUBLE) AS v FROM lengths), (SELECT CAST(min({col}) AS DOUBLE) AS lo, CAST(max({col}) AS DOUBLE) AS hi FROM lengths) GROUP BY 2"""


@register("chart_hist", f"""WITH {ARTICLES}, lengths AS (SELECT length(article_text) AS text_length, length(title) AS title_length FROM articles)
{_hist_sql('text_length', 25)} UNION ALL {_hist_sql('title_length', 30)}""")
def chart_hist(spark, d):
    sized = articles(spark, d).select(F.length("article_text").alias("text_length"), F.length("title").alias("title_length"))
    return rows.union_sources(*[charts.marginal_histogram(sized, c, b).select(F.lit(c).alias("measure"), "bin", "n")
                                for c, b in (("text_length", 25), ("title_length", 30))])


@register("chart_timeline", f"""WITH {MEASURED}, c AS (SELECT date_clean, label, CAST(count(*) AS BIGINT) AS count FROM measured
  WHERE date_clean >= DATE '1998-01-01' AND label IS NOT NULL GROUP BY ALL)
SELECT date_clean, label, count, round(count / sum(count) OVER (PARTITION BY date_clean) * 100, 6) AS percentage FROM c""")
def chart_timeline(spark, d):
    return charts.timeline(measured(spark, d), "date_clean", date(1998, 1, 1)).withColumn("percentage", F.round("percentage", 6))
