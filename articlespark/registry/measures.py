"""Arithmetic on measures."""

from pyspark.sql import functions as F

from ..functions import measures as ms
from ..operators import ngrams
from ..operators.aggregates import DASHBOARD_MEASURES, dashboard_measures
from .core import ARTICLES, MEASURED, articles, measured, register

MIXED = MEASURED + """, mixed AS (SELECT *,
  (article_polarity + title_polarity) / 2 AS overall_polarity, (article_subjectivity + title_subjectivity) / 2 AS overall_subjectivity,
  article_polarity - title_polarity AS contradiction_polarity, article_subjectivity - title_subjectivity AS contradiction_subjectivity,
  CASE WHEN title_polarity <> 0 THEN (article_polarity - title_polarity) / title_polarity ELSE 0 END AS polarity_variations,
  CASE WHEN title_subjectivity <> 0 THEN (article_subjectivity - title_subjectivity) / title_subjectivity ELSE 0 END AS subjectivity_variations
  FROM measured)"""
_MIX = ["overall_polarity", "overall_subjectivity", "contradiction_polarity", "contradiction_subjectivity",
        "polarity_variations", "subjectivity_variations"]


@register("sentiment_mix", f"WITH {MIXED} SELECT l_orderkey, l_linenumber, "
                           + ", ".join(f"round({c}, 6) AS {c}" for c in _MIX) + " FROM mixed")
def sentiment_mix(spark, d):
    return measured(spark, d).withColumns(ms.sentiment_mix()).select(
        "l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in _MIX])


@register("round_measures", f"WITH {MIXED} SELECT l_orderkey, l_linenumber, "
                            + ", ".join(f"round_even({src} * 100::DOUBLE, 0) / 100 AS {name}"
                                        for name, src in DASHBOARD_MEASURES.items()) + " FROM mixed")
def round_measures(spark, d):
    m = measured(spark, d).withColumns(ms.sentiment_mix()).withColumn("locationsfromarticle", F.array(F.lit("x")))
    return dashboard_measures(m).select("l_orderkey", "l_linenumber", *DASHBOARD_MEASURES)


@register("round_tens", f"WITH {MEASURED} SELECT l_orderkey, l_linenumber, CAST(round_even(text_length / 10, 0) * 10 AS BIGINT) "
                        "AS text_length_value FROM measured")
def round_tens(spark, d):
    return measured(spark, d).select("l_orderkey", "l_linenumber",
                                     ms.round_to_tens(F.col("text_length")).alias("text_length_value"))


@register("list_count", """SELECT doc_id, CAST(len(string_split(text, ',')) - 1 AS INT) AS n,
CAST(greatest(len(string_split(text, ',')) - 1, 1) AS INT) AS n_as_text FROM documents""")
def list_count(spark, d):
    from .core import table
    pieces = F.split("text", ",")
    docs = table(spark, d, "documents").select("doc_id", F.slice(pieces, 2, F.size(pieces)).alias("items"))
    return docs.select("doc_id", ms.list_count(F.col("items")).alias("n"),
                       ms.list_count(F.col("items"), empty_is_one=True).alias("n_as_text"))


@register("ngram_threshold", f"""WITH {ARTICLES}, y AS (SELECT CAST(year(date_clean) AS INT) AS year, CAST(count(*) AS BIGINT) AS num_rows
  FROM articles GROUP BY ALL)
SELECT year, num_rows, n AS ngram_size, CAST(greatest(floor(num_rows * frac), low) AS BIGINT) AS threshold FROM y,
  (VALUES (1, 0.005::DOUBLE, 10), (2, 0.003::DOUBLE, 5), (3, 0.002::DOUBLE, 3)) t(n, frac, low)""")
def ngram_threshold(spark, d):
    return ngrams.thresholds_by_year(articles(spark, d).withColumn("year", F.year("date_clean")))
