"""Profiles."""

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import profile
from ..operators.ordering import SKETCH_ACCURACY
from ..runtime import materialize
from .core import ARTICLES, SP, articles, register, table

_COLS = ["article_id", "title", "article_text", "subject", "source_name", "label", "toxic", "date_clean"]


@register("prof_nulls", f"WITH {ARTICLES} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS nulls FROM articles" for c in _COLS))
def prof_nulls(spark, d):
    return profile.null_counts(articles(spark, d))


@register("prof_unique", f"WITH {ARTICLES} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT {c}) AS BIGINT) AS uniques FROM articles" for c in _COLS))
def prof_unique(spark, d):
    return profile.unique_counts(articles(spark, d))


@register("prof_dup_columns", "SELECT 'doc_id' AS \"column\", 2 AS occurrences, CAST(count(*) AS BIGINT) AS row_count "
                              "FROM documents JOIN labels USING (doc_id)")
def prof_dup_columns(spark, d):
    docs, labels = table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels")
    both = docs.join(labels, docs["doc_id"] == labels["doc_id"])
    rows = profile.duplicate_columns(spark, both.columns)
    return rows.withColumn("row_count", F.lit(both.count()))


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql(c):
    q = ", ".join(f"round(quantile_cont({c}, {p}), 6) AS {n}" for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")))
    return (f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
            f"round(min({c}), 6) AS min, {q}, round(max({c}), 6) AS max FROM lineitem")


@register("prof_describe", " UNION ALL ".join(_describe_sql(c) for c in _NUM))
def prof_describe(spark, d):
    out = profile.describe(table(spark, d, "lineitem"), _NUM)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")})


@register("prof_stage_counts", rf"""WITH {ARTICLES}
SELECT 'text given' AS step, CAST(count_if(article_text IS NOT NULL) AS BIGINT) AS rows_left FROM articles
UNION ALL SELECT 'title not blank', CAST(count_if(NOT regexp_full_match(title, '[{SP}]*')) AS BIGINT) FROM articles
UNION ALL SELECT 'labelled', CAST(count_if(NOT regexp_full_match(title, '[{SP}]*') AND label IS NOT NULL) AS BIGINT) FROM articles""")
def prof_stage_counts(spark, d):
    steps = {"text given": F.col("article_text").isNotNull(), "title not blank": ~tx.is_blank(F.col("title")),
             "labelled": F.col("label").isNotNull()}
    # counted by the job that writes the articles
    rows, seen = profile.watched(articles(spark, d), steps)
    materialize(rows, "watched")
    return profile.watched_counts(spark, seen, steps)


def _near_sql(c):
    return (f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
            f"round(min({c}), 6) AS min, round(max({c}), 6) AS max, TRUE AS p25, TRUE AS p50, TRUE AS p75 FROM lineitem")


@register("prof_describe_approx", " UNION ALL ".join(_near_sql(c) for c in _NUM))
def prof_describe_approx(spark, d):
    """Whether the quartiles from sketches are as near to the exact ranks as their accuracy says."""
    items = table(spark, d, "lineitem")
    out = profile.describe(items, _NUM, approximate=True)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in _NUM])
    quartiles = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    # a row per column
    ranked = items.select(F.explode(pairs).alias("p")).select("p.*").dropna().join(F.broadcast(out), "column").groupBy(*out.columns).agg(
        *[F.avg((F.col("value") <= F.col(q)).cast("double")).alias(f"{q}_to") for q in quartiles],
        *[F.avg((F.col("value") < F.col(q)).cast("double")).alias(f"{q}_before") for q in quartiles])
    slack = F.lit(1 / SKETCH_ACCURACY) + 1 / F.col("count")
    near = {q: (F.col(f"{q}_before") <= p + slack) & (F.col(f"{q}_to") >= p - slack) for q, p in quartiles.items()}
    return ranked.select("column", "count", *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", "max")], *[c.alias(q) for q, c in near.items()])
