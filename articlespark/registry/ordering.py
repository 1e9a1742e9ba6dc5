"""First copies, dense ids, sorts, limits and samples."""

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import aggregates, ngrams, ordering, rows, sampling
from ..operators.joins import rest_of
from .core import ARTICLES, STOP_SQL, STOPWORDS, articles, register, table, tokens_sql


@register("win_dedupe_first", f"""WITH {ARTICLES}
SELECT article_id, md5(article_text) AS text_md5 FROM articles
QUALIFY row_number() OVER (PARTITION BY article_text ORDER BY article_id % 3, article_id) = 1""")
def win_dedupe_first(spark, d):
    a = articles(spark, d).withColumn("file_no", F.col("article_id") % 3)
    return ordering.keep_first(a, "article_text", ["file_no", "article_id"]).select(
        "article_id", F.md5("article_text").alias("text_md5"))


@register("win_row_id", f"""WITH {ARTICLES}
SELECT source_name, article_id AS row_id, CAST(row_number() OVER (ORDER BY source_name, article_id) - 1 AS BIGINT) AS article_id FROM articles""")
def win_row_id(spark, d):
    a = articles(spark, d).select("source_name", F.col("article_id").alias("row_id"))
    return ordering.dense_ids(a, ["source_name", "row_id"])


@register("sort_multi", """SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT) AS n
FROM orders GROUP BY ALL ORDER BY year, month, o_orderstatus, o_orderpriority""")
def sort_multi(spark, d):
    o = table(spark, d, "orders").withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    keys = ["year", "month", "o_orderstatus", "o_orderpriority"]
    return aggregates.count_by(o, keys, "n").orderBy(*keys)


@register("sort_dim_total", f"""WITH {ARTICLES} SELECT source_name, CAST(count(*) AS BIGINT) AS total FROM articles
WHERE label IS NOT NULL GROUP BY source_name ORDER BY total DESC, source_name""")
def sort_dim_total(spark, d):
    counts = aggregates.count_by(articles(spark, d), ["source_name", "label"])
    return counts.groupBy("source_name").agg(F.sum("count").alias("total")).orderBy(F.desc("total"), "source_name")


_BIGRAMS = f"""kept AS (SELECT article_id, label, list_filter({tokens_sql('title')}, lambda w: w NOT IN {STOP_SQL}) AS t FROM articles WHERE label IS NOT NULL),
pos AS (SELECT article_id, label, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM kept),
pairs AS (SELECT label, w || ' ' || lead(w) OVER (PARTITION BY article_id ORDER BY i) AS term FROM pos)"""


@register("topk_ngrams", f"""WITH {ARTICLES}, {_BIGRAMS}, c AS (SELECT label, term, CAST(count(*) AS BIGINT) AS cnt FROM pairs WHERE term IS NOT NULL GROUP BY ALL)
SELECT label, term, cnt, CAST(row_number() OVER (PARTITION BY label ORDER BY cnt DESC, term) AS INT) AS rank FROM c
QUALIFY row_number() OVER (PARTITION BY label ORDER BY cnt DESC, term) <= 10""")
def topk_ngrams(spark, d):
    counts = ngrams.phrase_counts_by_class(articles(spark, d), "title", "label", 2, STOPWORDS)
    return sampling.top_per_group(counts, "label", 10, "cnt", "term")


@register("topk_sources", f"""WITH {ARTICLES}, t AS (
 SELECT 'source_name' AS dim, source_name AS value, CAST(count_if(label = 0) AS BIGINT) AS dubious, CAST(count_if(label = 1) AS BIGINT) AS "real" FROM articles GROUP BY ALL
 UNION ALL SELECT 'subject', subject, CAST(count_if(label = 0) AS BIGINT), CAST(count_if(label = 1) AS BIGINT) FROM articles GROUP BY ALL)
SELECT dim, value, dubious, "real" FROM t QUALIFY row_number() OVER (PARTITION BY dim ORDER BY dubious DESC, value) <= 5""")
def topk_sources(spark, d):
    a = articles(spark, d)
    tops = [sampling.top(ngrams.class_totals(a, dim), 5, "dubious", dim).select(
        F.lit(dim).alias("dim"), F.col(dim).alias("value"), "dubious", "real") for dim in ("source_name", "subject")]
    return rows.union_sources(*tops)


@register("sample_n", """SELECT o_orderkey, o_orderstatus FROM orders
ORDER BY substr(md5(concat_ws(':', o_orderkey, 42)), 1, 12), o_orderkey LIMIT 10000""")
def sample_n(spark, d):
    return sampling.sample_rows(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey")


@register("sample_frac", "SELECT doc_id, source FROM documents WHERE substr(md5(concat_ws(':', doc_id, 42)), 1, 12) < '800000000000'")
def sample_frac(spark, d):
    return sampling.sample_share(table(spark, d, "documents").select("doc_id", "source"), "doc_id", 0.5)


@register("join_anti_split", "SELECT doc_id FROM documents WHERE substr(md5(concat_ws(':', doc_id, 42)), 1, 12) >= '800000000000'")
def join_anti_split(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    return rest_of(docs, sampling.sample_share(docs, "doc_id", 0.5), "doc_id")


@register("ml_split", """SELECT doc_id, CASE WHEN substr(md5(concat_ws(':', doc_id, 42)), 1, 12) < '333333333334'
THEN 'test' ELSE 'train' END AS split FROM labels""")
def ml_split(spark, d):
    return sampling.split(table(spark, d, "labels").select("doc_id"), "doc_id")


@register("head_n", "SELECT doc_id, md5(text) AS text_md5 FROM documents ORDER BY doc_id LIMIT 50")
def head_n(spark, d):
    return sampling.head(table(spark, d, "documents").select("doc_id", F.md5("text").alias("text_md5")), 50, ["doc_id"])


@register("title_word_counts", f"""WITH {ARTICLES}, w AS (SELECT unnest({tokens_sql('title')}) AS word FROM articles)
SELECT word, CAST(count(*) AS BIGINT) AS cnt FROM w WHERE word NOT IN {STOP_SQL} GROUP BY word""")
def title_word_counts(spark, d):
    return ngrams.word_counts(articles(spark, d), "title", STOPWORDS)


@register("tokenize_words", f"""WITH w AS (SELECT unnest({tokens_sql('text')}) AS word FROM documents)
SELECT word, CAST(count(*) AS BIGINT) AS cnt FROM w GROUP BY word""")
def tokenize_words(spark, d):
    docs = table(spark, d, "documents").select(F.explode(tx.word_tokens(F.col("text"))).alias("word"))
    return docs.groupBy("word").agg(F.count("*").alias("cnt"))
