"""Joins."""

from pyspark.sql import functions as F

from ..operators import joins
from ..runtime import materialize
from .aggregates import CLASS_WORDS, class_words
from .core import ARTICLES, articles, register, table
from .locations import MENTIONS, NAMED_PLACES, mentions, named_places


@register("join_loc_left", f"""WITH {NAMED_PLACES} SELECT p.location, p.city, m.article_id FROM places p
LEFT JOIN mentions m ON lower(m.location) = p.location""")
def join_loc_left(spark, d):
    """All names of the gazetteer with all their mentions; the ones no text holds stay alone."""
    upper = materialize(mentions(spark, d), "mentions").withColumn("location", F.upper("location"))
    return joins.lookup_left_mentions(named_places(spark).select("location", "city"), upper).select("location", "city", "article_id")


@register("join_article_left", f"""WITH {MENTIONS} SELECT a.article_id, a.label, m.location FROM articles a LEFT JOIN mentions m USING (article_id)""")
def join_article_left(spark, d):
    return joins.article_locations_join(articles(spark, d).select("article_id", "label"), mentions(spark, d))


@register("join_semi_words", f"""WITH {ARTICLES}, {CLASS_WORDS}
SELECT label, word, cnt FROM class_words c WHERE EXISTS (SELECT 1 FROM class_words o WHERE o.word = c.word AND o.label = 1 - c.label)""")
def join_semi_words(spark, d):
    return joins.shared_words(joins.word_classes(class_words(spark, d)))


@register("join_anti_words", f"""WITH {ARTICLES}, {CLASS_WORDS}
SELECT CASE label WHEN 1 THEN 'true_only' ELSE 'false_only' END AS subset, word, cnt FROM class_words c
WHERE NOT EXISTS (SELECT 1 FROM class_words o WHERE o.word = c.word AND o.label = 1 - c.label)
UNION ALL SELECT 'common', word, CAST(sum(cnt) AS BIGINT) FROM class_words GROUP BY word HAVING count(*) = 2""")
def join_anti_words(spark, d):
    return joins.word_subsets(joins.word_classes(class_words(spark, d)))


@register("join_member_flag", """SELECT doc_id, source, CASE WHEN source IN (SELECT 'src' || n_nationkey FROM nation WHERE n_nationkey % 2 = 0) THEN 0 ELSE 1 END AS ignore
FROM documents""")
def join_member_flag(spark, d):
    known = table(spark, d, "nation").filter("n_nationkey % 2 = 0").select(F.concat(F.lit("src"), "n_nationkey").alias("name"))
    return joins.member_flag(table(spark, d, "documents").select("doc_id", "source"), "source", known, "name")


@register("join_first_match", """SELECT n_nationkey, first_customer, segment FROM nation LEFT JOIN (
  SELECT c_nationkey, min(c_custkey) AS first_customer, min_by(c_mktsegment, c_custkey) AS segment FROM customer GROUP BY c_nationkey) ON n_nationkey = c_nationkey""")
def join_first_match(spark, d):
    lookup = table(spark, d, "customer").select("c_nationkey", F.col("c_custkey").alias("first_customer"),
                                                F.col("c_mktsegment").alias("segment"))
    nations = table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"))
    return joins.lookup_first(nations, lookup, "n_nationkey", "c_nationkey", "first_customer")
