"""Projections and filters."""

from datetime import date

from pyspark.sql import functions as F

from ..operators import rows
from .core import ARTICLES, MEASURED, SP, articles, measured, register, strip_sql, table


@register("tag_origin", """SELECT doc_id, 'true' AS file, 1 AS label FROM documents
UNION ALL SELECT item_id, 'test_data', NULL FROM benchmark""")
def tag_origin(spark, d):
    a = rows.tag_origin(table(spark, d, "documents").select("doc_id"), "true", 1)
    b = rows.tag_origin(table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id")), "test_data")
    return rows.union_sources(a, b)


@register("id_offset", "SELECT doc_id + 100000 AS doc_id, lang FROM documents")
def id_offset(spark, d):
    return rows.offset_ids(table(spark, d, "documents").select("doc_id", "lang"), "doc_id")


@register("misinfo_ingest", """SELECT md5(text) AS text_md5, md5(string_split(text, '.')[1]) AS title_md5,
'UNKNOWN' AS subject, 'None' AS date, 0 AS label FROM documents""")
def misinfo_ingest(spark, d):
    raw = table(spark, d, "documents").select("doc_id", "text")
    return rows.text_only_source(raw, 0, index_col="doc_id").select(
        F.md5("text").alias("text_md5"), F.md5("title").alias("title_md5"), "subject", "date", "label")


@register("title_backfill", f"""WITH {ARTICLES}
SELECT article_id, md5(CASE WHEN article_id % 6 <> 0 THEN title ELSE string_split(article_text, '.')[1] END) AS title_md5
FROM articles""")
def title_backfill(spark, d):
    holes = articles(spark, d).withColumn("title", F.when(F.col("article_id") % 6 != 0, F.col("title")))
    return rows.backfill_title(holes, text="article_text").select("article_id", F.md5("title").alias("title_md5"))


@register("drop_null_text", f"WITH {ARTICLES} SELECT article_id, label FROM articles "
                            "WHERE label IS NOT NULL AND article_text IS NOT NULL AND article_id % 6 <> 0")
def drop_null_text(spark, d):
    holes = articles(spark, d).withColumn("article_text", F.when(F.col("article_id") % 6 != 0, F.col("article_text")))
    return rows.drop_null(holes, ["article_text", "label"]).select("article_id", "label")


@register("drop_blank_text", rf"""WITH {ARTICLES},
blanks AS (SELECT article_id, CASE WHEN article_id % 5 = 0 THEN ' ' || chr(160) ELSE title END AS title FROM articles)
SELECT article_id, md5(title) AS title_md5 FROM blanks WHERE regexp_replace(title, '[{SP}]+', '', 'g') <> ''""")
def drop_blank_text(spark, d):
    blanks = articles(spark, d).withColumn(
        "title", F.when(F.col("article_id") % 5 == 0, F.lit("  ")).otherwise(F.col("title")))
    return rows.drop_blank(blanks, ["title", "article_text"]).select("article_id", F.md5("title").alias("title_md5"))


@register("empty_text_to_title", f"""WITH {ARTICLES},
t AS (SELECT article_id, title, CASE WHEN article_id % 4 = 0 THEN '' ELSE article_text END AS cleaned_text FROM articles),
f AS (SELECT article_id, CASE WHEN length(cleaned_text) = 0 THEN title ELSE cleaned_text END AS c FROM t)
SELECT article_id, md5(c) AS text_md5, CAST(length(c) AS INT) AS text_length FROM f""")
def empty_text_to_title(spark, d):
    holes = articles(spark, d).withColumn("cleaned_text", F.when(F.col("article_id") % 4 == 0, "")
                                          .otherwise(F.col("article_text")))
    return rows.empty_text_to_title(holes).select("article_id", F.md5("cleaned_text").alias("text_md5"), "text_length")


@register("fill_defaults", f"""WITH {ARTICLES}
SELECT article_id, CASE WHEN article_id % 3 = 0 THEN 'Unknown' ELSE subject END AS subject,
       CASE WHEN article_id % 4 < 2 THEN 'UNKNOWN (Unknown)' ELSE source_name END AS source FROM articles""")
def fill_defaults(spark, d):
    k = F.col("article_id")
    holes = articles(spark, d).select(
        "article_id", F.when(k % 3 != 0, F.col("subject")).alias("subject"),
        F.when(k % 4 == 0, F.lit(None)).when(k % 4 == 1, "").otherwise(F.col("source_name")).alias("source"))
    return rows.fill_defaults(holes, {"subject": "Unknown", "source": "UNKNOWN (Unknown)"}, empty_too=["source"])


_REGION_HOLES = """holes AS (SELECT c_custkey,
  CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS state,
  CASE WHEN c_custkey % 3 = 0 THEN n_name END AS country,
  CASE WHEN c_custkey % 5 = 0 THEN 'Part of ' || r_name END AS subcontinent, r_name AS continent
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def _region_holes(spark, d):
    c, k = F.col, F.col("c_custkey")
    joined = (table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), c("c_nationkey") == c("n_nationkey"))
              .join(F.broadcast(table(spark, d, "region")), c("n_regionkey") == c("r_regionkey")))
    return joined.select(k, F.when(k % 2 == 0, c("c_mktsegment")).alias("state"),
                         F.when(k % 3 == 0, c("n_name")).alias("country"),
                         F.when(k % 5 == 0, F.concat(F.lit("Part of "), c("r_name"))).alias("subcontinent"),
                         c("r_name").alias("continent"))


@register("fill_hierarchy", f"""WITH {_REGION_HOLES}
SELECT c_custkey, coalesce(state, country, subcontinent, continent) AS state,
       coalesce(country, subcontinent, continent) AS country, coalesce(subcontinent, continent) AS subcontinent, continent
FROM holes""")
def fill_hierarchy(spark, d):
    return rows.fill_region_hierarchy(_region_holes(spark, d))


@register("drop_columns", "SELECT doc_id, lang FROM documents")
def drop_columns(spark, d):
    return rows.drop_columns(table(spark, d, "documents"), ["text", "source", "n_chars", "not_there"])


@register("rename_columns", "SELECT doc_id, md5(text) AS article_text, source AS source_name FROM documents")
def rename_columns(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.md5("text").alias("text"), "source")
    return rows.rename_columns(docs, {"text": "article_text", "source": "source_name"})


@register("value_remap", """SELECT doc_id, CASE quality WHEN 1 THEN 'True News' WHEN 0 THEN 'Fake News' END AS label_name,
CASE quality WHEN 0 THEN 1 WHEN 1 THEN 5 END AS realness_score FROM labels""")
def value_remap(spark, d):
    q = F.col("quality")
    return table(spark, d, "labels").select("doc_id", rows.remap(q, rows.label_names()).alias("label_name"),
                                            rows.remap(q, rows.REALNESS).alias("realness_score"))


@register("filter_named", f"""WITH {ARTICLES}
SELECT 'fake_news_ftr' AS filter, article_id FROM articles WHERE label = 0
UNION ALL SELECT 'true_news_ftr', article_id FROM articles WHERE label = 1
UNION ALL SELECT 'validdates_ftr', article_id FROM articles WHERE date_clean > DATE '2001-01-01'
UNION ALL SELECT 'locations_ftr', article_id FROM articles WHERE toxic = 1""")
def filter_named(spark, d):
    a = articles(spark, d).select("article_id", "label", F.col("date_clean").alias("date"), F.col("toxic").alias("ignore"))
    return rows.matching_filters(a, ["article_id"])


@register("filter_date_min", f"""WITH {MEASURED}
SELECT l_orderkey, l_linenumber, date_clean FROM measured WHERE date_clean >= DATE '1998-01-01'""")
def filter_date_min(spark, d):
    return rows.filter_from_date(measured(spark, d), "date_clean", date(1998, 1, 1)).select(
        "l_orderkey", "l_linenumber", "date_clean")


@register("filter_date_range", f"""WITH {ARTICLES}
SELECT article_id, date_clean, 'given' AS bounds FROM articles WHERE date_clean BETWEEN DATE '2016-01-01' AND DATE '2016-12-31'
UNION ALL SELECT article_id, date_clean, 'own' FROM articles
WHERE date_clean BETWEEN (SELECT min(date_clean) FROM articles) AND (SELECT max(date_clean) FROM articles)""")
def filter_date_range(spark, d):
    a = articles(spark, d).select("article_id", "date_clean")
    given = rows.filter_date_range(a, "date_clean", date(2016, 1, 1), date(2016, 12, 31))
    return rows.union_sources(given.withColumn("bounds", F.lit("given")),
                              rows.filter_date_range(a, "date_clean").withColumn("bounds", F.lit("own")))


@register("filter_text_class", f"WITH {ARTICLES} SELECT article_id FROM articles "
                               "WHERE label = 0 AND year(date_clean) = 2016")
def filter_text_class(spark, d):
    a = articles(spark, d).withColumn("year", F.year("date_clean"))
    return rows.filter_equal(a, label=0, year=2016).select("article_id")


@register("filter_near_zero", f"""WITH {MEASURED}, n AS (SELECT l_orderkey, l_linenumber,
  CASE WHEN abs(title_subjectivity) >= 0.15 THEN title_subjectivity END AS t,
  CASE WHEN abs(article_subjectivity) >= 0.15 THEN article_subjectivity END AS a FROM measured)
SELECT l_orderkey, l_linenumber, round(t, 6) AS title_subjectivity, round(a, 6) AS article_subjectivity
FROM n WHERE t IS NOT NULL OR a IS NOT NULL""")
def filter_near_zero(spark, d):
    cols = ["title_subjectivity", "article_subjectivity"]
    return rows.null_near_zero(measured(spark, d), cols, 0.15).select(
        "l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in cols])


@register("filter_length_caps", f"""WITH {MEASURED}
SELECT l_orderkey, l_linenumber, text_length FROM measured WHERE title_length < 1000 AND text_length < 25000""")
def filter_length_caps(spark, d):
    return rows.cap_lengths(measured(spark, d)).select("l_orderkey", "l_linenumber", "text_length")


@register("cast_columns", """SELECT o_orderkey, TRY_CAST(left(o_orderpriority, 1) AS INT) AS priority,
TRY_CAST(o_orderpriority AS INT) AS unreadable, CAST(o_custkey AS VARCHAR) AS customer FROM orders""")
def cast_columns(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("priority"),
                                         F.col("o_orderpriority").alias("unreadable"), F.col("o_custkey").alias("customer"))
    return rows.cast_columns(o, {"priority": "int", "unreadable": "int", "customer": "string"})


@register("trim_all_strings", f"""SELECT doc_id, {strip_sql("'  ' || lang || ' '")} AS lang,
md5({strip_sql("chr(9) || text || chr(10) || ' '")}) AS text_md5 FROM documents""")
def trim_all_strings(spark, d):
    padded = table(spark, d, "documents").select(
        "doc_id", F.concat(F.lit("  "), "lang", F.lit(" ")).alias("lang"),
        F.concat(F.lit("\t"), "text", F.lit("\n ")).alias("text"))
    return rows.trim_strings(padded).select("doc_id", "lang", F.md5("text").alias("text_md5"))


@register("rows_with_null", f"WITH {ARTICLES} SELECT article_id, label FROM articles WHERE label IS NULL OR toxic IS NULL "
                            "OR article_text IS NULL OR title IS NULL OR subject IS NULL OR source_name IS NULL")
def rows_with_null(spark, d):
    return rows.rows_with_null(articles(spark, d)).select("article_id", "label")


@register("union_by_name", """SELECT doc_id AS id, md5(text) AS text_md5, lang, NULL::VARCHAR AS role FROM documents
UNION ALL SELECT item_id, md5(text), NULL, NULL FROM benchmark
UNION ALL SELECT conv_id, md5(text), NULL, role FROM conversations""")
def union_by_name(spark, d):
    text = F.md5("text").alias("text_md5")
    return rows.union_sources(
        table(spark, d, "documents").select(F.col("doc_id").alias("id"), text, "lang"),
        table(spark, d, "benchmark").select(F.col("item_id").alias("id"), text),
        table(spark, d, "conversations").select(F.col("conv_id").alias("id"), text, "role"))
