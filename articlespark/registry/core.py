"""Registration, the derived input views and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as tx
from ..runtime import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Small literal inputs, the same in Spark and in SQL; frequent corpus words, so that joins hit.
STOPWORDS = ["the", "of", "and", "to", "in", "is"]
SENTIMENT = [("the", 0.10, 0.30), ("that", -0.25, 0.55), ("with", 0.40, 0.75), ("que", -0.60, 0.90),
             ("was", 0.05, 0.20)]
LEMMAS = {"was": "be", "is": "be", "des": "de"}
NOUNS = [("que", "que"), ("der", "der"), ("with", "with"), ("des", "de")]

STOP_SQL = "(" + ", ".join(f"'{w}'" for w in STOPWORDS) + ")"
SENTIMENT_SQL = ("sentiment(word, polarity, subjectivity) AS (VALUES "
                 + ", ".join(f"('{w}', {p}::DOUBLE, {s}::DOUBLE)" for w, p, s in SENTIMENT) + ")")
NOUNS_SQL = "nouns(form, lemma) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in NOUNS) + ")"


def lemma_sql(w: str) -> str:
    return f"CASE {w} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in LEMMAS.items()) + f" ELSE {w} END"


# Character classes as the SQL engine's regular expressions take them
SP = r"\t-\r\x1c-\x20\x85\p{Z}"
WD = r"\p{L}\p{N}_"


def register(key: str, sql: str | None = None):
    """Add a query under ``key`` with its SQL; without SQL only its rows can be looked at."""
    def add(fn):
        if key in QUERIES:
            raise KeyError(key)
        QUERIES[key] = fn
        if sql:
            SQL[key] = sql.strip()
        return fn
    return add


TEXT_KEYS = {"documents": "doc_id", "pages": "page_id"}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{d}/{name}.parquet")
    return spread(df, TEXT_KEYS[name]) if name in TEXT_KEYS else df


def articles(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    return docs.join(labels.select("doc_id", "quality", "toxic"), "doc_id", "left").select(
        F.col("doc_id").alias("article_id"), tx.first_sentence(F.col("text")).alias("title"),
        F.col("text").alias("article_text"), F.col("lang").alias("subject"),
        F.col("source").alias("source_name"), F.col("quality").alias("label"), "toxic",
        F.date_add(F.to_date(F.lit("2015-01-01")), F.pmod(F.col("doc_id") * 37, F.lit(1461)).cast("int")).alias("date_clean"))


ARTICLES = """articles AS (
  SELECT d.doc_id AS article_id, string_split(d.text, '.')[1] AS title, d.text AS article_text,
         d.lang AS subject, d.source AS source_name, l.quality AS label, l.toxic AS toxic,
         DATE '2015-01-01' + CAST((d.doc_id * 37) % 1461 AS INT) AS date_clean
  FROM documents d LEFT JOIN labels l USING (doc_id))"""


def datelined(spark: SparkSession, d: str) -> DataFrame:
    """Articles, every third with a dateline."""
    text = F.when(F.col("article_id") % 3 == 0, F.concat(F.lit("NEW YORK/LONDON (Reuters) - "), "article_text"))
    return articles(spark, d).withColumn("article_text", text.otherwise(F.col("article_text")))


DATELINED = ARTICLES + """,
datelined AS (
  SELECT * REPLACE (CASE WHEN article_id % 3 = 0 THEN 'NEW YORK/LONDON (Reuters) - ' || article_text
                         ELSE article_text END AS article_text) FROM articles)"""


def order_dates(spark: SparkSession, d: str) -> DataFrame:
    """Orders with their date as free text in several spellings."""
    k, o = F.col("o_orderkey"), F.col("o_orderdate")
    raw = (F.when(k % 5 == 0, F.lit(None).cast("string")).when(k % 5 < 3, F.date_format(o, "MMMM d, yyyy"))
           .when(k % 5 == 3, F.date_format(o, "MMM d, yy")).otherwise(F.date_format(o, "dd-MMM-yy")))
    return table(spark, d, "orders").select("o_orderkey", raw.alias("raw_date"))


ORDER_DATES = """order_dates AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL
    WHEN o_orderkey % 5 < 3 THEN strftime(o_orderdate, '%B %-d, %Y')
    WHEN o_orderkey % 5 = 3 THEN strftime(o_orderdate, '%b %-d, %y')
    ELSE strftime(o_orderdate, '%d-%b-%y') END AS raw_date FROM orders)"""


def measured(spark: SparkSession, d: str) -> DataFrame:
    """Line items with their rates standing in for sentiment measures."""
    c = F.col
    return table(spark, d, "lineitem").select(
        c("l_orderkey"), c("l_linenumber"), c("l_partkey"), (c("l_discount") * 10 - 0.5).alias("article_polarity"),
        (c("l_tax") * 10 - 0.4).alias("title_polarity"), (c("l_discount") * 9).alias("article_subjectivity"),
        (c("l_tax") * 11).alias("title_subjectivity"), c("l_extendedprice").cast("bigint").alias("text_length"),
        c("l_quantity").cast("int").alias("title_length"), c("l_shipdate").cast("date").alias("date_clean"),
        F.when(c("l_returnflag") == "R", 1).when(c("l_returnflag") == "A", 0).alias("label"))


MEASURED = """measured AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_discount * 10 - 0.5::DOUBLE AS article_polarity,
         l_tax * 10 - 0.4::DOUBLE AS title_polarity, l_discount * 9 AS article_subjectivity,
         l_tax * 11 AS title_subjectivity, CAST(trunc(l_extendedprice) AS BIGINT) AS text_length,
         CAST(l_quantity AS INT) AS title_length, CAST(l_shipdate AS DATE) AS date_clean,
         CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS label FROM lineitem)"""


def raw_sources(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents as the three raw sources: real, dubious, unlabelled."""
    a = articles(spark, d)
    raw_date = (F.when(F.col("article_id") % 4 == 0, F.lit(None).cast("string"))
                .otherwise(F.date_format("date_clean", "MMMM d, yyyy")))
    title = F.when(F.col("article_id") % 6 != 0, F.col("title"))
    base = a.select(title.alias("title"), F.col("article_text").alias("text"), "subject",
                    raw_date.alias("date"), F.col("article_id").alias("row_id"), "label")
    return (base.filter("label = 1").drop("label"), base.filter("label = 0").drop("label"),
            base.filter("label IS NULL"))


def nlp_text(c):
    """Lower-case words without punctuation, single-spaced."""
    return tx.clean_text(c, [])


def nlp_sql(text: str) -> str:
    return rf"""trim(regexp_replace(lower(regexp_replace(regexp_replace(
    {text}, '<[^\n]*?>', '', 'g'), '[^{WD}{SP}]', '', 'g')), '[{SP}]+', ' ', 'g'))"""


NLP = f"nlp AS (SELECT article_id, label, date_clean, {nlp_sql('article_text')} AS nlp_text FROM articles)"


def words_sql(text: str) -> str:
    return rf"list_filter(regexp_split_to_array({text}, '[{SP}]+'), lambda w: w <> '')"


def no_punct_sql(text: str) -> str:
    return rf"regexp_replace({text}, '[^{WD}{SP}]', '', 'g')"


def strip_sql(text: str) -> str:
    return rf"regexp_replace({text}, '^[{SP}]+|[{SP}]+$', '', 'g')"


def tokens_sql(text: str) -> str:
    return rf"regexp_extract_all(lower({text}), '[{WD}]{{2,}}')"


def values_sql(rows) -> str:
    """Rows as the VALUES list both engines read."""
    def one(v):
        if v is None:
            return "NULL"
        return f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)" if isinstance(v, float) else str(v)
    return "VALUES " + ", ".join("(" + ", ".join(one(v) for v in r) + ")" for r in rows)


def literal(spark: SparkSession, rows, ddl: str) -> DataFrame:
    """A small literal table."""
    fields = StructType.fromDDL(ddl).fields
    df = spark.sql(f"SELECT * FROM {values_sql(rows)}").toDF(*[f.name for f in fields])
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])
