"""Whole jobs over the documents as three raw sources."""

from pyspark.sql import functions as F

from ..plans import articles as job
from ..plans import marts, terms
from ..runtime import shared_path
from ..sources import readers, writers
from .core import ARTICLES, LEMMAS, NOUNS, SENTIMENT, STOPWORDS, articles, literal, raw_sources, register, words_sql
from .locations import cities, regions, states
from .ngrams import CLOUDS


def build(spark, d):
    true, fake, test = raw_sources(spark, d)
    inputs = job.Inputs(true, fake, test, cities(spark), states(spark), regions(spark),
                        literal(spark, SENTIMENT, "word string, polarity double, subjectivity double"),
                        literal(spark, list(LEMMAS.items()), "form string, lemma string"))
    settings = job.Settings(default_year=2020, stopwords=STOPWORDS)
    return job.build_articles(spark, inputs, shared_path(spark, "articles"), settings)


@register("article_table")
def article_table(spark, d):
    final, _ = build(spark, d)
    return final.drop("article_text", "cleaned_text", "nlp_text", "nlp_title", "title").withColumn(
        "locationsfromarticle", F.array_join("locationsfromarticle", "|"))


@register("article_cloud_text", f"""WITH {ARTICLES} SELECT CAST(label AS TINYINT) AS label, md5(array_to_string({words_sql('lower(article_text)')}, ' ')) AS text_md5,
  CAST(year(date_clean) AS INT) AS year FROM articles""")
def article_cloud_text(spark, d):
    """The text of the word clouds as the term job saves it."""
    path = shared_path(spark, "cloud-text")
    rows = articles(spark, d).select("label", F.col("article_text").alias("cleaned_text"), F.year("date_clean").alias("year"))
    writers.save_by_year(terms.cloud_text(rows), path)
    return readers.read_wordcloud(spark, path, ["label", "text", "year"]).select("label", F.md5("text").alias("text_md5"), "year")


@register("article_map")
def article_map(spark, d):
    final, places = build(spark, d)
    return marts.articles_for_map(final, places.mentions, places.unique)


@register("article_dashboard")
def article_dashboard(spark, d):
    final, _ = build(spark, d)
    return marts.dashboard(final)


@register("article_terms", f"WITH {CLOUDS} SELECT year, ngram_size, subset, term, weight FROM clouds WHERE weight > 0")
def article_terms(spark, d):
    path = shared_path(spark, "terms")
    rows = articles(spark, d).select("label", F.col("article_text").alias("cleaned_text"), F.year("date_clean").alias("year"))
    terms.save_term_tables(terms.cloud_text(rows), path, literal(spark, NOUNS, "form string, lemma string"), stopwords=STOPWORDS)
    return spark.read.parquet(f"{path}/clouds")
