"""Sources and sinks: written to a fresh folder and read back."""

from pyspark.sql import functions as F

from ..plans import textmodel
from ..runtime import shared_path
from ..sources import readers, stages, writers
from .core import ARTICLES, articles, register, table
from .features import CELLS, PREDICTIONS, predictions


def _hashed_raw(df, origin):
    label = F.col("label") if "label" in df.columns else F.lit(None).cast("int")
    return df.select(F.lit(origin).alias("origin"), F.md5("title").alias("title_md5"), F.md5("text").alias("text_md5"), "subject", "date", label.alias("label"))


@register("src_csv_raw", f"""WITH {ARTICLES}
SELECT CASE label WHEN 1 THEN 'true' WHEN 0 THEN 'fake' ELSE 'test' END AS origin, md5(nullif(title, '')) AS title_md5, md5(article_text) AS text_md5,
  subject, strftime(date_clean, '%B %-d, %Y') AS date,
  CAST(CASE WHEN label IS NULL AND subject = 'en' THEN 1 WHEN label IS NULL AND subject <> 'de' THEN 0 END AS INT) AS label FROM articles""")
def src_csv_raw(spark, d):
    """All articles as files and back: real, dubious, a test file with its own columns, and two more test files, of which one is labelled."""
    rows = articles(spark, d).select("label", "title", F.col("article_text").alias("text"), "subject", F.date_format("date_clean", "MMMM d, yyyy").alias("date"))
    unlabelled, none = rows.filter("label IS NULL").drop("label"), F.lit(None).cast("string")
    files = {"true": rows.filter("label = 1").drop("label"), "fake": rows.filter("label = 0").drop("label"),
             "test": unlabelled.filter("subject = 'en'").select("title", "text", "subject", "date", none.alias("Column1"), none.alias("subject2"), F.lit(1).alias("label")),
             "more": unlabelled.filter("subject NOT IN ('en', 'de')").select(F.monotonically_increasing_id().alias("Unnamed: 0"), F.lit(0).alias("label"), "*"),
             "last": unlabelled.filter("subject = 'de'")}
    paths = {name: shared_path(spark, f"raw-{name}") for name in files}
    for name, df in files.items():
        writers.save_csv(df, paths[name])
    fake, true, test = readers.read_raw_articles(spark, paths["true"], paths["fake"], paths["test"], [paths["more"], paths["last"]])
    return _hashed_raw(fake, "fake").unionByName(_hashed_raw(true, "true")).unionByName(_hashed_raw(test, "test"))


@register("src_typed_pruned", "SELECT doc_id, lang, n_chars FROM documents")
def src_typed_pruned(spark, d):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return readers.read_typed(spark, f"{d}/documents.parquet", schema, ["doc_id", "lang", "n_chars"])


@register("src_trim_header", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def src_trim_header(spark, d):
    padded = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity").toDF(
        " l_orderkey", "l_linenumber ", "  l_quantity ")
    return readers.require_columns(readers.trim_headers(padded), ["l_orderkey", "l_linenumber", "l_quantity"])


@register("src_wordcount", f"""WITH {ARTICLES}
SELECT CAST(label AS TINYINT) AS label, md5(article_text) AS text_md5 FROM articles""")
def src_wordcount(spark, d):
    path = shared_path(spark, "wordcloud")
    writers.save_table(articles(spark, d).select(
        F.col("label").cast("tinyint").alias("label"), F.col("article_text").alias("text"),
        F.year("date_clean").alias("year")), path)
    return readers.read_wordcloud(spark, path).select("label", F.md5("text").alias("text_md5"))


_SAVED = f"""WITH {ARTICLES}
SELECT article_id, md5(title) AS title_md5, md5(article_text) AS text_md5, label, date_clean FROM articles"""


def _hashed(df):
    return df.select("article_id", F.md5("title").alias("title_md5"), F.md5("article_text").alias("text_md5"),
                     "label", "date_clean")


@register("sink_table", _SAVED)
def sink_table(spark, d):
    path = shared_path(spark, "table")
    writers.save_table(articles(spark, d), path)
    return _hashed(spark.read.parquet(path))


@register("sink_append", "SELECT item_id AS id, md5(text) AS text_md5 FROM benchmark "
                         "UNION ALL SELECT doc_id, md5(text) FROM documents")
def sink_append(spark, d):
    path = shared_path(spark, "appended")
    writers.append_rows(table(spark, d, "benchmark").select(F.col("item_id").alias("id"), "text"), path)
    writers.append_rows(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"), path)
    return spark.read.parquet(path).select("id", F.md5("text").alias("text_md5"))


@register("sink_by_year", f"""WITH {ARTICLES}
SELECT article_id, CASE WHEN year(date_clean) = 2016 THEN 'again' ELSE md5(article_text) END AS text_md5, CAST(year(date_clean) AS INT) AS year FROM articles""")
def sink_by_year(spark, d):
    """All years written, then one year written again: the others stay."""
    path = shared_path(spark, "by-year")
    rows = articles(spark, d).select("article_id", F.md5("article_text").alias("text_md5"), F.year("date_clean").alias("year"))
    writers.save_by_year(rows, path)
    writers.save_by_year(rows.filter("year = 2016").withColumn("text_md5", F.lit("again")), path)
    return spark.read.parquet(path).select("article_id", "text_md5", "year")


@register("stage_reuse", _SAVED)
def stage_reuse(spark, d):
    path = shared_path(spark, "stage")
    stages.stage(spark, path, lambda: articles(spark, d))

    def rebuild():
        raise AssertionError("a saved stage was built again")

    return _hashed(stages.stage(spark, path, rebuild, reuse=True))


@register("sink_metrics", f"""WITH {ARTICLES}
SELECT label, CAST(count(*) AS BIGINT) AS support FROM articles WHERE label IS NOT NULL GROUP BY label""")
def sink_metrics(spark, d):
    path = shared_path(spark, "metrics")
    writers.save_metrics(articles(spark, d).dropna(subset=["label"]).groupBy("label")
                         .agg(F.count("*").alias("support")), path)
    return spark.read.schema("label int, support bigint").json(path)


@register("sink_evaluation", f"""WITH {PREDICTIONS}, c AS (SELECT {CELLS} FROM predictions WHERE split = 'test'),
k AS (SELECT true_negatives AS hit, false_negatives AS wrong, false_positives AS missed FROM c UNION ALL SELECT true_positives, false_positives, false_negatives FROM c),
p AS (SELECT hit, hit / (hit + wrong) AS precision, hit / (hit + missed) AS recall, hit + missed AS support FROM k),
f AS (SELECT *, 2 * precision * recall / (precision + recall) AS f1 FROM p)
SELECT 'accuracy' AS measure, round(sum(hit) / sum(support), 6) AS value FROM f
UNION ALL SELECT 'precision', round(sum(precision * support) / sum(support), 6) FROM f
UNION ALL SELECT 'recall', round(sum(recall * support) / sum(support), 6) FROM f
UNION ALL SELECT 'f1-score', round(sum(f1 * support) / sum(support), 6) FROM f
UNION ALL SELECT 'mean_squared_error', round(avg((prediction - label) ** 2 * 16), 6) FROM predictions WHERE split = 'test'
UNION ALL SELECT 'article ' || article_id, prediction * 4 + 1 FROM predictions WHERE split = 'test'""")
def sink_evaluation(spark, d):
    """Reports of a classifier and of a regression saved and read: the summaries, and the regression's predictions."""
    path = shared_path(spark, "evaluation")
    test = predictions(spark, d).filter("split = 'test'")
    textmodel.save_evaluation(test, f"{path}/classes")
    textmodel.save_evaluation(test.withColumns({"label": F.col("label") * 4 + 1, "prediction": F.col("prediction") * 4 + 1}), f"{path}/numbers", "regression")

    def read(name):
        return spark.read.option("header", True).option("inferSchema", True).csv(f"{path}/{name}")

    def measures(df):
        pairs = F.array(*[F.struct(F.lit(c).alias("measure"), F.round(F.col(f"`{c}`"), 6).alias("value")) for c in df.columns])
        return df.select(F.explode(pairs).alias("p")).select("p.*")

    results = read("numbers/evaluation_results").select(F.concat_ws(" ", F.lit("article"), "article_id").alias("measure"), F.col("prediction").alias("value"))
    return measures(read("classes/evaluation_summary")).unionByName(measures(read("numbers/evaluation_summary"))).unionByName(results)
