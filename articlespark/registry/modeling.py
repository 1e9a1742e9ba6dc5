"""Fitted models; their rows depend on the learner, so only rows and metrics can be looked at."""

from pyspark.sql import functions as F

from ..functions import dates as dt
from ..functions import text as tx
from ..operators import features as ft
from ..operators import models, sampling, vectors
from ..plans import tabular as tabular_job
from ..plans import textmodel
from ..runtime import compact, materialize, release, shared_path
from .core import ARTICLES, STOP_SQL, STOPWORDS, articles, no_punct_sql, register, tokens_sql


def labelled(spark, d):
    """Labelled articles as the text model reads them."""
    return articles(spark, d).select("article_id", "title", F.col("article_text").alias("cleaned_text"), "label")


def tabular(spark, d):
    """Labelled articles with numeric features."""
    title, text, day = F.col("title"), F.col("article_text"), F.col("date_clean")
    numeric = {
        "title_length": F.length(title), "text_length": F.length(text),
        "title_words": F.size(tx.word_tokens(title)), "text_words": F.size(tx.word_tokens(text)),
        "commas": F.regexp_count(text, F.lit(",")), "lines": F.regexp_count(text, F.lit("\n")),
        "digits": F.regexp_count(text, F.lit("[0-9]")), "toxic": F.coalesce("toxic", F.lit(0)),
        **{n: c for n, c in dt.date_features(day).items() if n != "day_of_week"},
    }
    rows = articles(spark, d).dropna(subset=["label"]).select("article_id", "label", *[c.alias(n) for n, c in numeric.items()])
    return rows, list(numeric)


@register("ml_tfidf_vectors", f"""WITH {ARTICLES}, w AS (SELECT article_id, unnest({tokens_sql('article_text')}) AS term FROM articles WHERE label IS NOT NULL),
k AS (SELECT term FROM w WHERE term NOT IN {STOP_SQL} GROUP BY term ORDER BY count(*) DESC, term LIMIT 1000)
SELECT a.article_id, a.label, CASE WHEN count(DISTINCT k.term) > 0 THEN 1.0::DOUBLE ELSE 0.0 END AS norm, CAST(count(DISTINCT k.term) AS INT) AS terms
FROM articles a LEFT JOIN w USING (article_id) LEFT JOIN k USING (term) WHERE a.label IS NOT NULL GROUP BY a.article_id, a.label""")
def ml_tfidf_vectors(spark, d):
    from pyspark.ml.functions import vector_to_array
    rows = models.load_text(labelled(spark, d))
    model = models.tfidf_pipeline(rows, "text", stopwords=STOPWORDS)
    v = vector_to_array("features")
    return model.transform(rows).select("article_id", "label", F.round(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x), 6).alias("norm"),
                                        F.size(F.filter(v, lambda x: x > 0)).alias("terms"))


_TERMS = f"""WITH {ARTICLES}, w AS (SELECT article_id, label, unnest({tokens_sql(no_punct_sql("coalesce(title, '')") + " || ' ' || " + no_punct_sql("coalesce(article_text, '')"))}) AS term
  FROM articles),
c AS (SELECT article_id, label, term, count(*) AS tf FROM w WHERE term NOT IN {STOP_SQL} GROUP BY article_id, label, term),
i AS (SELECT term, ln((1 + (SELECT count(*) FROM articles WHERE label IS NOT NULL))::DOUBLE / (1 + count(*))) + 1 AS idf FROM c
      WHERE label IS NOT NULL GROUP BY term),
v AS (SELECT article_id, label, term, tf * idf AS value FROM c JOIN i USING (term)),
t AS (SELECT *, value / sqrt(sum(value * value) OVER (PARTITION BY article_id)) AS weight FROM v)"""


@register("ml_count_tfidf", _TERMS + " SELECT article_id, term, round(weight, 6) AS weight FROM t WHERE label IS NOT NULL")
def ml_count_tfidf(spark, d):
    rows = labelled(spark, d).dropna(subset=["label"])
    model = vectors.fit_terms(rows, "article_id", ["title", "cleaned_text"], STOPWORDS)
    return model.weights(rows, "article_id").withColumn("weight", F.round("weight", 6))


@register("ml_count_vectors", _TERMS + """ SELECT a.article_id, a.label, (SELECT count(*) FROM i) AS size, count(t.term) AS terms,
  round(coalesce(sum(t.weight), 0), 6) AS total FROM articles a LEFT JOIN t USING (article_id) GROUP BY a.article_id, a.label""")
def ml_count_vectors(spark, d):
    """The saved and reloaded model on all articles, those it was not fitted on with the terms it knows."""
    rows = labelled(spark, d)
    path = shared_path(spark, "terms")
    vectors.fit_terms(rows.dropna(subset=["label"]), "article_id", ["title", "cleaned_text"], STOPWORDS).save(path)
    out = vectors.TermModel.load(spark, path).transform(rows, "article_id", ["label"])
    v = F.col("features")
    return vectors.with_parts(out, "features").select(
        "article_id", "label", v["size"].cast("long").alias("size"), F.size(v["indices"]).cast("long").alias("terms"),
        F.round(F.aggregate(v["values"], F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


def _text_model(spark, d, kind):
    _, scored = textmodel.train(labelled(spark, d), kind, stopwords=STOPWORDS)
    return scored


# what a fitted model's rows are known to be, whatever it has learned: each labelled row once, on its side of the split
_SPLIT = "CASE WHEN substr(md5(concat_ws(':', article_id, 42)), 1, 12) < '333333333334' THEN 'test' ELSE 'train' END"
_SCORED = f"WITH {ARTICLES} SELECT article_id, {_SPLIT} AS split, label, TRUE AS in_range FROM articles WHERE label IS NOT NULL"


@register("ml_rf_class", _SCORED)
def ml_rf_class(spark, d):
    return _text_model(spark, d, "classification").select("article_id", "split", "label", F.col("prediction").isin(0.0, 1.0).alias("in_range"))


@register("ml_rf_reg", _SCORED.replace(" label, TRUE", " CASE label WHEN 1 THEN 5 ELSE 1 END AS label, TRUE"))
def ml_rf_reg(spark, d):
    return _text_model(spark, d, "regression").select("article_id", "split", "label", F.col("prediction").between(1, 5).alias("in_range"))


@register("model_store", f"WITH {ARTICLES} SELECT article_id, label, len({tokens_sql('article_text')}) AS tokens, TRUE AS same FROM articles WHERE label IS NOT NULL")
def model_store(spark, d):
    """The loaded vectoriser against the fitted one: same tokens, same vectors."""
    path = shared_path(spark, "model")
    rows = models.load_text(labelled(spark, d))
    fitted = models.tfidf_pipeline(rows, "text", stopwords=STOPWORDS)
    models.save_model(fitted, path)

    def made(model):
        return model.transform(rows).select("article_id", "label", F.size("features_tokens").cast("long").alias("tokens"),
                                            F.sha2(F.to_json(F.struct("features")), 256).alias("vector"))

    before = made(fitted).select("article_id", F.col("vector").alias("fitted"))
    return made(models.load_model(path)).join(before, "article_id").select("article_id", "label", "tokens", (F.col("vector") == F.col("fitted")).alias("same"))


@register("ml_score", f"WITH {ARTICLES} SELECT article_id, label, TRUE AS in_range, TRUE AS same FROM articles")
def ml_score(spark, d):
    """All articles scored by the loaded model and by the fitted one."""
    rows = labelled(spark, d)
    model = textmodel.train(rows, "classification", stopwords=STOPWORDS)[0]
    path = shared_path(spark, "scoring-model")
    models.save_model(model, path)
    batch = rows.withColumnRenamed("cleaned_text", "text")
    fitted = materialize(models.score(model, batch, ["article_id"]).select("article_id", F.struct("predicted", "realness").alias("fitted")), "fitted")
    # the driver holds one forest at a time
    del model
    release(spark)
    loaded = models.score(models.load_model(path), batch, ["article_id", "label"])
    likely = F.col("probability_real")
    sound = (likely.between(0, 1) & (F.col("predicted") == (likely > 0.5).cast("int")) | (likely == 0.5)) & (F.abs(1 + 4 * likely - F.col("realness")) < 1e-9)
    return loaded.join(fitted, "article_id").select("article_id", "label", sound.alias("in_range"),
                                                    ((F.col("predicted") == F.col("fitted.predicted")) & (F.col("realness") == F.col("fitted.realness"))).alias("same"))


@register("ml_tree", _SCORED)
def ml_tree(spark, d):
    from pyspark.ml.functions import vector_to_array
    rows, names = tabular(spark, d)
    data = sampling.split(models.assemble(rows, names), "article_id")
    model = models.tree_classifier(depth=10).fit(data.filter("split = 'train'"))
    likely = F.get(vector_to_array("probability"), F.lit(1))
    return model.transform(data).select("article_id", "split", "label", (F.col("prediction").isin(0.0, 1.0) & likely.between(0, 1)).alias("in_range"))


def _scaled(spark, d):
    rows, names = tabular(spark, d)
    return ft.fit_features(rows, numeric=names).transform(rows, ["article_id", "label"]), names


@register("ml_linear", f"""WITH {ARTICLES} SELECT estimator, article_id, {_SPLIT} AS split, label, TRUE AS in_range
FROM articles, (SELECT unnest(['linear_svc', 'hinge', 'log_loss']) AS estimator) WHERE label IS NOT NULL""")
def ml_linear(spark, d):
    data, _ = _scaled(spark, d)
    data = sampling.split(data, "article_id")
    train = compact(data.filter("split = 'train'"), "training").persist()
    out = None
    for name, estimator in models.linear_models(train.count()).items():
        model = estimator.fit(train)
        part = model.transform(data).select(F.lit(name).alias("estimator"), "article_id", "split", "label", F.col("prediction").isin(0.0, 1.0).alias("in_range"))
        out = part if out is None else out.unionByName(part)
    return out


@register("ml_grid_cv", """SELECT unnest(['linear_svc', 'hinge', 'log_loss']) AS estimator, unnest([6, 3, 3]) AS settings, TRUE AS in_range, TRUE AS best_first""")
def ml_grid_cv(spark, d):
    """Per estimator, its settings, whether their scores are shares in order, and whether the best stands first."""
    rows = labelled(spark, d).dropna(subset=["label"]).withColumnRenamed("cleaned_text", "text")
    vectors = models.tfidf_pipeline(rows, "text", stopwords=STOPWORDS).transform(rows).select("article_id", "label", "features")
    scores = models.grid_search(vectors, models.model_grids(rows.count()))
    sound = F.col("min_score").between(0, F.col("mean_score")) & F.col("max_score").between(F.col("mean_score"), 1)
    # one row per setting
    found = scores.groupBy("estimator").agg(F.countDistinct("setting").alias("settings"), F.bool_and(sound).alias("in_range"), F.max("mean_score").alias("best"))
    return found.select("estimator", "settings", "in_range", (F.col("best") <= scores.first()["mean_score"]).alias("best_first"))


# constant columns, which no tree can use, stand first so that they are the first to go
_CONSTANT = ["constant_a", "constant_b", "constant_c"]


# fixed value: the columns of ``tabular``
_TABULAR = ["title_length", "text_length", "title_words", "text_words", "commas", "lines", "digits", "toxic", "week_of_year", "is_weekend",
            "is_weekday", "week_of_year_sin", "week_of_year_cos", "day_of_month_sine", "day_of_month_cos", "month_sin", "month_cos"]
_LAST = len(_CONSTANT) + len(_TABULAR) - models.KEEP_FEATURES + 1


@register("ml_rfe", f"""SELECT 1 AS rank, {models.KEEP_FEATURES} AS features, 0 AS constant UNION ALL
SELECT unnest(range(2, {_LAST + 1}))::INT, 1, CASE WHEN unnest(range(2, {_LAST + 1})) > {_LAST - len(_CONSTANT)} THEN 1 ELSE 0 END""")
def ml_rfe(spark, d):
    """Features per rank; the constant ones have the last ranks."""
    rows, names = tabular(spark, d)
    ranks = models.eliminate_features(rows.select("label", *[F.lit(0.0).alias(c) for c in _CONSTANT], *names), _CONSTANT + names)
    return ranks.groupBy("rank").agg(F.count("*").alias("features"), F.sum(F.col("feature").isin(_CONSTANT).cast("int")).alias("constant"))


@register("ml_importance", "SELECT unnest([" + ", ".join(f"'{n}'" for n in sorted([*_TABULAR, "constant_a"])) + "]) AS feature, TRUE AS in_range, TRUE AS sum_is_one")
def ml_importance(spark, d):
    rows, names = tabular(spark, d)
    rows, names = rows.withColumn("constant_a", F.lit(0.0)), [*names, "constant_a"]
    model = models.forest_classifier(depth=10).fit(models.assemble(rows, names))
    # a row per feature
    shares = models.importances(model, names, spark)
    total = shares.agg(F.sum("importance")).first()[0]
    unused = (F.col("feature") != "constant_a") | (F.col("importance") == 0)
    return shares.select("feature", (F.col("importance").between(0, 1) & unused).alias("in_range"), F.lit(abs(total - 1) < 1e-9).alias("sum_is_one"))


@register("tabular_selection", f"""WITH {ARTICLES}, b AS (SELECT length(title)::DOUBLE AS title_length, length(article_text)::DOUBLE AS text_length,
  length(article_text)::DOUBLE * 2 + 1 AS double_length, subject, source_name, label FROM articles WHERE label IS NOT NULL),
o AS (SELECT 'subject_' || subject AS feature, count(*)::DOUBLE / (SELECT count(*) FROM b) AS p FROM b WHERE subject IS NOT NULL GROUP BY subject
  UNION ALL SELECT 'source_name_' || source_name, count(*)::DOUBLE / (SELECT count(*) FROM b) FROM b WHERE source_name IS NOT NULL GROUP BY source_name)
SELECT feature, round(p * (1 - p), 6) AS variance, p * (1 - p) > 0.01 AS varied FROM o
UNION ALL SELECT unnest(['title_length', 'text_length', 'double_length']), 1.0, TRUE""")
def tabular_selection(spark, d):
    """Variance of every coordinate of the tabular features."""
    return _selection(spark, d).table.select("feature", F.round("variance", 6).alias("variance"), "varied")


@register("tabular_correlated", "SELECT 'double_length' AS feature, TRUE AS correlated, TRUE AS dropped")
def tabular_correlated(spark, d):
    """The doubled length goes because of the length before it; the other numbers stay."""
    selection = _selection(spark, d)
    kept = {n for _, n in selection.kept}
    return selection.table.filter("feature = 'double_length'").select("feature", "correlated", F.lit("double_length" not in kept).alias("dropped"))


def _selection(spark, d):
    text = F.length("article_text").cast("double")
    rows = articles(spark, d).dropna(subset=["label"]).select(
        "article_id", "label", "subject", "source_name", F.length("title").cast("double").alias("title_length"), text.alias("text_length"), (text * 2 + 1).alias("double_length"))
    return tabular_job.select_features(rows, ["article_id", "label"], onehot=["subject", "source_name"], numeric=["title_length", "text_length", "double_length"])
