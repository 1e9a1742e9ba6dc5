"""How the learners' rows are dealt to tasks."""

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from articlespark.operators import models
from articlespark.plans import textmodel
from articlespark.runtime import compact


def _partitions_seen(monkeypatch, estimator, run):
    seen, fit = [], estimator.fit
    monkeypatch.setattr(estimator, "fit", lambda self, data, *more: seen.append(data.rdd.getNumPartitions()) or fit(self, data, *more))
    run()
    return seen


def test_compact_leaves_the_tasks_asked_for(spark):
    rows = spark.range(0, 1000, 1, 6)
    assert compact(rows, "rows").rdd.getNumPartitions() == 1
    two = compact(rows, "rows", tasks=2)
    assert two.rdd.getNumPartitions() == 2 and two.distinct().count() == 1000


def test_elimination_uses_more_than_one_task(spark, monkeypatch):
    rows = spark.range(0, 400, 1, 6).select((F.col("id") % 2).cast("int").alias("label"), F.col("id").cast("double").alias("a"),
                                            F.lit(0.0).alias("b"), (F.col("id") % 2).cast("double").alias("c"))
    seen = _partitions_seen(monkeypatch, RandomForestClassifier, lambda: models.eliminate_features(rows, ["a", "b", "c"], keep=2, trees=2))
    assert len(seen) == 1 and seen[0] > 1


def test_text_forest_sums_up_nodes_in_few_tasks(spark, monkeypatch):
    rows = spark.range(0, 60, 1, 12).select(F.col("id").alias("article_id"), (F.col("id") % 2).cast("int").alias("label"),
                                            F.when(F.col("id") % 2 == 0, "red fox runs").otherwise("blue whale swims").alias("cleaned_text"))
    seen = _partitions_seen(monkeypatch, RandomForestRegressor, lambda: textmodel.train(rows, "regression", trees=2, depth=2))
    assert len(seen) == 1 and seen[0] <= models.TEXT_TASKS
