"""Physical plans and whole jobs."""

import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from articlespark import runtime
from articlespark.operators import aggregates, joins, sampling
from articlespark.plans import articles as job
from articlespark.plans import tabular, textmodel
from articlespark.registry import whole
from articlespark.sources import stages

HOT = ["ngram_by_year", "agg_sentiment", "text_clean", "win_dedupe_first", "themes_by_year", "date_fallback",
       "media_combine", "agg_dashboard", "win_share"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", HOT)
def test_no_python_workers_and_no_products(spark, sf_dir, key):
    text = plan(entry_point.queries()[key](spark, sf_dir))
    for word in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_filters_reach_the_scan(spark, sf_dir):
    text = plan(entry_point.queries()["filter_length_caps"](spark, sf_dir))
    assert "ReadSchema: struct<" in text and "l_comment" not in text
    text = plan(entry_point.queries()["src_typed_pruned"](spark, sf_dir))
    assert "text:" not in text


def test_top_per_group_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), F.col("id").alias("n"), F.col("id").cast("string").alias("t"))
    assert "WindowGroupLimit" in plan(sampling.top_per_group(df, "g", 3, "n", "t"))


def test_small_lookups_are_broadcast(spark, sf_dir):
    assert "BroadcastHashJoin" in plan(entry_point.queries()["agg_sentiment"](spark, sf_dir))


def test_whole_article_job(spark, sf_dir):
    final, places = whole.build(spark, sf_dir)
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").distinct().count()
    rows = final.select("article_id", "date_clean", "subject", "location" if "location" in final.columns else "label").collect()
    assert len(rows) == texts
    assert sorted(r["article_id"] for r in rows) == list(range(texts))
    assert all(r["date_clean"] is not None for r in rows)
    assert not {"nlp_textloc", "source", "location", "nlp_location"} & set(final.columns)
    assert places.counts.count() > 0
    assert places.unique.filter("country IS NOT NULL").count() > 0


def shuffles(df):
    return [line for line in plan(df).splitlines() if "Exchange hashpartitioning" in line or "Exchange range" in line]


def test_stages_of_an_article_meet_without_a_shuffle(spark, sf_dir):
    final, places = whole.build(spark, sf_dir)
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        # texts, scores and mentions lie in the same buckets
        assert not shuffles(joins.article_locations_join(final.select("article_id", "cleaned_text", "overall_polarity"), places.mentions))
        assert not shuffles(places.counts)
        # the lexicon is grouped by word, the texts and their scores stay where they are
        lexicon = F.broadcast(spark.createDataFrame([("the", 0.1, 0.2)], "word string, polarity double, subjectivity double"))
        scored = job.apply_sentiment(final.drop(*[c for c in final.columns if "polarity" in c or "subjectivity" in c]), lexicon)
        assert not [line for line in shuffles(scored) if "article_id" in line]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def test_saved_buckets_are_known_to_another_session(spark, tmp_path):
    buckets = stages.Buckets("k", 4)
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    first = stages.stage(spark, str(tmp_path / "s"), lambda: rows, buckets=buckets)
    spark.sql(f"DROP TABLE {stages._name(str(tmp_path / 's') + '/k-4')}")
    again = stages.stage(spark, str(tmp_path / "s"), lambda: 1 / 0, reuse=True, buckets=buckets)
    assert sorted(again.collect()) == sorted(rows.collect()) and again.schema == first.schema
    assert not shuffles(again.groupBy("k").count())
    assert stages.stage(spark, str(tmp_path / "s"), lambda: rows.limit(3), reuse=True, buckets=stages.Buckets("k", 2)).count() == 3


def test_final_cleanup(spark):
    df = spark.createDataFrame([(1, "", "rain", "rain oslo", "OSLO (X) -", ["oslo"], ["oslo"]), (2, None, "", None, None, [], None),
                                (3, "World", None, "", "", None, [])],
                               "article_id int, subject string, cleaned_text string, nlp_textloc string, source string, "
                               "location array<string>, nlp_location array<string>")
    got = job.finalize(df)
    # an empty subject and an empty text stay, only a null text goes
    assert got.columns == ["article_id", "subject", "cleaned_text"]
    assert sorted(map(tuple, got.collect())) == [(1, "", "rain"), (2, "Unknown", "")]


def test_cleaning_maps_lemmas_in_text_title_and_places(spark):
    df = spark.createDataFrame([(1, "The Dogs ran", None, ["cats", "Oslo dogs"]), (2, "", "x", [])],
                               "article_id int, cleaned_text string, title string, location array<string>")
    lemmas = spark.createDataFrame([("dogs", "dog"), ("cats", "cat"), ("ran", None)], "form string, lemma string")
    got = {r["article_id"]: r for r in job.process_nlp(df, lemmas, job.Settings(default_year=2020, stopwords=["the"])).collect()}
    assert (got[1]["nlp_text"], got[1]["nlp_title"], got[1]["nlp_location"]) == ("dog ran", "", ["cat", "oslo dog"])
    assert got[1]["nlp_textloc"] == "dog ran cat oslo dog" and got[2]["nlp_title"] == "x"


@pytest.mark.parametrize("kind", ["classification", "regression"])
def test_text_model_learns_separable_texts(spark, kind):
    df = spark.createDataFrame([(i, f"alpha beta w{i % 5}" if i % 2 else f"gamma delta w{i % 5}", i % 2) for i in range(200)],
                               "article_id bigint, cleaned_text string, label int")
    model, scored = textmodel.train(df, kind, trees=5, depth=5, vocabulary=50)
    test = scored.filter("split = 'test'")
    assert test.count() > 10
    assert test.filter("abs(prediction - label) > 0.5").count() == 0
    again = textmodel.train(df, kind, trees=5, depth=5, vocabulary=50)[1]
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, again.collect()))


def test_the_tabular_job_from_columns_to_reports(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        label, kind = i % 2, rng.choice("abc")
        size = rng.gauss(5 + 3 * label, 1)
        rows.append((i, label, kind, f"id{i}", size, size * 2 + 1, rng.random(), 1.0))
    df = spark.createDataFrame(rows, "article_id long, label int, kind string, ident string, size double, double_size double, noise double, flat double")
    selection = tabular.select_features(df, ["article_id", "label"], onehot=["kind", "ident"], numeric=["size", "double_size", "noise", "flat"])
    table = {r["feature"]: r for r in selection.table.collect()}
    # an identifier varies too little per value to be left, however many values it has
    assert len(table) == 3 + 400 + 4 and sum(r["varied"] for r in table.values()) == 6
    assert [n for n, r in table.items() if r["correlated"]] == ["double_size"] and not table["flat"]["varied"]
    assert [n for _, n in selection.kept] == ["kind_a", "kind_b", "kind_c", "size", "noise"]
    trained = tabular.train(selection, keep=2, trees=5, depth=4)
    ranks = {r["feature"]: r["rank"] for r in trained.ranks.collect()}
    assert sorted(ranks.values()) == [1, 1, 2, 3, 4] and ranks["size"] == 1
    assert trained.importances.first()["feature"] == "size"
    report = {(r["split"], r["class"]): r for r in tabular.reports(trained).collect()}
    assert report["test", "accuracy"]["precision"] > 0.8 and trained.scored.count() == 400


def test_map_levels_keep_real_nulls_apart_from_levels(spark):
    rows = [(1, "x", "c", 1), (1, "y", "c", 0), (1, None, "c", 1), (2, "x", None, 1), (2, "x", "c", 7)]
    df = spark.createDataFrame(rows, "year int, state string, country string, label int")
    got = aggregates.map_counts_levels(df, {"state": ["year", "state", "country"], "country": ["year", "country"]}).collect()
    assert {(r["level"], r["year"], r["state"], r["country"], r["fake_count"], r["real_count"]) for r in got} == {
        ("state", 1, "x", "c", 0, 1), ("state", 1, "y", "c", 1, 0), ("country", 1, None, "c", 1, 2)}
    with pytest.raises(ValueError):
        aggregates.map_counts_levels(df, {"a": ["year"], "b": ["year"]})


def test_stages_save_a_column_once_and_leave_nothing_behind(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(whole, "shared_path", lambda session, label: str(tmp_path / label))
    made, shared = [], runtime.shared_path
    monkeypatch.setattr(runtime, "shared_path", lambda session, label: made.append(shared(session, label)) or made[-1])
    final, _ = whole.build(spark, sf_dir)
    folder = tmp_path / "articles"
    columns = {s: set(spark.read.parquet(str(next((folder / s).glob("article_id-*")))).columns) for s in ("combined", "nlp", "scored", "located")}
    assert {"article_text", "cleaned_text", "title"} < columns["combined"]
    assert columns["nlp"] == {"article_id", "nlp_text", "nlp_title", "nlp_location"}
    assert columns["located"] == {"article_id", "locationsfromarticle"} and not columns["scored"] & (columns["combined"] | columns["nlp"]) - {"article_id"}
    assert set(final.columns) >= {"article_text", "cleaned_text", "nlp_text", "overall_polarity", "locationsfromarticle"}
    texts = [p.removeprefix("file://") for p in made if "/classified-" in p or "/ids-" in p]
    assert len(texts) == 2 and not any(map(os.path.exists, texts))
