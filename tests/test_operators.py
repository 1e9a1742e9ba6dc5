"""Operators on small literal tables, checked against plain Python where that is simple."""

import datetime as dtm
import random
import statistics

import pytest
from pyspark.sql import functions as F

from articlespark import runtime, schemas
from articlespark.functions import text
from articlespark.operators import (aggregates, calendar, features, joins, locations, metrics, models, ngrams, ordering,
                                    profile, rows, sampling, textjobs)
from articlespark.sources import readers


def test_keep_first_with_a_hot_text_and_nulls(spark):
    data = [(i, "same" if i % 3 else None if i % 2 else f"t{i}") for i in range(300)]
    df = spark.createDataFrame(data, "id bigint, text string").repartition(7)
    got = {r["id"] for r in ordering.keep_first(df, "text", ["id"]).collect()}
    first = {}
    for i, t in data:
        first.setdefault(t, i)
    assert got == set(first.values())


def test_dense_ids_follow_the_order(spark):
    df = spark.createDataFrame([(f"k{i % 4}", i) for i in range(500)], "a string, b int").repartition(5)
    got = [(r["a"], r["b"]) for r in ordering.dense_ids(df, ["a", "b"], "n").orderBy("n").collect()]
    assert got == sorted((f"k{i % 4}", i) for i in range(500))
    ids = [r["n"] for r in ordering.dense_ids(df, ["a", "b"], "n").collect()]
    assert sorted(ids) == list(range(500))


def test_exact_quantiles_with_a_frequent_value(spark):
    rng = random.Random(1)
    data = [("a", 7.0 if rng.random() < 0.4 else rng.random() * 50) for _ in range(701)] + [("b", 1.0)]
    q = {r["g"]: r for r in ordering.exact_quantiles(spark.createDataFrame(data, "g string, v double"), "g", "v",
                                                     [0.0, 0.25, 0.5, 1.0]).collect()}
    values = [v for g, v in data if g == "a"]
    cuts = statistics.quantiles(values, n=4, method="inclusive")
    assert q["a"]["q0"] == min(values) and q["a"]["q3"] == max(values)
    assert q["a"]["q1"] == pytest.approx(cuts[0]) and q["a"]["q2"] == pytest.approx(cuts[1])
    assert q["b"]["q1"] == 1.0 and q["b"]["n_rows"] == 1


def test_sample_rows_is_exact_for_any_cut(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    got = {r["k"] for r in sampling.sample_rows(df, "k", 40, 3).collect()}
    want = {r["k"] for r in df.orderBy(sampling.draw("k", 3), "k").limit(40).collect()}
    assert got == want and len(got) == 40
    assert sampling.sample_rows(df, "k", 9000).count() == 5000


def test_null_keys_do_not_group_or_match(spark):
    df = spark.createDataFrame([(None, 1), ("a", 1), ("a", 0)], "d string, label int")
    assert [tuple(r) for r in aggregates.count_by(df, ["d"]).collect()] == [("a", 2)]
    flagged = joins.member_flag(df, "d", df, "d").collect()
    assert {(r["d"], r["ignore"]) for r in flagged} == {(None, 1), ("a", 0)}


def test_left_lookup_of_mentions_keeps_lonely_places(spark):
    places = spark.createDataFrame([("Paris", 1), ("Rome", 2), (None, 3)], "location string, ord int")
    found = spark.createDataFrame([(i, "PARIS") for i in range(50)] + [(99, "oslo"), (98, None)], "article_id int, location string")
    got = joins.lookup_left_mentions(places, found).collect()
    assert len(got) == 51
    assert [(r["ord"], r["article_id"]) for r in got if r["location"] == "rome"] == [(2, None)]


def test_outer_counts_agree_with_conditional_counts(spark):
    df = spark.createDataFrame([("x", 1), ("x", 0), ("y", 1), ("z", 0), ("z", None), (None, 1)], "k string, label int")
    outer = joins.outer_counts(aggregates.count_by(df.filter("label = 0"), ["k"], "fake_count"),
                               aggregates.count_by(df.filter("label = 1"), ["k"], "real_count"), ["k"], ["fake_count", "real_count"])
    once = aggregates.map_counts(df, ["k"])
    assert sorted(map(tuple, outer.collect())) == sorted(map(tuple, once.collect()))


def test_real_label_can_be_swapped(spark):
    df = spark.createDataFrame([("x", 1), ("x", 1), ("x", 0)], "k string, label int")
    assert tuple(aggregates.map_counts(df, ["k"], real_label=0).first()) == ("x", 2, 1)


def test_holidays(spark):
    h = {r["date"].isoformat(): r["name"] for r in calendar.us_holidays(spark, 2015, 2021).collect()}
    assert h["2015-07-03"] == "Independence Day (observed)" and h["2016-12-26"] == "Christmas Day (observed)"
    assert h["2016-05-30"] == "Memorial Day" and h["2017-11-23"] == "Thanksgiving Day"
    assert h["2021-12-31"] == "New Year's Day (observed)" and h["2021-06-18"].startswith("Juneteenth")
    assert h["2016-01-18"] == "Martin Luther King Jr. Day" and "2020-06-19" not in h


def test_places_longest_name_wins(spark):
    texts = spark.createDataFrame([(1, "in new york city and york"), (2, "yorkshire newyork"), (3, None),
                                   (4, "york new york new")], "id int, t string")
    names = spark.createDataFrame([("york",), ("New York",), ("new york city",), ("city and",), ("st. ives",)], "location string")
    got = sorted((r["id"], r["location"]) for r in locations.find_places(texts, "id", "t", names).collect())
    assert got == [(1, "new york city"), (1, "york"), (4, "new york"), (4, "york")]


def test_places_with_punctuation(spark):
    texts = spark.createDataFrame([(1, "From Guinea-Bissau to St. Ives"), (2, "guinea bissau, st ives"), (3, "st. guinea")], "id int, t string")
    names = spark.createDataFrame([("Guinea-Bissau",), ("st. ives",), ("--",), (None,)], "location string")
    got = sorted((r["id"], r["location"]) for r in locations.find_places(texts, "id", "t", names).collect())
    assert got == [(i, n) for i in (1, 2) for n in ("guinea-bissau", "st. ives")]


def test_places_with_a_word_that_opens_many_names(spark):
    names = spark.createDataFrame([(f"san n{i}",) for i in range(3000)] + [(f"a{i} b",) for i in range(3000)], "location string")
    texts = spark.createDataFrame([(1, "san n2999 a2500 b san a1")], "id int, t string")
    got = sorted(r["location"] for r in locations.find_places(texts, "id", "t", names).collect())
    assert got == ["a2500 b", "san n2999"]


def test_namibia_stays_unless_na_is_null(spark):
    cities = spark.createDataFrame([("Windhoek", "Khomas", "Namibia", "NA", "NAM", -22.5, 17.0, 0)], schemas.WORLD_CITIES)
    states = spark.createDataFrame([], schemas.US_STATES)
    regions = spark.createDataFrame([("Namibia", "NA", "NAM", 516, "x", "Africa", "Southern Africa", 2, 18, 0)], schemas.COUNTRY_CONTINENT)
    assert locations.lookups(cities, states, regions)[2].count() == 1
    assert locations.lookups(cities, states, regions, na_as_null=True)[2].count() == 0
    with pytest.raises(ValueError):
        locations.lookups(cities.drop("iso2"), states, regions)


def test_dropping_ignored_keeps_unknown_flags(spark):
    df = spark.createDataFrame([("a", 1), ("b", 0), ("c", None)], "location string, ignore int")
    assert {r[0] for r in locations.drop_ignored(df).collect()} == {"b", "c"}


def test_ngram_summary_of_a_few_texts(spark):
    df = spark.createDataFrame([(1, "big cat big cat", 2016)] * 6 + [(0, "big dog", 2016)] * 6 + [(None, "big", 2016)],
                               "label int, text string, year int")
    got = {(r["ngram_size"], r["term"]): r for r in ngrams.ngram_summary(df, stopwords=["the"]).collect()}
    big = got[(1, "big")]
    assert (big["count_real"], big["count_dubious"], big["max_real"], big["mean_real"], big["stdev_real"]) == (12, 6, 2, 2.0, 0.0)
    assert big["relevance_score"] == pytest.approx(round(6 / 18, 4))
    assert (1, "dog") not in got and got[(2, "big dog")]["total_count"] == 6 and (3, "big cat big") in got


def test_repeat_terms_cuts_frequent_terms(spark):
    df = spark.createDataFrame([("ab", 5), ("c", 0)], "term string, weight bigint")
    got = ngrams.repeat_terms(df, chunk=2).orderBy("part").collect()
    assert [r["fragment"] for r in got] == ["ab ab ", "ab ab ", "ab "]


def test_common_cloud_weighs_real_counts_only(spark):
    df = spark.createDataFrame([(2016, 1, "w", 3, 4, True, True)],
                               "year int, ngram_size int, term string, count_real bigint, count_dubious bigint, in_real boolean, in_dubious boolean")
    got = {r["subset"]: r["weight"] for r in ngrams.cloud_subsets(df).collect()}
    assert got == {"all": 7, "real": 3, "dubious": 4, "common": 3}


def test_sentiment_without_hits_and_without_text(spark):
    lex = spark.createDataFrame([("good", 1.0, 0.5), ("bad", -1.0, 0.7)], schemas.LEXICON_SENTIMENT)
    df = spark.createDataFrame([(1, "good good bad"), (2, "plain"), (3, None)], "id int, t string")
    got = {r["id"]: r["x_polarity"] for r in textjobs.lexicon_scores(df, "id", {"x": F.col("t")}, lex).collect()}
    assert got[1] == pytest.approx(1 / 3) and got[2] == 0.0 and got[3] is None


def test_lemmas_keep_the_order(spark):
    df = spark.createDataFrame([(1, ["dogs", "x", "dogs", "cats"]), (2, [])], "id int, t array<string>")
    lem = spark.createDataFrame([("dogs", "dog"), ("cats", "cat")], schemas.LEXICON_FORMS)
    got = {r["id"]: r["t"] for r in textjobs.lemmatize_join(df, "id", "t", lem).collect()}
    assert got == {1: ["dog", "x", "dog", "cat"], 2: []}


def test_lemma_table_of_any_size(spark):
    lem = spark.range(12_000).select(F.concat(F.lit("w"), "id").alias("form"), F.concat(F.lit("l"), "id").alias("lemma"))
    df = spark.createDataFrame([(1, ["w11999", "x", "w501"]), (2, None), (None, ["w1"])], "id int, t array<string>")
    got = {r["id"]: r["t"] for r in textjobs.lemmatize_join(df, "id", "t", lem).collect()}
    # without an id, words cannot find their map
    assert got == {1: ["l11999", "x", "l501"], 2: [], None: ["w1"]}
    inline = {f"w{i}": f"l{i}" for i in range(501)}
    assert df.filter("id = 1").select(text.lemmatize(F.col("t"), inline | {"w501": "l"}).alias("t")).first()["t"] == ["w11999", "x", "l"]


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    mean, std = features.fit_scale(df, ["x"])["x"]
    assert (mean, std) == (2.0, pytest.approx((2 / 3) ** 0.5))


def test_yeo_johnson_fit_straightens_a_skewed_column(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(rng.lognormvariate(0, 1),) for _ in range(800)], "x double")
    lam = features.fit_yeo_johnson(df, "x")
    assert -1.5 < lam < 0.2


def test_unknown_categories(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    codes = features.ordinal_codes(df, "c")
    seen = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    got = {r["c"]: r["c_code"] for r in features.encode_ordinal(seen, "c", codes).collect()}
    assert got == {"a": 0.0, "b": 1.0, "z": -1.0, None: -1.0}
    hot = features.onehot_columns("c", features.categories(df, "c"))
    rows_ = [tuple(r) for r in seen.select(*[e.alias(n) for n, e in hot.items()]).collect()]
    assert rows_ == [(1.0, 0.0), (0.0, 1.0), (0.0, 0.0), (0.0, 0.0)]
    sparse = features.onehot_vector(seen, "c", codes).collect()
    assert {r["c"]: r["c_onehot"].toArray().tolist() for r in sparse} == {
        "a": [1.0, 0.0], "b": [0.0, 1.0], "z": [0.0, 0.0], None: [0.0, 0.0]}


def test_onehot_of_many_categories(spark):
    df = spark.range(1_001).select(F.concat(F.lit("v"), "id").alias("c"))
    assert features.fit_features(df, onehot=["c"]).size == 1_001
    with pytest.raises(ValueError):
        features.categories(df, "c")
    rows_ = features.onehot_vector(df, "c", features.ordinal_codes(df, "c")).collect()
    assert sorted(int(r["c_onehot"].indices[0]) for r in rows_) == list(range(1_001)) and rows_[0]["c_onehot"].size == 1_001


def test_feature_names_with_dots(spark):
    df = spark.createDataFrame([(1.0, 0.0, 1), (0.0, 1.0, 0), (1.0, 1.0, 1)], "`U.S. News` double, b double, label int")
    names = ["U.S. News", "b"]
    assert features.target_correlation(df, names).first()["feature"] == "U.S. News"
    assert features.variance_filter(df, names).filter("kept").count() == 2
    assert features.pair_correlations(df, names).first()["earlier"] == "U.S. News"


def test_report_of_published_cells(spark):
    cells = {(0, 0.0): 7392, (0, 1.0): 722, (1, 0.0): 578, (1, 1.0): 14044}
    df = spark.createDataFrame([(y, p, n) for (y, p), n in cells.items()], "label int, prediction double, n int")
    df = df.select("label", "prediction", F.explode(F.sequence(F.lit(1), "n")))
    got = {r["class"]: r for r in metrics.report(df).collect()}
    assert got["accuracy"]["precision"] == pytest.approx(0.94282, abs=1e-5)
    assert got["0"]["precision"] == pytest.approx(0.92748, abs=1e-5) and got["1"]["f1_score"] == pytest.approx(0.95576, abs=1e-5)
    assert got["macro avg"]["recall"] == pytest.approx(0.93574, abs=1e-5)
    assert got["weighted avg"]["f1_score"] == pytest.approx(0.94271, abs=1e-5) and got["1"]["support"] == 14622


def test_idf_is_smoothed_and_ties_go_by_term(spark):
    df = spark.createDataFrame([("bb aa aa",), ("aa cc",)], "t string")
    got = [(r["term"], r["tf"], r["df"], round(r["idf"], 6)) for r in models.top_terms(df, "t", 2).collect()]
    assert got == [("aa", 3, 2, 1.0), ("bb", 1, 1, 1.405465)]


def test_cast_errors_become_null(spark):
    df = spark.createDataFrame([("1",), ("x",)], "v string")
    assert [r[0] for r in rows.cast_columns(df, {"v": "int"}).collect()] == [1, None]


def test_profile_gate_and_duplicate_names(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert profile.has_nulls(df) and not profile.has_nulls(df.select("a"))
    assert {(r[0], r[1]) for r in profile.duplicate_columns(spark, ["a", "b", "a"]).collect()} == {("a", 2)}


def test_a_large_lookup_is_not_broadcast(spark):
    big = spark.range(50)
    assert "ResolvedHint" not in runtime.small(big, max_rows=10)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in runtime.small(big, max_rows=50)._jdf.queryExecution().analyzed().toString()


def test_headers_are_trimmed_and_required(spark):
    df = readers.trim_headers(spark.createDataFrame([(1,)], "` Country` int"))
    assert df.columns == ["Country"]
    with pytest.raises(ValueError):
        readers.require_columns(df, ["Country", "State"])


def test_date_bounds(spark):
    df = spark.createDataFrame([(dtm.date(2015, 5, 1),), (dtm.date(2017, 2, 1),), (None,)], "d date")
    assert tuple(aggregates.date_bounds(df, "d").first())[2:] == (2015, 2017)


def test_article_terms_count_runs_of_words_in_the_row(spark):
    texts = [(1, 1, "the of the of cat"), (2, 0, ""), (3, None, None), (4, 1, "cat")]
    df = spark.createDataFrame(texts, "id int, label int, text string")
    words = F.split("text", " ")
    got = {tuple(r) for r in ngrams.article_terms(df, ["id", "label"], {1: words, 2: words, 3: words}, ["the", "of"]).collect() if r["term"]}
    assert got == {(1, 1, 1, "the", 2), (1, 1, 1, "of", 2), (1, 1, 1, "cat", 1), (1, 1, 2, "of cat", 1), (1, 1, 3, "the of cat", 1), (4, 1, 1, "cat", 1)}


def test_term_summary_from_whole_sums(spark):
    rows = [(1, c) for c in (1, 2, 2, 7)] + [(0, 3), (0, 3), (None, 9)]
    terms = spark.createDataFrame([(label, 1, "w", c) for label, c in rows], "label int, ngram_size int, term string, cnt int")
    out = ngrams.summarize_terms(terms, [])
    # a moment per class and term is a buffer of doubles for every term; whole sums are enough
    assert "stddev" not in out._jdf.queryExecution().optimizedPlan().toString()
    r = out.first()
    assert (r["count_real"], r["max_real"], r["mean_real"], r["stdev_real"]) == (12, 7, 3.0, round(statistics.pstdev([1, 2, 2, 7]), 4))
    assert (r["count_dubious"], r["max_dubious"], r["mean_dubious"], r["stdev_dubious"]) == (6, 3, 3.0, 0.0)


def test_power_fit_sums_a_task_at_once(spark):
    rng = random.Random(3)
    values = [rng.gauss(0, 2) ** 3 for _ in range(400)] + [0.0, -1.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    grid = [-1.0, 0.0, 0.7, 2.0]
    n, total, found = features._power_moments(df.select(F.col("v").alias("x")).dropna(), grid)
    assert n == 402 and total == pytest.approx(df.agg(F.sum(F.signum("v") * F.log1p(F.abs("v")))).first()[0])
    assert found == pytest.approx(list(df.agg(*[F.var_pop(features.yeo_johnson(F.col("v"), x)) for x in grid]).first()))
    assert features._power_moments(df.filter("v > 1e9").select(F.col("v").alias("x")), grid)[0] == 0
    assert features.fit_yeo_johnson(df.filter("v IS NULL"), "v") == 1.0
