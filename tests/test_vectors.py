"""Vectors, term weights and co-moments against plain Python."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from articlespark.operators import comoments, features, vectors


def texts(n=60, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["don't", "Été", "a", "x_y"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30))), rng.choice([None, "", "The End, of w1!"])) for i in range(n)]
    return rows + [(n, None, None), (n + 1, "the The THE", "")]


def weighted(rows, stop, fitted=None):
    """{(key, term): weight} by counting in plain Python."""
    def terms(r):
        clean = [re.sub(r"[^\w\s]", "", (t or "").lower()) for t in r[1:]]
        return collections.Counter(w for w in re.findall(r"\w\w+", " ".join(clean)) if w not in stop)
    seen = [terms(r) for r in fitted or rows]
    docs = collections.Counter(w for t in seen for w in t)
    out = {}
    for r in rows:
        value = {w: n * (math.log((1 + len(seen)) / (1 + docs[w])) + 1) for w, n in terms(r).items() if w in docs}
        norm = math.sqrt(sum(v * v for v in value.values()))
        out |= {(r[0], w): v / norm for w, v in value.items()}
    return out, sorted(docs)


def test_term_weights(spark, tmp_path):
    rows, more = texts(), [(900 + k, t, u) for k, t, u in texts(20, seed=5)] + [(990, "w1 never seen before", None)]
    df = spark.createDataFrame(rows, "k long, t string, u string").repartition(4)
    model = vectors.fit_terms(df, "k", ["t", "u"], ["the"])
    want, vocabulary = weighted(rows, {"the"})
    assert [(r["index"], r["term"]) for r in model.vocabulary.orderBy("index").collect()] == list(enumerate(vocabulary))
    assert {(r["k"], r["term"]): r["weight"] for r in model.weights(df, "k").collect()} == pytest.approx(want)
    model.save(str(tmp_path / "m"))
    asked = spark.createDataFrame(more, "k long, t string, u string")
    got = vectors.TermModel.load(spark, str(tmp_path / "m")).transform(asked, "k", ["u"]).collect()
    want, _ = weighted(more, {"the"}, rows)
    assert {(r["k"], vocabulary[i]): v for r in got for i, v in zip(r["features"].indices, r["features"].values)} == pytest.approx(want)
    assert {r["features"].size for r in got} == {len(vocabulary)} and collections.Counter(r["u"] for r in got) == collections.Counter(r[2] for r in more)


def test_a_learner_takes_the_vectors(spark):
    from pyspark.ml.classification import LogisticRegression
    rows = [(i, ("good news" if i % 2 else "bad story") + f" number{i}", i % 2) for i in range(80)]
    df = spark.createDataFrame(rows, "k long, t string, label int")
    model = vectors.fit_terms(df, "k", ["t"])
    data = model.transform(df, "k", ["label"])
    fitted = LogisticRegression(maxIter=20).fit(data)
    assert fitted.transform(data).filter("prediction = label").count() == 80


def test_vocabulary_without_terms(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "k long, t string")
    model = vectors.fit_terms(df, "k", ["t"])
    assert model.size == 0 and {r["k"]: r["features"].size for r in model.transform(df, "k").collect()} == {1: 0, 2: 0}


def test_feature_model_of_every_kind(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["x", "y", "z z", None]), f"id{i}", rng.choice(["lo", "hi"]), rng.random() * 9, rng.expovariate(1)) for i in range(300)] + [(300, "x", "id0", None, None, 1.0)]
    df = spark.createDataFrame(rows, "k long, c string, id string, o string, n double, s double").repartition(3)
    model = features.fit_features(df, onehot=["c", "id"], skewed=["s"], numeric=["n"], ordinal=["o"])
    assert model.size == 3 + 300 + 3 and model.first == {"c": 0, "id": 3, "s": 303, "n": 304, "o": 305}
    names = {r["index"]: r["feature"] for r in model.names(spark).collect()}
    assert len(names) == model.size and names[1] == "c_y" and names[304] == "n"
    asked = df.withColumn("id", F.when(F.col("k") == 7, "unknown").otherwise(F.col("id")))
    got = {r["k"]: r["features"] for r in model.transform(asked, ["k"]).collect()}
    n = np.array([r[4] for r in rows[:-1]])
    for k, c, ident, o, value, _ in rows:
        v = got[k].toArray()
        hot = {names[i] for i in np.flatnonzero(v[:303])}
        assert hot == ({f"c_{c}"} if c else set()) | ({f"id_{ident}"} if k != 7 else set())
        assert v[305] == {"hi": 0.0, "lo": 1.0, None: -1.0}[o]
        assert math.isnan(v[304]) if value is None else v[304] == pytest.approx((value - n.mean()) / n.std())
    skew = np.array([v.toArray()[303] for v in got.values()])
    assert skew.mean() == pytest.approx(0, abs=1e-9) and skew.std() == pytest.approx(1)
    with pytest.raises(ValueError):
        features.fit_features(df, onehot=["c"], ordinal=["c"])


@pytest.mark.parametrize("missing", [0.0, 0.1])
def test_correlations_with_nulls_offsets_and_constants(spark, missing):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 7)) + np.array([0, 1e6, -3, 0, 0, 0, 0.1])
    x[:, 3] = x[:, 1] * 2 + rng.normal(size=400) * 0.1
    x[:, 4] = 0.1
    x[rng.random(x.shape) < missing] = np.nan
    x[:, 5] = np.where(np.arange(400) == 3, 1.0, np.nan)
    names = [f"c{i}" for i in range(7)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"{n} double" for n in names)).repartition(6)
    got = {(r["earlier"], r["feature"]): r["correlation"] for r in features.pair_correlations(df, names).collect()}
    assert len(got) == 21
    for i in range(7):
        for j in range(i + 1, 7):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            if {i, j} & {4, 5}:
                assert got[names[i], names[j]] is None
            else:
                assert got[names[i], names[j]] == pytest.approx(abs(np.corrcoef(x[both, i], x[both, j])[0, 1]), abs=1e-9)
    assert [r["feature"] for r in features.correlated_features(df, names).collect()] == ["c3"]


def test_a_thousand_features_in_one_job(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 1000))
    x[:, 999] = x[:, 17] + rng.normal(size=300) * 0.01
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").repartition(5)
    names = [f"f{i}" for i in range(1000)]
    blocks = comoments.co_moments(df, F.col("v"), 1000)
    got = comoments.correlations(blocks, names)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "BroadcastExchange" not in plan
    rows = got.collect()
    assert len(rows) == 1000 * 999 // 2
    want = np.corrcoef(x.T)
    for r in rows[::997]:
        assert r["correlation"] == pytest.approx(want[int(r["earlier"][1:]), int(r["feature"][1:])], abs=1e-9) and r["n"] == 300
    assert {(r["earlier"], r["feature"]) for r in rows if abs(r["correlation"]) > 0.9} == {("f17", "f999")}


def test_correlations_of_vectors_and_of_no_rows(spark):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(Vectors.sparse(2, [0], [1.0]),), (Vectors.dense(2.0, 3.0),), (Vectors.dense(3.0, 1.0),)], ["features"])
    got = features.vector_correlations(df, ["a", "b"]).first()
    assert got["correlation"] == pytest.approx(abs(np.corrcoef([1, 2, 3], [0, 3, 1])[0, 1]))
    assert features.vector_correlations(df.limit(0), ["a", "b"]).count() == 0
