"""Real or dubious from columns: features, their selection, and a forest over what is left."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features as ft
from ..operators import metrics, models, sampling
from ..runtime import materialize

#: Coordinates that may be left after the variance filter; pairs of them are compared.
MAX_FEATURES = 5_000


@dataclass
class Selection:
    """Feature names with variance and whether each filter kept them, the vectors, and the coordinates that are left."""

    table: DataFrame
    vectors: DataFrame
    model: ft.FeatureModel
    kept: list[tuple[int, str]]


def select_features(df: DataFrame, keep: Sequence[str], onehot: Sequence[str] = (), skewed: Sequence[str] = (), numeric: Sequence[str] = (),
                    ordinal: Sequence[str] = (), variance: float = ft.MIN_VARIANCE, correlation: float = ft.MAX_CORRELATION) -> Selection:
    """Fit the features, then leave out coordinates of little variance and those that correlate with an earlier one.

    Variances of a column of any number of values stay in a table; a value has to be in more than a share of about
    ``variance`` of the rows to be left, so what reaches the driver and the pairwise step is bounded by the columns."""
    model = ft.fit_features(df, onehot, skewed, numeric, ordinal)
    vectors = model.transform(df, keep)
    varied = ft.vector_variances(vectors, model, variance)
    left = [(r["index"], r["feature"]) for r in varied.filter("varied").orderBy("index").limit(MAX_FEATURES + 1).select("index", "feature").collect()]
    if len(left) > MAX_FEATURES:
        raise ValueError(f"more than {MAX_FEATURES} coordinates vary by more than {variance}")
    sliced = VectorSlicer(inputCol="features", outputCol="_left", indices=[i for i, _ in left]).transform(vectors)
    pairs = ft.vector_correlations(sliced, [n for _, n in left], "_left")
    # at most a row per coordinate that is left
    dropped = {r["feature"] for r in ft.too_close(pairs, correlation).collect()}
    flagged = df.sparkSession.createDataFrame([(i, n in dropped) for i, n in left], "index long, correlated boolean")
    table = varied.join(F.broadcast(flagged), "index", "left").select("index", "feature", "variance", "varied", F.coalesce("correlated", F.lit(False)).alias("correlated"))
    return Selection(table, vectors, model, [(i, n) for i, n in left if n not in dropped])


@dataclass
class Trained:
    """The fitted forest over vectors, predictions of all rows, importances and ranks of the features."""

    model: PipelineModel
    scored: DataFrame
    importances: DataFrame
    ranks: DataFrame


def train(selection: Selection, key: str = "article_id", label: str = "label", keep: int = models.KEEP_FEATURES, trees: int = models.TREES,
          depth: int = models.MAX_DEPTH, seed: int = models.SEED) -> Trained:
    """Eliminate features by their importance until ``keep`` are left, fit a forest on the training rows and score all rows."""
    indices, names = [i for i, _ in selection.kept], [n for _, n in selection.kept]
    ranks = models.eliminate_coordinates(selection.vectors, indices, names, label, keep, trees, seed)
    best = {r["feature"] for r in ranks.filter("rank = 1").collect()}
    chosen = [(i, n) for i, n in selection.kept if n in best]
    rows = materialize(sampling.split(selection.vectors.dropna(subset=[label]), key), "tabular")
    slicer = VectorSlicer(inputCol="features", outputCol="chosen", indices=[i for i, _ in chosen])
    forest = models.forest_classifier(label, trees, depth, seed).setFeaturesCol("chosen").fit(slicer.transform(rows.filter("split = 'train'")))
    model = PipelineModel([slicer, forest])
    scored = model.transform(rows).select(key, "split", label, "prediction")
    return Trained(model, scored, models.importances(forest, [n for _, n in chosen], rows.sparkSession), ranks)


def reports(trained: Trained) -> DataFrame:
    """Precision, recall and F1 of training and test rows."""
    return metrics.report(trained.scored, ["split"])
