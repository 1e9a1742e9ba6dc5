"""Feature engineering: scaling, power transform, encoders, feature filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from math import inf, log

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import materialize, small
from .comoments import co_moments, correlations
from .ordering import dense_ids
from .vectors import as_vectors, coordinates, sparse

MIN_VARIANCE = 0.01
MAX_CORRELATION = 0.9
#: Values that get a column each.
MAX_COLUMNS = 1_000


def number(name: str) -> Column:
    """The column of exactly this name, which may hold dots, as a double."""
    return F.col("`" + name.replace("`", "``") + "`").cast("double")


def standardize(c: Column, mean: float, std: float) -> Column:
    """A constant column is centred but not divided."""
    return (c.cast("double") - F.lit(mean)) / F.lit(std if std else 1.0)


def fit_scale(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, in one pass."""
    row = df.agg(*[f(c).alias(f"{n}_{c}") for c in cols
                   for n, f in (("mean", F.avg), ("std", F.stddev_pop))]).first()
    return {c: (row[f"mean_{c}"] or 0.0, row[f"std_{c}"] or 0.0) for c in cols}


def yeo_johnson(c: Column, lam: float) -> Column:
    """Yeo-Johnson power transform for a fixed lambda."""
    x = c.cast("double")
    if abs(lam) < 1e-12:
        positive = F.log1p(x)
    else:
        positive = (F.pow(x + 1.0, F.lit(lam)) - 1.0) / F.lit(lam)
    if abs(lam - 2.0) < 1e-12:
        negative = -F.log1p(-x)
    else:
        negative = -(F.pow(1.0 - x, F.lit(2.0 - lam)) - 1.0) / F.lit(2.0 - lam)
    return F.when(x >= 0, positive).otherwise(negative)


def fit_yeo_johnson(df: DataFrame, col: str, low: float = -3.0, high: float = 3.0,
                    steps: int = 13, rounds: int = 4) -> float:
    """Lambda of the largest likelihood: each round evaluates a grid in one pass and the next
    round refines around the best point."""
    data = df.select(F.col(col).cast("double").alias("x")).dropna()
    best = 1.0
    for _ in range(rounds):
        grid = [low + (high - low) * i / (steps - 1) for i in range(steps)]
        n, total, variances = _power_moments(data, grid)
        if not n:
            return best
        def likelihood(i: int) -> float:
            v = variances[i]
            return -inf if not v or v != v else -n / 2 * log(v) + (grid[i] - 1) * total

        best = grid[max(range(steps), key=likelihood)]
        width = (high - low) / (steps - 1)
        low, high = best - width, best + width
    return best


def _power_moments(data: DataFrame, grid: Sequence[float]) -> tuple[int, float, list[float]]:
    """Rows of the column ``x`` without nulls, the sum of its signed logarithms, and the population variance of its transform for
    each lambda. A task takes whole batches; one row per task reaches the driver."""
    def moved(x, lam):
        out, up = np.empty_like(x), x >= 0
        a, b = x[up], -x[~up]
        out[up] = np.log1p(a) if abs(lam) < 1e-12 else (np.power(a + 1.0, lam) - 1.0) / lam
        out[~up] = -np.log1p(b) if abs(lam - 2.0) < 1e-12 else -(np.power(b + 1.0, 2.0 - lam) - 1.0) / (2.0 - lam)
        return out

    def merged(a, b):
        (n, mean, square), (m, other, more) = a, b
        apart = other - mean
        return n + m, mean + apart * (m / (n + m)), square + more + apart * apart * (n * m / (n + m))

    def measure(batches):
        rows, total, parts = 0, 0.0, None
        with np.errstate(all="ignore"):
            for batch in batches:
                x = np.array(batch.column(0).to_numpy(zero_copy_only=False), dtype=np.float64)
                if len(x):
                    values = np.stack([moved(x, lam) for lam in grid])
                    means = values.mean(axis=1)
                    found = len(x), means, np.square(values - means[:, None]).sum(axis=1)
                    parts = found if parts is None else merged(parts, found)
                    rows, total = rows + len(x), total + float((np.sign(x) * np.log1p(np.abs(x))).sum())
        if rows:
            yield pa.RecordBatch.from_pydict({"n": [rows], "total": [total], "means": [list(parts[1])], "squares": [list(parts[2])]})

    found = data.mapInArrow(measure, "n long, total double, means array<double>, squares array<double>").collect()
    if not found:
        return 0, 0.0, []
    with np.errstate(all="ignore"):
        n, _, squares = reduce(merged, [(r["n"], np.array(r["means"]), np.array(r["squares"])) for r in found])
        return n, sum(r["total"] for r in found), [float(v) for v in squares / n]


def ordinal_codes(df: DataFrame, col: str) -> DataFrame:
    """(value, code) with codes 0, 1, ... in sorted order; the categories are never collected."""
    values = df.select(F.col(col).alias("value")).dropna().distinct()
    return dense_ids(values, ["value"], name="code")


def encode_ordinal(df: DataFrame, col: str, codes: DataFrame, name: str | None = None) -> DataFrame:
    """Code of the value; -1 for a value the codes do not have."""
    table = codes.select(F.col("value").alias(col), F.col("code").cast("double").alias("_code"))
    return (df.join(small(table), col, "left")
            .withColumn(name or f"{col}_code", F.coalesce("_code", F.lit(-1.0))).drop("_code"))


def onehot_vector(df: DataFrame, col: str, codes: DataFrame, name: str | None = None) -> DataFrame:
    """Sparse vector with a one at the value's code; all zeros for nulls and values the codes do not have.

    For columns of any cardinality: only the number of values reaches the driver."""
    n = codes.count()
    # index n stands for all other values and is the last one, which the encoder leaves out
    last = df.sparkSession.range(n, n + 1).select(F.col("id").cast("double").alias("_index"))
    encoder = OneHotEncoder(inputCol="_index", outputCol=name or f"{col}_onehot", dropLast=True).fit(last)
    coded = encode_ordinal(df, col, codes, "_index")
    other = F.when(F.col("_index") < 0, F.lit(float(n))).otherwise(F.col("_index"))
    return encoder.transform(coded.withColumn("_index", other)).drop("_index")


def categories(df: DataFrame, col: str, most: int = MAX_COLUMNS) -> list[str]:
    """Sorted values of a column that gets a column per value, whose names have to be known in the driver; an
    error beyond ``most``, where ``FeatureModel`` and ``onehot_vector`` do without them."""
    rows = df.select(F.col(col).cast("string").alias("v")).dropna().distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{col} has more than {most} values; use a vector")
    return sorted(r["v"] for r in rows)


def onehot_columns(col: str, values: Sequence[str]) -> dict[str, Column]:
    """``col_value`` columns for given values; unknown values and nulls are all zeros. ``FeatureModel`` makes a
    vector of a column of any number of values."""
    c = F.col(col).cast("string")
    return {f"{col}_{v}": F.coalesce((c == F.lit(v)).cast("double"), F.lit(0.0)) for v in values}


def route_columns(df: DataFrame, exclude: Sequence[str], high_cardinality: Sequence[str] = (),
                  skewed: Sequence[str] = ()) -> dict[str, list[str]]:
    """Columns by how they are encoded, from the schema: other strings are one-hot, other numbers
    scaled."""
    out = {"onehot": [], "skewed": list(skewed), "numeric": [], "ordinal": list(high_cardinality)}
    taken = {*exclude, *high_cardinality, *skewed}
    for f in df.schema:
        if f.name in taken:
            continue
        if isinstance(f.dataType, (T.StringType, T.BooleanType)):
            out["onehot"].append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            out["numeric"].append(f.name)
    return out


@dataclass
class FeatureModel:
    """Fitted column transformer. Rows keep their id and label; nothing is aligned by position.

    Columns with a coordinate per value come first, then skewed, numeric and ordinal ones. The values are tables, so that a
    column may have any number of them; the driver knows how many."""

    onehot: Mapping[str, tuple[DataFrame, int]]
    power: Mapping[str, tuple[float, float, float]]
    scale: Mapping[str, tuple[float, float]]
    codes: Mapping[str, DataFrame]

    @property
    def first(self) -> dict[str, int]:
        """Each column's first coordinate."""
        widths = {c: n for c, (_, n) in self.onehot.items()} | dict.fromkeys([*self.power, *self.scale, *self.codes], 1)
        return dict(zip(widths, accumulate([0, *widths.values()])))

    @property
    def size(self) -> int:
        return sum(n for _, n in self.onehot.values()) + len(self.power) + len(self.scale) + len(self.codes)

    def transform(self, df: DataFrame, keep: Sequence[str], out: str = "features") -> DataFrame:
        """``keep`` and a sparse vector. A null or unknown value has no coordinate among its column's values and code -1 as an
        ordinal; a missing number is NaN."""
        first, used = self.first, [*self.onehot, *self.power, *self.scale, *self.codes]
        rows = df.select(F.struct(*keep).alias("_keep"), *[F.col(f"`{c}`").alias(f"_in{i}") for i, c in enumerate(used)])
        place = {c: f"_in{i}" for i, c in enumerate(used)}
        entries = []
        for c, (codes, _) in self.onehot.items():
            rows = encode_ordinal(rows.withColumn(place[c], F.col(place[c]).cast("string")), place[c], codes, f"_one{place[c]}")
            code = F.col(f"_one{place[c]}")
            entries.append((code.cast("long") + first[c], F.when(code >= 0, F.lit(1.0))))
        for c, (lam, mean, std) in self.power.items():
            entries.append((F.lit(first[c]), standardize(yeo_johnson(F.col(place[c]), lam), mean, std)))
        for c, (mean, std) in self.scale.items():
            entries.append((F.lit(first[c]), standardize(F.col(place[c]), mean, std)))
        for c, codes in self.codes.items():
            rows = encode_ordinal(rows, place[c], codes, f"_code{place[c]}")
            entries.append((F.lit(first[c]), F.col(f"_code{place[c]}")))
        missing = F.lit(float("nan"))
        array = F.array(*[F.struct(i.cast("long").alias("index"), (v if n < len(self.onehot) else F.coalesce(v, missing)).alias("value"))
                          for n, (i, v) in enumerate(entries)])
        return as_vectors(rows.select("_keep.*", sparse(array, self.size).alias(out)), out)

    def names(self, spark: SparkSession) -> DataFrame:
        """(index, feature): ``col_value`` for the values of a column, else the column's name."""
        first = self.first
        single = [(first[c], c) for c in [*self.power, *self.scale, *self.codes]]
        out = spark.createDataFrame(single, "index long, feature string")
        for c, (codes, _) in self.onehot.items():
            out = out.unionByName(codes.select((F.col("code") + first[c]).alias("index"), F.concat(F.lit(f"{c}_"), "value").alias("feature")))
        return out


def fit_features(df: DataFrame, onehot: Sequence[str] = (), skewed: Sequence[str] = (),
                 numeric: Sequence[str] = (), ordinal: Sequence[str] = ()) -> FeatureModel:
    """Fit every column; one may be used in a single way only."""
    if len({*onehot, *skewed, *numeric, *ordinal}) < len([*onehot, *skewed, *numeric, *ordinal]):
        raise ValueError("a column is given twice")
    lambdas = {c: fit_yeo_johnson(df, c) for c in skewed}
    power = {}
    if lambdas:
        moved = df.select(*[yeo_johnson(F.col(c), lam).alias(c) for c, lam in lambdas.items()])
        moments = fit_scale(moved, list(lambdas))
        power = {c: (lambdas[c], *moments[c]) for c in lambdas}
    values = {}
    for c in onehot:
        codes = materialize(ordinal_codes(df.select(F.col(f"`{c}`").cast("string").alias("_value")), "_value"), "values")
        values[c] = codes, codes.count()
    codes = {c: materialize(ordinal_codes(df, c), "codes") for c in ordinal}
    return FeatureModel(values, power, fit_scale(df, numeric) if numeric else {}, codes)


def target_correlation(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """Correlation of each feature with the label, largest first."""
    row = df.agg(*[F.corr(number(c), number(label)).alias(c) for c in features])
    return _pairs(row, features, "correlation").orderBy(F.desc("correlation"), "feature")


def variance_filter(df: DataFrame, features: Sequence[str], threshold: float = MIN_VARIANCE) -> DataFrame:
    """Population variance per feature and whether it is above the threshold."""
    row = df.agg(*[F.var_pop(number(c)).alias(c) for c in features])
    return _pairs(row, features, "variance").withColumn("kept", F.col("variance") > F.lit(threshold))


def vector_variances(vectors: DataFrame, model: FeatureModel, threshold: float = MIN_VARIANCE) -> DataFrame:
    """(index, feature, variance, varied): population variance of every coordinate of ``FeatureModel`` vectors and whether it is above
    the threshold. Only stored coordinates are read and their sums shuffled; a missing number does not count."""
    spark = vectors.sparkSession
    n = vectors.count()
    value = F.nanvl("value", F.lit(None).cast("double"))
    sums = coordinates(vectors.select("features"), "features", []).groupBy("index").agg(
        F.sum(value).alias("s"), F.sum(value * value).alias("q"), F.sum(F.isnan("value").cast("int")).alias("missing"))
    rows = F.lit(n) - F.coalesce("missing", F.lit(0))
    mean = F.coalesce("s", F.lit(0.0)) / rows
    variance = F.greatest(F.coalesce("q", F.lit(0.0)) / rows - mean * mean, F.lit(0.0))
    out = model.names(spark).join(sums, "index", "left").select("index", "feature", variance.alias("variance"))
    return out.withColumn("varied", F.col("variance") > F.lit(threshold))


def pair_correlations(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(earlier, feature, correlation): absolute correlation of every feature with each earlier one, over the rows that have
    both; null where one is constant. One pass over the rows, whatever the number of features."""
    blocks = co_moments(df, F.array(*[number(c) for c in features]), len(features))
    return correlations(blocks, features).select("earlier", "feature", F.abs("correlation").alias("correlation"))


def vector_correlations(df: DataFrame, names: Sequence[str], vector: str = "features") -> DataFrame:
    """The same for the coordinates of a vector column."""
    blocks = co_moments(df, vector_to_array(vector), len(names))
    return correlations(blocks, names).select("earlier", "feature", F.abs("correlation").alias("correlation"))


def correlated_features(df: DataFrame, features: Sequence[str], threshold: float = MAX_CORRELATION) -> DataFrame:
    """Features that correlate above the threshold with an earlier one, and are to be dropped."""
    return too_close(pair_correlations(df, features), threshold)


def too_close(pairs: DataFrame, threshold: float = MAX_CORRELATION) -> DataFrame:
    """(feature): those of correlated pairs that have an earlier one above the threshold."""
    return pairs.filter(F.col("correlation") > threshold).select("feature").distinct()


def _pairs(row: DataFrame, names: Sequence[str], value: str) -> DataFrame:
    items = F.array(*[F.struct(F.lit(n).alias("feature"), number(n).alias(value)) for n in names])
    return row.select(F.explode(items).alias("p")).select("p.*")
