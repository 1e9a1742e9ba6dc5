"""Tables behind the charts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from math import sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .aggregates import count_by, map_counts, with_share
from .ngrams import histogram
from .ordering import SKETCH_ACCURACY, exact_quantiles
from .rows import filter_date_range, filter_from_date

BOX_PROBS = (0.0, 0.25, 0.5, 0.75, 1.0)


def scatter(df: DataFrame, x: str, y: str, label: str = "label", date_col: str | None = None,
            start: date | None = None, end: date | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Points of one pair of measures, within a date range if one is given."""
    if date_col:
        df = filter_date_range(df, date_col, start, end)
    return df.select(*keep, F.col(x).alias("x"), F.col(y).alias("y"), F.col(label).alias("label"))


def scatter_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], label: str = "label", date_col: str | None = None,
                  start: date | None = None, end: date | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Points of several pairs of measures from one pass, under the name of the first measure as ``pair``."""
    if date_col:
        df = filter_date_range(df, date_col, start, end)
    points = F.array(*[F.struct(F.lit(x).alias("pair"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")) for x, y in pairs])
    return df.select(*keep, F.explode(points).alias("_p"), F.col(label).alias("label")).select("_p.pair", *keep, "_p.x", "_p.y", "label")


def box(df: DataFrame, value: str, by: str = "label", approximate: bool = False, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Five-number summary per class.

    Exact, by sorting the distinct values; or ``approximate``, by sketches that are merged in one aggregate: then each quartile is
    a value of the data whose rank is off by no more than the class's rows divided by ``accuracy``."""
    names = ["low", "q1", "median", "q3", "high"]
    if approximate:
        given = df.dropna(subset=[by, value])
        quarters = F.percentile_approx(value, list(BOX_PROBS[1:-1]), accuracy)
        row = given.groupBy(by).agg(F.count("*").alias("n_rows"), F.min(value).alias("low"), quarters.alias("_q"), F.max(value).alias("high"))
        return row.select(by, "n_rows", F.col("low").cast("double").alias("low"),
                          *[F.get("_q", F.lit(i)).cast("double").alias(n) for i, n in enumerate(names[1:-1])], F.col("high").cast("double").alias("high"))
    q = exact_quantiles(df, by, value, BOX_PROBS)
    return q.select(by, "n_rows", *[F.col(f"q{i}").alias(n) for i, n in enumerate(names)])


def hexbin(df: DataFrame, x: str, y: str, value: str, gridsize: int) -> DataFrame:
    """Mean value and count per hexagon.

    Hexagon centres form two rectangular lattices shifted by half a cell; a point belongs to the
    nearer of its two candidates. Only the extent of the data is fetched to the driver.
    """
    points = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"),
                       F.col(value).cast("double").alias("v")).dropna()
    e = points.agg(*[f(c).alias(f"{n}{c}") for c in ("x", "y") for n, f in (("min", F.min), ("max", F.max))]).first()
    nx, ny = gridsize, int(gridsize / sqrt(3))

    def pad(lo, hi):
        # an empty or flat extent still needs a positive cell size
        return (0.0, 1.0) if lo is None else (lo, hi) if hi > lo else (lo - 0.1, hi + 0.1)

    (x0, x1), (y0, y1) = pad(e["minx"], e["maxx"]), pad(e["miny"], e["maxy"])
    # a small margin keeps points on the upper edge inside
    margin_x, margin_y = 1e-9 * (x1 - x0), 1e-9 * (y1 - y0)
    x0, x1, y0, y1 = x0 - margin_x, x1 + margin_x, y0 - margin_y, y1 + margin_y
    sx, sy = (x1 - x0) / nx, (y1 - y0) / ny
    gx, gy = (F.col("x") - F.lit(x0)) / F.lit(sx), (F.col("y") - F.lit(y0)) / F.lit(sy)
    cells = points.select("v", gx.alias("gx"), gy.alias("gy")).withColumns({
        "ix1": F.rint("gx"), "iy1": F.rint("gy"), "ix2": F.floor("gx"), "iy2": F.floor("gy")})
    d1 = F.pow(F.col("gx") - F.col("ix1"), 2) + 3.0 * F.pow(F.col("gy") - F.col("iy1"), 2)
    d2 = F.pow(F.col("gx") - F.col("ix2") - 0.5, 2) + 3.0 * F.pow(F.col("gy") - F.col("iy2") - 0.5, 2)
    first = d1 < d2
    placed = cells.select("v", F.when(first, F.col("ix1")).otherwise(F.col("ix2") + 0.5).alias("hx"),
                          F.when(first, F.col("iy1")).otherwise(F.col("iy2") + 0.5).alias("hy"))
    grouped = placed.groupBy("hx", "hy").agg(F.avg("v").alias("mean_value"), F.count("*").alias("n"))
    return grouped.withColumns({"center_x": F.col("hx") * F.lit(sx) + F.lit(x0),
                                "center_y": F.col("hy") * F.lit(sy) + F.lit(y0)})


def marginal_histogram(df: DataFrame, col: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram over the column's own range."""
    e = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")).first()
    lo, hi = (e["lo"], e["hi"]) if e["lo"] is not None else (0.0, 1.0)
    if hi == lo:
        lo, hi = lo - 0.5, hi + 0.5
    out = histogram(df, F.col(col), lo, hi, bins, keys)
    return out.withColumn("edge", F.lit(lo) + F.col("bin") * F.lit((hi - lo) / bins))


def timeline(df: DataFrame, date_col: str, start: date, label: str = "label") -> DataFrame:
    """Daily counts by class with the percentage of the day."""
    return with_share(count_by(filter_from_date(df, date_col, start), [date_col, label]), date_col)


def map_slices(df: DataFrame, real_label: int = 1) -> DataFrame:
    """Country counts per month, one choropleth frame each."""
    keys = ["year", "month", "country", "continent", "subcontinent"]
    return map_counts(df, keys, real_label).orderBy(*keys)
