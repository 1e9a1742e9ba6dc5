"""Arithmetic on sentiment measures, rounding and relevance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Smallest share of rows and smallest count a term needs, by n-gram size.
MIN_SHARE = {1: 0.005, 2: 0.003, 3: 0.002}
MIN_COUNT = {1: 10, 2: 5, 3: 3}


def mean_of_two(a: Column, b: Column) -> Column:
    return (a + b) / F.lit(2)


def variation(difference: Column, base: Column) -> Column:
    """``difference / base``, 0 where the base is 0."""
    return F.when(base != 0, difference / base).otherwise(F.lit(0.0))


def sentiment_mix() -> dict[str, Column]:
    """Overall, contradiction and variation columns from article and title measures."""
    out = {}
    for kind in ("polarity", "subjectivity"):
        article, title = F.col(f"article_{kind}"), F.col(f"title_{kind}")
        out[f"overall_{kind}"] = mean_of_two(article, title)
        out[f"contradiction_{kind}"] = article - title
        out[f"{kind}_variations"] = variation(article - title, title)
    return out


def round_half_even(c: Column, places: int = 2) -> Column:
    """Binary half-even rounding, as array libraries do it (decimal ``round`` differs)."""
    scale = F.lit(float(10 ** places))
    return F.rint(c * scale) / scale


def round_to_tens(c: Column) -> Column:
    return F.bround(c, -1)


def list_count(items: Column, empty_is_one: bool = False) -> Column:
    """Number of entries, 0 for null; ``empty_is_one`` counts an empty list as one entry."""
    n = F.size(items)
    if empty_is_one:
        n = F.greatest(n, F.lit(1))
    return F.when(items.isNull(), F.lit(0)).otherwise(n)


def term_threshold(rows: Column, n: Column) -> Column:
    """Count below which a term of size ``n`` is dropped."""
    share = F.when(n == 1, MIN_SHARE[1]).when(n == 2, MIN_SHARE[2]).otherwise(MIN_SHARE[3])
    floor = F.when(n == 1, MIN_COUNT[1]).when(n == 2, MIN_COUNT[2]).otherwise(MIN_COUNT[3])
    return F.greatest(F.floor(rows * share).cast("bigint"), floor.cast("bigint"))


def relevance(real: Column, dubious: Column, places: int | None = 4) -> Column:
    total = real + dubious
    score = F.abs(real - dubious) / total
    return F.when(total > 0, score if places is None else round_half_even(score, places)).otherwise(F.lit(0.0))


def share_percent(part: Column, whole: Column) -> Column:
    return part / whole * F.lit(100)
