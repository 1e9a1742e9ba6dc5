"""Functions on list columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# One Python string literal in single or double quotes, with backslash escapes. The loops are
# possessive, which keeps Java from recursing once per repetition.
QUOTED = r"""(?:'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+")"""


def parse_list(c: Column) -> Column:
    """A Python-style list of strings as text to an array; anything malformed gives an empty array."""
    skeleton = F.regexp_replace(c, QUOTED, "''")
    valid = skeleton.rlike(r"^\s*\[\s*(?:''\s*(?:,\s*''\s*)*+,?\s*)?\]\s*$")
    items = F.regexp_extract_all(c, F.lit(f"({QUOTED})"), 1)
    bare = F.transform(items, lambda s: F.regexp_replace(s.substr(F.lit(2), F.length(s) - 2), r"\\(.)", "$1"))
    return F.coalesce(F.when(valid, bare), F.array().cast("array<string>"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often the body refers to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def map_items(items: Column, fn: Callable[[Column], Column]) -> Column:
    return F.transform(items, fn)


def run_lengths(items: Column) -> Column:
    """Distinct entries of an array with their number of occurrences, within the row.

    Sorting makes equal entries adjacent, so one pass over the positions finds where each run
    starts; no row leaves its partition.
    """
    def runs(s: Column) -> Column:
        size = F.size(s)
        positions = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(positions, lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        ends = F.slice(F.concat(starts, F.array(size)), F.lit(2), F.size(starts))
        return F.zip_with(starts, ends, lambda a, b: F.struct(F.get(s, a).alias("item"), (b - a).alias("cnt")))

    return let(F.sort_array(items), runs)


def phrases(tokens: Column, n: int, weak: Iterable[str] = ()) -> Column:
    """All runs of ``n`` neighbouring tokens joined by spaces, leaving out those made of ``weak``
    words only; empty if there are fewer tokens."""
    weak = list(weak)

    def strong(w: Column) -> Column:
        return ~w.isin(weak)

    if n == 1:
        return F.filter(tokens, strong) if weak else tokens
    # one flag per token, so that no phrase has to be taken apart again
    flagged = F.transform(tokens, lambda w: F.struct(w.alias("p"), (strong(w) if weak else F.lit(True)).alias("s")))
    out = flagged
    for shift in range(1, n):
        later = F.slice(flagged, shift + 1, F.greatest(F.size(tokens) - shift, F.lit(0)))
        out = F.zip_with(out, later, lambda a, b: F.struct(
            F.concat(a["p"], F.lit(" "), b["p"]).alias("p"), (a["s"] | b["s"]).alias("s")))
    # positions past the end were paired with null, which makes the phrase null
    kept = F.filter(out, lambda x: x["s"] & x["p"].isNotNull())
    return F.transform(kept, lambda x: x["p"])
