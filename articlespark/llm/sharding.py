"""Placing documents on the shards of a weighted tree: region, rack, shard."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize
from .common import sums_before

#: Rows of a shard that are numbered in one task, about.
RUN_ROWS = 1 << 18
#: Hexadecimal digits of a digest that make a draw: 52 bits, exact in a double.
DRAW_DIGITS = 13


class Leaf(NamedTuple):
    """A shard's place in the tree and its weight; a rack or region weighs as much as its shards together."""
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def even_tree(shards: int, base: int = 8, per_rack: int = 2, racks: int = 2) -> list[Leaf]:
    """``shards`` equal shards: the first ``base`` fill racks and regions, and each one added later comes as a region
    of its own, so that only the root's draw gets a new candidate and rows move into the new shard alone."""
    leaves = [Leaf(k // (per_rack * racks), k // per_rack, k) for k in range(min(shards, base))]
    next_region, next_rack = -(-base // (per_rack * racks)), -(-base // per_rack)
    return leaves + [Leaf(next_region + k, next_rack + k, base + k) for k in range(shards - base)]


def _children(leaves: Sequence[Leaf]) -> tuple[dict, dict, dict]:
    """Weights of the regions, of each region's racks, of each rack's shards."""
    if not leaves or any(not leaf.weight > 0 for leaf in leaves):
        raise ValueError("a tree needs shards of positive weight")
    if len({leaf.shard for leaf in leaves}) < len(leaves) or len({(leaf.rack, leaf.region) for leaf in leaves}) > len({leaf.rack for leaf in leaves}):
        raise ValueError("a shard has one place and a rack one region")
    regions, racks, shards = {}, {}, {}
    for region, rack, shard, weight in leaves:
        regions[region] = regions.get(region, 0.0) + weight
        racks.setdefault(region, {})[rack] = racks.get(region, {}).get(rack, 0.0) + weight
        shards.setdefault(rack, {})[shard] = weight
    return regions, racks, shards


def _candidates(weights: dict[int, float]) -> Column:
    return F.array(*[F.struct(F.lit(int(n)).alias("n"), F.lit(float(w)).alias("w")) for n, w in sorted(weights.items())])


def _draw(key: Column, level: str, candidates: Column) -> Column:
    """The candidate with the earliest arrival: exponential draws at the rate of its weight, one digest each. A
    change of one weight moves keys only to or from that candidate."""
    def arrival(c: Column) -> Column:
        digest = F.md5(F.concat(F.lit(level), c["n"].cast("string"), F.lit(":"), key))
        bits = F.conv(F.substring(digest, 1, DRAW_DIGITS), 16, 10).cast("long")
        return F.struct((-F.log((bits + F.lit(0.5)) / F.lit(float(16 ** DRAW_DIGITS))) / c["w"]).alias("at"), c["n"].alias("n"))
    return F.array_min(F.transform(candidates, arrival))["n"]


def _under(parent: Column, children: dict[int, dict[int, float]]) -> Column:
    pairs = [part for n, weights in sorted(children.items()) for part in (F.lit(int(n)), _candidates(weights))]
    return F.element_at(F.create_map(*pairs), parent)


def descend(rows: DataFrame, key: Column, leaves: Sequence[Leaf], prefix: str = "") -> DataFrame:
    """Add ``region``, ``rack`` and ``shard`` (int, their names led by ``prefix``): a weighted hash draw at the root,
    then in the region it chose, then in the rack.

    Only the key and the tree decide. A row moves when the tree changes only if one of the draws on its way
    does: within a rack when a shard's weight moves against its neighbours', between racks or regions only as
    far as their sums change. A null key counts as empty.
    """
    regions, racks, shards = _children(leaves)
    name = F.coalesce(key.cast("string"), F.lit(""))
    region, rack, shard = (f"{prefix}{c}" for c in ("region", "rack", "shard"))
    rows = rows.withColumn(region, _draw(name, "region", _candidates(regions)))
    rows = rows.withColumn(rack, _draw(name, "rack", _under(F.col(region), racks)))
    return rows.withColumn(shard, _draw(name, "shard", _under(F.col(rack), shards)))


def assign(docs: DataFrame, leaves: Sequence[Leaf], grown: Sequence[Leaf] | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, region, rack, shard, slot and, with a ``grown`` tree, grown_shard.

    ``size`` is the text's UTF-8 bytes and one more; ``slot`` numbers a shard's rows from 0 without gaps, in
    the order of a digest of the id. The text is read once and never shuffled, and a shard of any size is numbered
    in runs of digests. A null text counts as empty, a null id as an empty name, so that all rows without
    an id share a shard; rows with the same id do too, and rows equal in id and text are interchangeable. An empty table
    gives no rows; other columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), (F.octet_length(text) + F.lit(1)).cast("long").alias("_size"),
                       F.crc32(text.cast("binary")).alias("_crc"))
    rows = descend(rows, F.col(id_col), leaves, "_")
    if grown is not None:
        rows = descend(rows, F.col(id_col), grown, "_grown_")
    digest = F.md5(F.concat(F.lit("slot:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    rows = materialize(rows.withColumns({"_digest": digest, "_one": F.lit(1).cast("long")}), "placed")
    digits = 1
    while rows.count() // len(leaves) > RUN_ROWS << (4 * digits):
        digits += 1
    # rows without an id share a digest, so their sizes and checksums spread them
    spread = F.when(F.col(id_col).isNull(), F.md5(F.concat_ws(":", "_crc", "_size"))).otherwise(F.col("_digest"))
    rows = rows.withColumn("_spread", spread).withColumn("_run", F.conv(F.substring("_spread", 1, digits), 16, 10).cast("long"))
    rows = sums_before(rows, ["_shard"], "_run", ["_spread", "_digest", "_crc", "_size"], "_one", "_slot", many=digits > 4)
    out = {"size": "_size", "text_crc32": "_crc", "region": "_region", "rack": "_rack", "shard": "_shard", "slot": "_slot"}
    if grown is not None:
        out["grown_shard"] = "_grown_shard"
    return rows.select(F.col(id_col), *[F.col(c).alias(n) for n, c in out.items()])


def write_shards(docs: DataFrame, leaves: Sequence[Leaf], path: str, key: str = "doc_id", files: int = 1) -> None:
    """Write whole rows, as the struct ``row``, below ``path`` in a folder per region, rack and shard, about ``files`` files each. A shard's rows
    are dealt over its files by the digest of the key, and a row without a key by all its columns."""
    placed = descend(docs.select(F.struct("*").alias("row")), F.col(f"row.{key}"), leaves)
    spread = F.when(F.col(f"row.{key}").isNull(), F.xxhash64("row")).otherwise(F.xxhash64(f"row.{key}"))
    placed = placed.repartition(len(leaves) * files, "shard", F.pmod(spread, F.lit(files)))
    placed.write.partitionBy("region", "rack", "shard").parquet(path)


def moved(rows: DataFrame, before: str = "shard", after: str = "grown_shard") -> DataFrame:
    """(before, after, rows) of the rows whose shard changes."""
    return rows.where(~F.col(before).eqNullSafe(F.col(after))).groupBy(before, after).agg(F.count("*").alias("rows"))
