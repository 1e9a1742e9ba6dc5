"""The trie of conversation prefixes: count-min screening, then exact grouping of what may be shared."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize, shuffle_width
from .common import sums_before
from .words import mixed

#: Turns of a conversation whose prefixes one task computes in a row: 2 to this power.
RUN_BITS = 10
#: Rows of the sketch, and the most cells a row may have (2 to this power, a bit each once merged: 16 MB in all).
SKETCH_ROWS, MAX_CELL_BITS = 2, 26
#: Cells that are merged together: 2 to this power.
BLOCK_BITS = 14
#: Conversation ids joined to one piece of a list before it is hashed.
PIECE = 256
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = ["depth", "a", "b"]


def _content(role: Column, text: Column) -> Column:
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def digested(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """(conv_id, position, content, chars): each turn as a digest of role and text and the text's code points, numbered
    from 0 within its conversation by turn, null first; equal turns by digest. Texts are not shuffled.

    Rows are ranged over all conversations before they are numbered, so that a conversation of any length is
    sorted in parts. Null role and text count as empty; rows without a conversation id belong to none and are left out.
    """
    c = {n: F.coalesce(F.col(n), F.lit("")) for n in (role, text)}
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        _content(c[role], c[text]).alias("content"),
        F.length(c[text]).cast("long").alias("chars"), F.lit(1).cast("long").alias("one"))
    order = ["conv_id", "turn", "content"]
    ranged = materialize(rows.repartitionByRange(shuffle_width(rows.sparkSession), *order)
                         .withColumn("part", F.spark_partition_id().cast("long")), "turns")
    return sums_before(ranged, ["conv_id"], "part", ["turn", "content"], "one", "position").select(
        "conv_id", "position", "content", "chars")


def spliced(turns: DataFrame, family: int, heads: int) -> DataFrame:
    """Conversations rebuilt: the first h turns of conversation c - c % ``family``, then c's own after its first h; h is
    the checksum of the decimal c modulo ``heads``. A conversation left without turns keeps one row without position."""
    turns = materialize(turns, "numbered")
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    plan = (sizes.withColumns({"h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads,
                               "base": F.col("conv_id") - F.col("conv_id") % family})
            .join(sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left")
            .withColumn("k", F.least("h", F.coalesce("base_n", F.lit(0))))
            .select("conv_id", "base", "h", "k", (F.greatest(F.lit(0), F.col("n") - F.col("h")) + F.col("k")).alias("n")))
    plan = materialize(plan, "plan")
    borrowed = (plan.join(turns.where(F.col("position") < heads).withColumnRenamed("conv_id", "base"), "base")
                .where(F.col("position") < F.col("h")).select("conv_id", "position", "content", "chars"))
    own = (turns.join(plan.select("conv_id", "h", "k"), "conv_id").where(F.col("position") >= F.col("h"))
           .select("conv_id", (F.col("position") - F.col("h") + F.col("k")).alias("position"), "content", "chars"))
    none = plan.where("n = 0").select("conv_id", F.lit(None).cast("long").alias("position"),
                                      F.lit(None).cast("string").alias("content"), F.lit(0).cast("long").alias("chars"))
    return borrowed.unionByName(own).unionByName(none)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, pa, pb, chars, more): every prefix of at least one turn with its digest (a, b), its parent's,
    the code points of its last text, and whether the conversation goes on.

    A prefix's digest is the exclusive or of the hashes of its (position, turn) pairs, 128 bits, so that a long conversation is
    computed in runs, each starting from the runs before it.
    """
    rows = turns.where("position IS NOT NULL").withColumns({
        "run": F.shiftright("position", RUN_BITS), "a": F.xxhash64("position", "content"),
        "b": F.xxhash64("content", F.lit("b"), "position")})
    runs = rows.groupBy("conv_id", "run").agg(F.bit_xor("a").alias("ra"), F.bit_xor("b").alias("rb"), F.count("*").alias("rn"))
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "run", F.coalesce(F.bit_xor("ra").over(before), F.lit(0)).alias("oa"),
                       F.coalesce(F.bit_xor("rb").over(before), F.lit(0)).alias("ob"),
                       F.sum("rn").over(Window.partitionBy("conv_id")).alias("n"))
    so_far = Window.partitionBy("conv_id", "run").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    whole = rows.join(runs, ["conv_id", "run"]).select(
        "conv_id", (F.col("position") + 1).alias("depth"), F.col("a").alias("la"), F.col("b").alias("lb"), "chars",
        F.bit_xor("a").over(so_far).bitwiseXOR(F.col("oa")).alias("a"), F.bit_xor("b").over(so_far).bitwiseXOR(F.col("ob")).alias("b"),
        (F.col("position") + 1 < F.col("n")).alias("more"))
    return whole.select("conv_id", "depth", "a", "b", F.col("a").bitwiseXOR(F.col("la")).alias("pa"),
                        F.col("b").bitwiseXOR(F.col("lb")).alias("pb"), "chars", "more")


def _cells(a: np.ndarray, b: np.ndarray, bits: int) -> list[np.ndarray]:
    """A cell in every row of the sketch for each digest."""
    a, b = a.view(np.uint64), b.view(np.uint64)
    return [(mixed(a + np.uint64(k) * (b | np.uint64(1))) >> np.uint64(64 - bits)).astype(np.int64) for k in range(1, SKETCH_ROWS + 1)]


def _longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def sketch(digests: DataFrame, bits: int) -> list[np.ndarray]:
    """Count-min rows over (a, b), as far as screening asks: per row, whether a cell was counted at least twice.

    Each task counts up to two per cell and hands on the blocks of cells it touched; blocks are added up by place.
    A row of 2 to the power of ``bits`` cells, whatever the number of digests.
    """
    block = 1 << min(BLOCK_BITS, bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [np.zeros(1 << bits, np.uint8) for _ in range(SKETCH_ROWS)]
        for batch in batches:
            for row, cells in zip(rows, _cells(_longs(batch, "a"), _longs(batch, "b"), bits)):
                cell, n = np.unique(cells, return_counts=True)
                row[cell] = np.minimum(2, row[cell] + np.minimum(n, 2).astype(np.uint8))
        for k, row in enumerate(rows):
            blocks = row.reshape(-1, block)
            for spot in np.flatnonzero(blocks.any(axis=1)):
                yield pa.RecordBatch.from_pydict({"line": [k], "block": [int(spot)], "cells": [blocks[spot].tobytes()]}, schema=schema)

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(block, np.uint8)
        for batch in batches:
            for cells in batch.column("cells"):
                total = np.minimum(2, total + np.frombuffer(cells.as_py(), np.uint8))
        yield pa.RecordBatch.from_pydict({"line": [key[0].as_py()], "block": [key[1].as_py()], "cells": [np.packbits(total > 1).tobytes()]},
                                         schema=schema)

    schema = pa.schema([("line", pa.int32()), ("block", pa.int64()), ("cells", pa.binary())])
    ddl = "line int, block long, cells binary"
    merged = digests.mapInArrow(count, ddl).groupBy("line", "block").applyInArrow(add, ddl)
    # at most SKETCH_ROWS * 2 ** MAX_CELL_BITS bits
    rows = [np.zeros((1 << bits) // 8, np.uint8) for _ in range(SKETCH_ROWS)]
    for line, spot, cells in merged.collect():
        rows[line][spot * block // 8:(spot + 1) * block // 8] = np.frombuffer(cells, np.uint8)
    return rows


def screened(paths: DataFrame) -> DataFrame:
    """Add ``kept`` and ``shared``: whether the parent's, and the prefix's own estimate is above one. An estimate of one proves that
    no other conversation has the prefix; then none has a longer one either."""
    bits = max(BLOCK_BITS, min(MAX_CELL_BITS, (4 * max(paths.count(), 1)).bit_length()))
    rows = paths.sparkSession.sparkContext.broadcast(sketch(paths.select("a", "b"), bits))

    def several(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.ones(len(a), bool)
        for row, cells in zip(rows.value, _cells(a, b, bits)):
            out &= (row[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8) & 1).astype(bool)
        return out

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = several(_longs(batch, "pa"), _longs(batch, "pb")) | (_longs(batch, "depth") == 1)
            shared = several(_longs(batch, "a"), _longs(batch, "b"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kept), pa.array(shared)], [*batch.schema.names, "kept", "shared"])

    return paths.mapInArrow(screen, paths.schema.simpleString()[7:-1].replace(":", " ") + ", kept boolean, shared boolean")


def list_digests(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): the SHA-256 of each node's conv_ids in ascending order, joined by commas.

    Ids are sorted over ranges that cut through nodes and joined to pieces there; a node's pieces then pass one
    task as a stream, a piece per ``PIECE`` ids, which only feeds the hash and holds none of them.
    """
    order = [*NODE, "conv_id"]
    ranged = materialize(ends.select(*order).repartitionByRange(shuffle_width(ends.sparkSession), *order)
                         .withColumn("part", F.spark_partition_id()), "ends")
    at = F.row_number().over(Window.partitionBy("part", *NODE).orderBy("conv_id")) - 1
    pieces = (ranged.withColumns({"spot": at, "piece": F.floor(at / PIECE)}).groupBy(*NODE, "part", "piece")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")))
    pieces = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "part", "piece").select(*NODE, "ids")
    schema = pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])

    def feed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for *at, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
                if at != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = at, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t.type) for i, t in enumerate(schema)], schema=schema)
        if node is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*node, state.hexdigest())))], schema=schema)

    return pieces.mapInArrow(feed, "depth long, a long, b long, ends_sha256 string")


def build(turns: DataFrame) -> DataFrame:
    """One row per node of the trie over (conv_id, position, content, chars), with a row without position for a conversation without turns:

    conv_id (smallest member), depth, parent_conv_id (of its parent; null at the root), n_convs, n_children, n_leaves
    (childless nodes in its subtree), saved_tokens (over its subtree, (n_convs - 1) x code points of the last text), ends_sha256.

    Prefixes whose parent has an estimate of one are nobody else's: their nodes are written from the row itself. Only the others
    are shuffled, as digests, and grouped exactly. Every node belongs to its smallest member and a member's own nodes are
    the deepest of its path, so a subtree's sums are those of its members' own nodes: no walk over the tree, whatever its depth.
    An empty table gives no nodes. Nodes are equal when depth and 128-bit digest are.
    """
    turns = materialize(turns, "rebuilt")
    table = materialize(screened(materialize(prefixes(turns), "prefixes")), "screened")
    tails = table.where("NOT kept").select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
        F.col("more").cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("more"), F.lit(EMPTY)).otherwise(F.sha2(F.col("conv_id").cast("string"), 256)).alias("ends_sha256"))

    # conversations at the root: by their first turn, or by the row that stands for none
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = turns.where("position IS NULL OR position = 0").select(
        "conv_id", zero.alias("depth"), zero.alias("a"), zero.alias("b"), none.alias("pa"), none.alias("pb"), zero.alias("chars"),
        F.col("position").isNotNull().alias("more"), F.lit(True).alias("shared"))
    rows = table.where("kept").drop("kept").unionByName(root)

    nodes = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("owner"), F.count("*").alias("n"), F.first("chars").alias("chars"), F.first("pa").alias("pa"),
        F.first("pb").alias("pb"), F.bool_or(F.col("more") & ~F.col("shared")).alias("tail"), F.bool_or(~F.col("more")).alias("end"))
    nodes = materialize(nodes, "nodes")
    children = (nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"))
                .agg(F.count("*").alias("children")))
    # a node's children share a key, so this join's large side is split where one is frequent
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("owner").alias("parent"))
    nodes = nodes.join(children, NODE, "left").withColumn("children", F.coalesce("children", zero))
    nodes = materialize(nodes.join(parents.where("depth > 0"), ["depth", "pa", "pb"], "left"), "linked")

    # what a member's own nodes save from each depth on, and whether they end in a leaf
    saved = ((F.col("n") - 1) * F.col("chars")).alias("saved")
    own = nodes.select("owner", "depth", saved, (-F.col("depth")).alias("up"), (F.col("children") == 0).alias("leaf"))
    members = own.groupBy("owner").agg(F.min("depth").alias("top"), F.sum("saved").alias("all"), F.max("leaf").alias("leaf"))
    below = sums_before(own.withColumn("run", F.shiftright("up", RUN_BITS)), ["owner"], "run", ["up"], "saved", "below")
    below = below.select("owner", "depth", (F.col("below") + F.col("saved")).alias("below"))
    others = (rows.select("conv_id", *NODE).join(members.withColumnRenamed("owner", "conv_id"), "conv_id").where("depth < top")
              .groupBy(*NODE).agg(F.sum("all").alias("others"), F.sum(F.col("leaf").cast("long")).alias("leaves")))
    ends = list_digests(rows.where("NOT more AND shared"))
    whole = (nodes.join(others, NODE, "left").join(below, ["owner", "depth"]).join(members.select("owner", "leaf"), "owner")
             .join(ends, NODE, "left"))
    alone = F.when(F.col("end"), F.sha2(F.col("owner").cast("string"), 256)).otherwise(F.lit(EMPTY))
    done = whole.select(
        F.col("owner").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "owner")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), (F.col("children") + F.col("tail").cast("long")).alias("n_children"),
        (F.col("leaf").cast("long") + F.coalesce("leaves", zero)).alias("n_leaves"),
        (F.col("below") + F.coalesce("others", zero)).alias("saved_tokens"), F.coalesce("ends_sha256", alone).alias("ends_sha256"))
    return done.unionByName(tails)


def prefix_trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of the conversations as they are, see ``build`` and ``digested``."""
    return build(digested(conversations, conv, turn, role, text))


def with_text(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """Add to each node of ``prefix_trie`` the ``role`` and ``text`` of its last turn; null at the root. Every distinct turn is
    shuffled once."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said = (conversations.select(_content(role, text).alias("content"), F.struct(role.alias("role"), text.alias("text")).alias("said"))
            .groupBy("content").agg(F.first("said").alias("said")))
    places = digested(conversations).select("conv_id", (F.col("position") + 1).alias("depth"), "content")
    return (nodes.join(places, ["conv_id", "depth"], "left").join(said, "content", "left")
            .select(*nodes.columns, "said.role", "said.text"))
