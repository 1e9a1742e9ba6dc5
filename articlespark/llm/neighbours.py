"""Near-duplicate vectors by NN-descent: a neighbour graph refined through neighbours of neighbours."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize, small
from .common import sums_before
from .graph import components

# Neighbours a list holds; it is saturated if all of them are links.
NEIGHBOURS = 8
# Orders by sign codes that start the graph, vectors next to each other in one that are compared, and vectors per code.
ORDERS, NEXT, PER_CODE = 10, 8, 8
MOST_BITS = 40
# Refinement ends when a round adds less than this share of links, or after so many; attempts widen the start.
LEAST_GAIN, ROUNDS, ATTEMPTS = 0.01, 6, 3
# Vectors compared with all others to audit the recall, and the recall below which the start is widened.
AUDITED, LEAST_RECALL = 256, 0.995
# Vectors of a region that are compared together.
BLOCK = 256


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as one matrix of unit vectors in double precision."""
    width = len(column[0]) if len(column) else 0
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def by_width(batch: pa.RecordBatch, column: int):
    """(row numbers, unit vectors) per length of vector."""
    if not batch.num_rows:
        return
    widths = np.diff(batch.column(column).offsets.to_numpy())
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        yield rows, matrix(batch.column(column).take(pa.array(rows)))


def usable(vector: Column) -> Column:
    """Not null or empty, without null or non-finite components, not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def code_bits(count: Column) -> Column:
    """Planes that leave some PER_CODE of ``count`` vectors to a code."""
    return F.least(F.lit(MOST_BITS), F.greatest(F.lit(2), F.round(F.log2(count / PER_CODE + 1)))).cast("int")


def sign_codes(vectors: DataFrame, orders: int, seed: int) -> DataFrame:
    """Each vector once per order with the code of its sides of as many random planes as its ``bits``."""
    def coded(batches):
        for batch in batches:
            for rows, units in by_width(batch, 2):
                some = batch.take(pa.array(rows))
                bits = some.column(3).to_numpy()
                most = int(bits.max())
                weights = 1 << np.arange(most, dtype=np.int64)
                for order in range(orders):
                    # drawn plane by plane, so that a vector's first planes are the same in every batch
                    planes = np.random.default_rng([seed, units.shape[1], order]).standard_normal((most, units.shape[1])).T
                    codes = (((units @ planes) > 0) @ weights) & ((1 << bits.astype(np.int64)) - 1)
                    yield pa.RecordBatch.from_arrays(
                        [some.column(0), some.column(1), some.column(2), pa.array(np.full(len(rows), order), pa.int32()),
                         pa.array(codes, pa.int64())], ["node", "label", "vector", "way", "code"])

    return vectors.select("node", "label", "vector", "bits").mapInArrow(
        coded, "node long, label long, vector array<double>, way int, code long")


def adjacent(coded: DataFrame, threshold: float) -> DataFrame:
    """(u, v, cosine) of vectors at most NEXT places apart under the same code. The order inside a code is a hash, so that a code
    with very many vectors costs a row each; only the last rows are carried between batches."""
    def compared(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = 0 if held is None else held.num_rows
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            for own, units in by_width(rows, 2):
                node, new = rows.column(0).to_numpy()[own], own >= fresh
                keys = np.column_stack([rows.column(i).to_numpy()[own] for i in (1, 3, 4)])
                best = np.full(len(own), -2.0)
                found = []
                for step in range(1, min(NEXT, len(own) - 1) + 1):
                    near = (keys[step:] == keys[:-step]).all(axis=1) & new[step:]
                    at = np.flatnonzero(near)
                    if len(at):
                        found.append((at, at + step, np.einsum("ij,ij->i", units[at], units[at + step])))
                if found:
                    a, b, cosine = (np.concatenate(x) for x in zip(*found, strict=True))
                    np.maximum.at(best, a, cosine)
                    np.maximum.at(best, b, cosine)
                    keep = cosine >= np.minimum(best[a], best[b]) - (1 - threshold)
                    yield edges(node[a[keep]], node[b[keep]], cosine[keep])
            held = rows.slice(max(0, rows.num_rows - NEXT))

    tail = ["label", F.size("vector"), "way", "code"]
    placed = coded.repartition(*tail).sortWithinPartitions(*tail, F.xxhash64("way", "node"))
    return placed.mapInArrow(compared, "u long, v long, cosine double")


def edges(u, v, cosine) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([u, v])), pa.array(np.concatenate([v, u])),
                                       pa.array(np.concatenate([cosine, cosine]))], ["u", "v", "cosine"])


def nearest(graph: DataFrame) -> DataFrame:
    """The NEIGHBOURS nearest of every vector."""
    one = graph.groupBy("u", "v").agg(F.max("cosine").alias("cosine"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("cosine"), "v"))
    return one.withColumn("_rank", rank).where(F.col("_rank") <= NEIGHBOURS).drop("_rank")


def through_neighbours(graph: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """(u, v, cosine) of vectors that are neighbours of the same vector, forwards or backwards; backwards a vector has its nearest
    only, since very many may point to it. Pairs that both link with it belong to one region anyway and are left out."""
    back = F.row_number().over(Window.partitionBy("w").orderBy(F.desc("cosine"), "node"))
    backwards = graph.select(F.col("v").alias("w"), F.col("u").alias("node"), "cosine").withColumn("_rank", back).where(
        F.col("_rank") <= NEIGHBOURS)
    around = graph.select(F.col("u").alias("w"), F.col("v").alias("node")).union(backwards.select("w", "node"))
    around = around.union(graph.select(F.col("u").alias("w"), F.col("u").alias("node"))).distinct()

    def compared(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            w = rows.column(0).to_numpy()
            cut = int(np.searchsorted(-(w != w[-1]).astype(int), 0)) if w[0] != w[-1] else 0
            held = rows.slice(cut)
            if cut:
                yield from groups(rows.slice(0, cut))
        if held is not None:
            yield from groups(held)

    def groups(rows):
        # all of a group have one width, a batch may hold groups of several
        for own, units in by_width(rows, 2):
            yield from of_width(rows.column(0).to_numpy()[own], rows.column(1).to_numpy()[own], units)

    def of_width(w, node, units):
        found = []
        for step in range(1, 2 * NEIGHBOURS + 1):
            at = np.flatnonzero(w[step:] == w[:-step]) if step < len(w) else np.empty(0, int)
            if not len(at):
                break
            found.append((at, at + step, np.einsum("ij,ij->i", units[at], units[at + step])))
        if found:
            a, b, cosine = (np.concatenate(x) for x in zip(*found, strict=True))
            best = np.full(len(w), -2.0)
            np.maximum.at(best, a, cosine)
            np.maximum.at(best, b, cosine)
            # the vector in the middle stands in its own group; what links with it is joined already
            starts = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            own = starts + np.array([np.argmax(own) for own in np.split(node == w, starts[1:])])
            middle = units[np.repeat(own, np.diff(np.append(starts, len(w))))]
            linked = np.einsum("ij,ij->i", units, middle) >= threshold
            keep = (cosine >= np.minimum(best[a], best[b]) - (1 - threshold)) & ~(linked[a] & linked[b])
            yield edges(node[a[keep]], node[b[keep]], cosine[keep])

    held_vectors = vectors.select("node", "vector")
    placed = around.join(held_vectors, "node").select("w", "node", "vector").repartition("w").sortWithinPartitions("w", "node")
    return placed.mapInArrow(compared, "u long, v long, cosine double")


def neighbour_graph(vectors: DataFrame, threshold: float, orders: int, seed: int) -> DataFrame:
    """(u, v): the links found, after refinement."""
    start = materialize(adjacent(sign_codes(vectors, orders, seed), threshold), "adjacent")
    links = start.where(F.col("cosine") >= threshold).select("u", "v").distinct()
    graph, links = materialize(nearest(start), "graph"), materialize(links, "links")
    count = links.count()
    for _ in range(ROUNDS):
        found = materialize(through_neighbours(graph, vectors, threshold), "found")
        links = materialize(links.union(found.where(F.col("cosine") >= threshold).select("u", "v")).distinct(), "links")
        before, count = count, links.count()
        if count <= before * (1 + LEAST_GAIN):
            break
        graph = materialize(nearest(graph.unionByName(found)), "graph")
    return links


def audit(vectors: DataFrame, groups: DataFrame, threshold: float) -> float:
    """Share of the links of a fixed number of vectors, compared with all others, whose ends the graph has joined."""
    placed = vectors.select("node", "label", "vector").join(groups, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    sample = placed.orderBy(F.xxhash64(F.lit(5), "node")).limit(AUDITED).toArrow()
    chosen = list(by_width(sample.combine_chunks().to_batches()[0], 2)) if sample.num_rows else []
    probes = [(units, sample.column("node").to_numpy()[rows], sample.column("label").to_numpy()[rows],
               sample.column("component").to_numpy()[rows]) for rows, units in chosen]

    def counted(batches):
        true = joined = 0
        for batch in batches:
            for rows, units in by_width(batch, 2):
                for theirs, node, label, component in probes:
                    if theirs.shape[1] != units.shape[1]:
                        continue
                    near = (units @ theirs.T >= threshold) & (batch.column(1).to_numpy()[rows][:, None] == label) & (
                        batch.column(0).to_numpy()[rows][:, None] != node)
                    true += int(near.sum())
                    joined += int((near & (batch.column(3).to_numpy()[rows][:, None] == component)).sum())
        yield pa.RecordBatch.from_arrays([pa.array([true]), pa.array([joined])], ["true", "joined"])

    sums = placed.select("node", "label", "vector", "component").mapInArrow(counted, "true long, joined long").agg(
        F.sum("true"), F.sum("joined")).first()
    return sums[1] / sums[0] if sums[0] else 1.0


def regions(vectors: DataFrame, groups: DataFrame, threshold: float, seed: int) -> DataFrame:
    """(node, links): the lists enlarged to the whole region that a vector is joined with, as sizes.

    Each component is cut into blocks of vectors with like sign codes. Two blocks whose centres and radii keep all
    their vectors apart are skipped, two that hold them all together need no comparison; the others are compared
    as matrices, and of every pair of blocks only counts per vector go on.
    """
    joined = vectors.join(groups, "node").withColumn("copies", F.col("copies").cast("long"))
    coded = sign_codes(joined.select("node", F.col("label").cast("long").alias("label"), "vector", "bits"), 1, seed + 1)
    members = materialize(joined.select("node", "copies", "component", "bits").join(coded.select("node", "vector", "code"), "node"), "members")
    ranked = sums_before(members.select("node", "component", "code", F.lit(1).alias("one"), F.expr("shiftright(code, greatest(0, bits - 8))").alias("run")),
                         ["component"], "run", ["code", "node"], "one", "rank")
    placed = members.join(ranked.select("node", F.floor(F.col("rank") / BLOCK).alias("block")), "node")

    def gathered(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            component, block = rows.column(0).to_numpy(), rows.column(1).to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], (component[1:] != component[:-1]) | (block[1:] != block[:-1])]))
            held = rows.slice(int(starts[-1]))
            if len(starts) > 1:
                yield packed(rows, starts)
        if held is not None:
            yield packed(held, np.array([0, held.num_rows]))

    def packed(rows, starts):
        out = [[] for _ in range(7)]
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            units = matrix(rows.column(4).slice(a, b - a))
            centre = units.mean(axis=0)
            centre /= np.linalg.norm(centre) or 1.0
            radius = float(np.arccos(np.clip(units @ centre, -1, 1)).max())
            for values, value in zip(out, (rows.column(0)[a].as_py(), rows.column(1)[a].as_py(),
                                           rows.column(2).slice(a, b - a).to_numpy().tobytes(),
                                           rows.column(3).slice(a, b - a).to_numpy().tobytes(),
                                           units.tobytes(), centre.tolist(), radius), strict=True):
                values.append(value)
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)],
                                          ["component", "block", "nodes", "copies", "units", "centre", "radius"])

    order = placed.select("component", "block", "node", "copies", "vector").repartition("component", "block").sortWithinPartitions(
        "component", "block", "node")
    blocks = materialize(order.mapInArrow(gathered, "component long, block long, nodes binary, copies binary, units binary, "
                                                    "centre array<double>, radius double"), "blocks")
    light = blocks.select("component", "block", "centre", "radius")
    a, b = light.alias("a"), light.alias("b")
    between = F.aggregate(F.zip_with("a.centre", "b.centre", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), between)))
    reach, slack = math.acos(threshold), 1e-6
    met = (a.join(b, (F.col("a.component") == F.col("b.component")) & (F.col("a.block") <= F.col("b.block")))
           .where((F.col("a.block") == F.col("b.block")) | (angle - F.col("a.radius") - F.col("b.radius") <= reach + slack))
           .select(F.col("a.component").alias("component"), F.col("a.block").alias("one"), F.col("b.block").alias("other"),
                   (angle + F.col("a.radius") + F.col("b.radius") < reach - slack).alias("whole")))
    heavy = blocks.select("component", "block", "nodes", "copies", "units")
    left = heavy.select("component", F.col("block").alias("one"), *[F.col(c).alias(f"a_{c}") for c in ("nodes", "copies", "units")])
    right = heavy.select("component", F.col("block").alias("other"), *[F.col(c).alias(f"b_{c}") for c in ("nodes", "copies", "units")])
    pairs = met.join(left, ["component", "one"]).join(right, ["component", "other"])

    def counted(batches):
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            nodes, links = [], []
            for i in range(batch.num_rows):
                x, y, m, n = (np.frombuffer(columns[c][i].as_py(), np.int64) for c in ("a_nodes", "b_nodes", "a_copies", "b_copies"))
                same = columns["one"][i].as_py() == columns["other"][i].as_py()
                if columns["whole"][i].as_py() and not same:
                    near = np.ones((len(x), len(y)), bool)
                else:
                    p, r = (np.frombuffer(columns[c][i].as_py()) for c in ("a_units", "b_units"))
                    near = p.reshape(len(x), -1) @ r.reshape(len(y), -1).T >= threshold
                if same:
                    np.fill_diagonal(near, False)
                nodes.append(x)
                links.append(near @ n)
                if not same:
                    nodes.append(y)
                    links.append(m @ near)
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(links))], ["node", "links"])

    counts = pairs.select("one", "other", "whole", "a_nodes", "a_copies", "a_units", "b_nodes", "b_copies", "b_units").mapInArrow(
        counted, "node long, links long")
    return counts.groupBy("node").agg(F.sum("links").alias("links"))


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.98, seed: int = 5) -> DataFrame:
    """One row per vector: id, n_links (others linked directly), component_id, kept (id = component_id).

    Two vectors of the same label and length link if their cosine, in double precision, is at least ``threshold``. Equal
    vectors are one node with a number of copies. The graph starts from neighbours in sign-code orders, is refined through
    neighbours of neighbours until it gains nothing, and its links join vectors to regions. An audit compares a fixed number of
    vectors with all; below the least recall the start is widened and all is repeated. Lists that are full of links
    are not cut off: in the end every list is enlarged to its region and all its links are counted.

    A null label links with nothing, nor does a vector that is null, empty, zero or has null or non-finite components; it keeps
    itself. Repeated rows are copies that link with each other; null ids come last in a component. An empty
    table gives no rows.
    """
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                        F.col(vector_col).cast("array<double>").alias("vector"))
    fine = F.col("label").isNotNull() & usable(F.col("vector"))
    spelled = F.concat_ws(",", F.col("label").cast("string"), F.col("vector").cast("array<string>"))
    rows = materialize(rows.withColumn("name", F.when(fine, F.sha2(spelled, 256))), "vectors")
    nodes = materialize(rows.where("name IS NOT NULL").groupBy("name").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("id").alias("id"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    # a large label does not make the codes of a small one finer
    nodes = nodes.withColumn("width", F.size("vector"))
    sizes = nodes.groupBy("label", "width").count().select("label", "width", code_bits(F.col("count")).alias("bits"))
    nodes = materialize(nodes.join(small(sizes), ["label", "width"]).drop("width"), "coded")
    orders = ORDERS
    for attempt in range(ATTEMPTS):
        links = neighbour_graph(nodes, threshold, orders, seed + attempt)
        groups = materialize(components(links), "groups")
        if audit(nodes, groups, threshold) >= LEAST_RECALL:
            break
        orders *= 2
    counted = regions(nodes, groups, threshold, seed)
    known = nodes.select("name", "id", "node", "copies").join(groups, "node", "left").join(counted, "node", "left")
    known = known.withColumn("component", F.coalesce("component", "node"))
    named = known.groupBy("component").agg(F.min("id").alias("component_id"))
    known = known.join(named, "component").select(
        "name", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    found = rows.select("id", "name").join(known, "name", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    return found.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                        "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
