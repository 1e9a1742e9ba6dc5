"""Exact Jaccard join of shingle sets: inverted lists cut into blocks that are skipped by position, size and known answers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import discard, materialize, small
from .graph import components
from .tokens import slices
from .words import hash_shingles, hash_words, mixed

# Counters of how common shingles are: a table of fixed size, since it only decides the order of the prefixes.
COUNTERS = 1 << 18
COUNTER_BLOCK = 1 << 12
# Sets whose list entries a task remembers having written, so that copies are not written again.
REMEMBERED = 1 << 20
# Bytes of text whose shingles are held at once; the arrays over them take some 100 times as much.
SLICE_BYTES = 1 << 18
# Parts of the hash range by which a set's shingles are counted; two sets share at most the sum of the smaller counts.
PARTS = 64
# Entries of a list that are compared together.
BLOCK = 1024
# Entries up to which a list's pairs are formed before their counts by part are looked up; in longer lists each entry brings them along.
SHORT = 32
ENTRY = "token long, size int, place int, head boolean, c1 long, c2 long"


def shingle_sets(texts: pa.Array, words: int):
    """(first row, hashes, owners, sizes): the distinct shingles of the texts, sorted by text and hash."""
    for first, part in slices(texts, SLICE_BYTES):
        hashes, bounds = hash_shingles(*hash_words(part)[:2], words)
        owners = np.repeat(np.arange(len(part)), np.diff(bounds))
        order = np.lexsort((hashes, owners))
        hashes, owners = hashes[order], owners[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
        hashes, owners = hashes[new], owners[new]
        yield first, hashes, owners, np.bincount(owners, minlength=len(part))


def set_names(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers that name each set, equal for equal sets; zeros for the empty one."""
    out = np.zeros((2, len(sizes)), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        starts = (np.cumsum(sizes) - sizes)[full]
        for k, salt in enumerate((0x5851F42D4C957F2D, 0x14057B7EF767814F)):
            out[k, full] = mixed(np.add.reduceat(mixed(hashes ^ np.uint64(salt)), starts) + sizes[full].astype(np.uint64))
    return out[0].view(np.int64), out[1].view(np.int64)


def describe(docs: DataFrame, words: int) -> DataFrame:
    """(id, size, c1, c2, parts) of every document, and in rows without ``size`` the task's counters (block, counts)."""
    def tasks(batches):
        counters = np.zeros(COUNTERS, np.int32)
        for batch in batches:
            for first, hashes, owners, sizes in shingle_sets(batch.column(1), words):
                counters += np.bincount((hashes % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS).astype(np.int32)
                n, (c1, c2) = len(sizes), set_names(hashes, sizes)
                parts = np.bincount(owners * PARTS + (hashes >> np.uint64(58)).astype(np.int64), minlength=n * PARTS)
                parts = pa.ListArray.from_arrays(np.arange(0, n * PARTS + 1, PARTS, dtype=np.int32), parts.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(sizes, pa.int64()), pa.array(c1), pa.array(c2), parts,
                     pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        blocks = counters.reshape(-1, COUNTER_BLOCK)
        n = len(blocks)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int64())] * 4 + [pa.nulls(n, pa.list_(pa.int32())), pa.array(np.arange(n), pa.int32()),
                                             pa.array([b.tobytes() for b in blocks], pa.binary())], names)

    names = ["id", "size", "c1", "c2", "parts", "block", "counts"]
    return docs.mapInArrow(tasks, "id long, size long, c1 long, c2 long, parts array<int>, block int, counts binary")


def counters_of(described: DataFrame) -> np.ndarray:
    """How often each counter's shingles occur in all documents; a fixed 2 MB."""
    def added(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[block] = sums.get(block, 0) + np.frombuffer(counts, np.int32).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                                         ["block", "counts"])

    blocks = described.where("size IS NULL").select("block", "counts").repartition("block").mapInArrow(added, "block int, counts binary")
    out = np.zeros((COUNTERS // COUNTER_BLOCK, COUNTER_BLOCK), np.int64)
    for row in blocks.collect():
        out[row["block"]] = np.frombuffer(row["counts"], np.int64)
    return out.ravel()


def entries(docs: DataFrame, words: int, percent: int, counters: np.ndarray) -> DataFrame:
    """The inverted lists: for every set the shingles of its prefix, rare ones first.

    Two sets that link share a shingle within the first size - ceil(t size) + 1 of each, and, in the smaller one, within
    the first size - ceil(2 t / (1 + t) size) + 1 (``head``). ``place`` is the shingle's place in the set's order.
    """
    common = docs.sparkSession.sparkContext.broadcast(counters)

    def tasks(batches):
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for _, hashes, owners, sizes in shingle_sets(batch.column(1), words):
                c1, c2 = set_names(hashes, sizes)
                fresh = np.zeros(len(sizes), bool)
                for i, name in enumerate(zip(c1.tolist(), c2.tolist(), strict=True)):
                    fresh[i] = name not in seen
                    if len(seen) < REMEMBERED:
                        seen.add(name)
                rarity = common.value[(hashes % np.uint64(COUNTERS)).astype(np.int64)]
                order = np.lexsort((hashes, rarity, owners))
                place = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                size = np.repeat(sizes, sizes)
                prefix = size - -(-percent * size // 100) + 1
                heads = size - -(-2 * percent * size // (100 + percent)) + 1
                keep = (place < prefix) & fresh[owners]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[order][keep].view(np.int64)), pa.array(size[keep].astype(np.int32)),
                     pa.array(place[keep].astype(np.int32)), pa.array((place < heads)[keep]),
                     pa.array(c1[owners[keep]]), pa.array(c2[owners[keep]])],
                    ["token", "size", "place", "head", "c1", "c2"])

    return docs.mapInArrow(tasks, ENTRY)


def shared_lists(listed: DataFrame) -> DataFrame:
    """The lists with more than one set, every set once."""
    ordered = Window.partitionBy("token").orderBy("c1", "c2")
    whole = Window.partitionBy("token")
    return (listed.withColumns({"_c1": F.lag("c1").over(ordered), "_c2": F.lag("c2").over(ordered)})
            .where("_c1 IS NULL OR _c1 != c1 OR _c2 != c2").drop("_c1", "_c2")
            .withColumns({"_low": F.min("c1").over(whole), "_high": F.max("c1").over(whole)})
            .where("_low != _high").drop("_low", "_high"))


def with_pivots(lists: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The entries with the number of their set (``node``) in place of its names, and their ``pivot``: of the sets of its list in
    the same size band, whose sizes allow a link, the one that stands in most lists. A text that others vary shares its shingles
    with them, a variant has its own too."""
    band = F.floor(F.log("size") / -np.log(percent / 100) + 1e-9).cast("int")
    numbered = lists.join(classes.select("node", "c1", "c2"), ["c1", "c2"]).withColumn(
        "weight", F.count("*").over(Window.partitionBy("c1", "c2"))).drop("c1", "c2")
    ordered = Window.partitionBy("token", "band").orderBy(F.desc("weight"), "node")
    first = F.first(F.struct("node", "size", "place", "head")).over(ordered)
    return numbered.withColumn("band", band).withColumn("pivot", first).drop("weight", "band")


def may_link(a: str, b: str, percent: int):
    """What the sizes and places of two entries of a list leave open if this is the first shingle the sets share:
    all before it differ, and the smaller set has it among its heads."""
    size, place = (lambda e: F.col(f"{e}.size")), (lambda e: F.col(f"{e}.place"))
    low, high = F.least(size(a), size(b)), F.greatest(size(a), size(b))
    head = F.when(size(a) <= size(b), F.col(f"{a}.head")).otherwise(F.col(f"{b}.head"))
    return ((low * 100 >= high * percent) & head
            & ((place(a) + place(b)) * (100 + percent) <= (size(a) + size(b)) * (100 - percent)))


def most_shared(a: str, b: str):
    """How many shingles two sets share at most, by their counts by part of the hash range."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0), lambda n, x: n + x)


def weigh(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(x, y, open, apart): whether the counts by part leave a link open, and the least Jaccard distance they leave."""
    def side(name: str) -> DataFrame:
        wanted = small(materialize(pairs.select(F.col(name).alias("node")).distinct(), f"{name}s"))
        return classes.join(wanted, "node", "left_semi").select(
            F.col("node").alias(name), F.col("size").alias(f"{name}_size"), F.col("parts").alias(f"{name}_parts"))

    both = small(pairs).join(side("x"), "x").join(side("y"), "y").withColumn("most", most_shared("x_parts", "y_parts"))
    sizes = F.col("x_size") + F.col("y_size")
    return both.select("x", "y", (F.col("most") * (100 + percent) >= sizes * percent).alias("open"),
                       (1 - F.col("most") / (sizes - F.col("most"))).alias("apart"))


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(x, y, linked, apart): whether the sets link, and their Jaccard distance."""
    # each side moves only the sets that stand there
    left = sets.select(F.col("node").alias("x"), F.col("shingles").alias("_x")).join(small(materialize(pairs.select("x").distinct(), "xs")), "x", "left_semi")
    right = sets.select(F.col("node").alias("y"), F.col("shingles").alias("_y")).join(small(materialize(pairs.select("y").distinct(), "ys")), "y", "left_semi")
    both = small(pairs).join(left, "x").join(right, "y")
    shared = F.size(F.array_intersect("_x", "_y"))
    union = F.size("_x") + F.size("_y") - F.col("shared")
    return both.withColumn("shared", shared).withColumn("union", union).select(
        "x", "y", (F.col("shared") * 100 >= F.col("union") * percent).alias("linked"),
        (1 - F.col("shared") / F.col("union")).alias("apart"))


def fetch_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of the wanted classes (node, id, again, c1, c2), each read from the text of one document; ``again`` says that other rows
    have its id too, of which one is taken."""
    def read(batches):
        for batch in batches:
            for _, hashes, _, sizes in shingle_sets(batch.column(1), words):
                c1, c2 = set_names(hashes, sizes)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c1), pa.array(c2), pa.ListArray.from_arrays(ends, pa.array(hashes.view(np.int64)))],
                    ["c1", "c2", "shingles"])

    def fetched(some: DataFrame) -> DataFrame:
        ids = small(materialize(some.select(F.col("id").alias("_id")).distinct(), "ids"))
        texts = docs.join(ids, docs.id.eqNullSafe(ids._id), "left_semi")
        return texts.mapInArrow(read, "c1 long, c2 long, shingles array<long>").join(
            small(materialize(some.select("node", "c1", "c2"), "wanted")), ["c1", "c2"]).select("node", "shingles")

    out, again = fetched(wanted.where("NOT again")), wanted.where("again")
    if again.isEmpty():
        return out
    return out.union(fetched(again).groupBy("node").agg(F.first("shingles").alias("shingles")))


def mixed_lists(lists: DataFrame, groups: DataFrame, known: DataFrame) -> DataFrame:
    """Entries of lists whose sets are not all in one group yet, with their group, the least and the greatest distance to the
    pivot (``apart``, ``upto``) and the length of the list (``entries``)."""
    entry = lists.select("token", "size", "place", "head", "node", F.col("pivot.node").alias("pivot_node"))
    entry = entry.join(small(groups), "node", "left").withColumn("component", F.coalesce("component", "node"))
    whole = Window.partitionBy("token")
    entry = (entry.withColumns({"_low": F.min("component").over(whole), "_high": F.max("component").over(whole),
                                "entries": F.count("*").over(whole)})
             .where("_low != _high").drop("_low", "_high"))
    told = known.select(F.col("x").alias("node"), F.col("y").alias("pivot_node"), "apart", "upto")
    told = small(told.union(known.select("y", "x", "apart", "upto")))
    own = F.col("node") == F.col("pivot_node")
    return entry.join(told, ["node", "pivot_node"], "left").withColumns({
        "apart": F.when(own, 0.0).otherwise(F.coalesce("apart", F.lit(0.0))),
        "upto": F.when(own, 0.0).otherwise(F.coalesce("upto", F.lit(1.0)))})


def open_pairs(entries_: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(x, y) from different groups that share a list and may link.

    A pair is skipped if it is in one group, if sizes or places rule it out, or if the distances to a common pivot differ by
    more than a link allows. Lists of up to ``SHORT`` entries are compared at once. A longer one is compared block by block, and
    its entries bring their counts of shingles by part of the hash range, so that a pair that these rule out is not written,
    whatever the size of its group. Blocks are runs of a list in the order of size. A pair of blocks is skipped if their sizes
    are too far apart, if even their earliest places leave too little to share, or if all their sets are in one group.
    """
    apart = 1 - percent / 100 + 1e-9
    near = (F.col("l.pivot_node") != F.col("r.pivot_node")) | (
        (F.col("l.apart") - F.col("r.upto") <= apart) & (F.col("r.apart") - F.col("l.upto") <= apart))
    fits = (F.col("l.component") != F.col("r.component")) & may_link("l", "r", percent) & near
    found = F.least("l.node", "r.node").alias("x"), F.greatest("l.node", "r.node").alias("y")
    few, many = entries_.where(F.col("entries") <= SHORT), entries_.where(F.col("entries") > SHORT)
    met = few.alias("l").join(few.alias("r"), (F.col("l.token") == F.col("r.token")) & (F.col("l.node") < F.col("r.node")) & fits)
    pairs = met.select(*found).distinct()

    spot = F.row_number().over(Window.partitionBy("token").orderBy("size", "node"))
    cut = many.withColumn("block", F.floor((spot - 1) / BLOCK).cast("int"))
    blocks = cut.groupBy("token", "block").agg(
        F.min("size").alias("least"), F.max("size").alias("most"), F.min("place").alias("early"),
        F.min("component").alias("low"), F.max("component").alias("high"))
    a, b = blocks.alias("a"), blocks.alias("b")
    possible = (F.col("b.least") * percent <= F.col("a.most") * 100) & (
        (F.col("a.early") + F.col("b.early")) * (100 + percent) <= (F.col("a.most") + F.col("b.most")) * (100 - percent)) & (
        F.least("a.low", "b.low") != F.greatest("a.high", "b.high"))
    met = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.block") <= F.col("b.block")) & possible).select(
        F.col("a.token").alias("token"), F.col("a.block").alias("one"), F.col("b.block").alias("other"))
    cut = cut.join(classes.select("node", "parts"), "node")
    left = cut.withColumnRenamed("block", "one").join(met, ["token", "one"]).alias("l")
    right = cut.withColumnRenamed("block", "other").join(met, ["token", "other"]).alias("r")
    key = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("token", "one", "other")]
    once = (F.col("l.one") < F.col("l.other")) | (F.col("l.node") < F.col("r.node"))
    enough = most_shared("l.parts", "r.parts") * (100 + percent) >= (F.col("l.size") + F.col("r.size")) * percent
    long_pairs = left.join(right, key[0] & key[1] & key[2] & once & fits & enough).select(*found)
    return pairs.union(long_pairs).distinct()


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                   percent: int = 80) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable by links, its own included).

    Words are lower-cased (A-Z) runs without white space; a set is the distinct runs of ``words`` words, of a shorter text its
    whole sequence. Two documents link when ``100 * shared >= percent * union``; the join is exact. Documents with
    equal sets are one set, so copies cost one entry per list and task. Round one compares every entry of a list with its
    pivot only; sets linked to it share its answers as one group. Round two compares what is still open, skipping
    blocks and pairs by size, place, group and known distance. No pair is left out for the length of its list.

    Null and empty texts have no set and link with nothing. Repeated rows are equal sets; a null id is never the smallest unless
    all reachable ids are null. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    described = materialize(describe(texts, words), "sets")
    rows = described.where("size IS NOT NULL").select("id", "size", "c1", "c2")
    repeated = rows.groupBy("id").count().where("count > 1").select(F.col("id").alias("_id"))
    repeated = small(materialize(repeated, "repeated").withColumn("_again", F.lit(True)))
    classes = described.where("size > 0").groupBy("c1", "c2").agg(F.min("id").alias("id"), F.first("size").alias("size"), F.first("parts").alias("parts"))
    classes = classes.join(repeated, classes.id.eqNullSafe(F.col("_id")), "left").withColumn("again", F.coalesce("_again", F.lit(False)))
    classes = materialize(classes.drop("_id", "_again").withColumn("node", F.monotonically_increasing_id()), "classes")
    shared = materialize(shared_lists(entries(texts, words, percent, counters_of(described))), "lists")
    lists = materialize(with_pivots(shared, classes, percent), "lists")
    discard(shared)

    def judge(pairs: DataFrame) -> DataFrame:
        """(x, y, linked, apart, upto) of the pairs. Only sets of pairs that their counts by part leave open are read and moved."""
        weighed = materialize(weigh(pairs, classes, percent), "weighed")
        left_open = weighed.where("open").select("x", "y")
        nodes = left_open.select(F.col("x").alias("node")).union(left_open.select("y")).distinct()
        wanted = classes.join(nodes, "node", "left_semi").select("node", "id", "again", "c1", "c2")
        sets = materialize(fetch_sets(texts, materialize(wanted, "wanted"), words), "shingles")
        verified = materialize(verify(left_open, sets, percent), "verified")
        discard(sets)
        ruled_out = weighed.where("NOT open").select("x", "y", F.lit(False), "apart", F.lit(1.0))
        return verified.select("x", "y", "linked", "apart", F.col("apart").alias("upto")).union(ruled_out)

    to_pivot = (lists.withColumn("own", F.struct("size", "place", "head"))
                .where((F.col("node") != F.col("pivot.node")) & may_link("own", "pivot", percent))
                .select(F.least("node", "pivot.node").alias("x"), F.greatest("node", "pivot.node").alias("y")).distinct())
    known = judge(materialize(to_pivot, "pairs"))
    groups = materialize(components(known.where("linked"), "x", "y"), "groups")
    rest = materialize(mixed_lists(lists, groups, known), "open")
    discard(lists)
    second = open_pairs(rest, classes, percent)
    late = judge(materialize(second.join(known, ["x", "y"], "left_anti"), "pairs"))
    discard(rest)
    links = known.where("linked").select("x", "y").union(late.where("linked").select("x", "y"))
    groups = components(links, "x", "y")
    member = classes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = member.groupBy("component").agg(F.min("id").alias("component_id"))
    named = member.join(names, "component").select("c1", "c2", "component_id")
    found = rows.join(named, ["c1", "c2"], "left")
    return found.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"),
                        F.coalesce("component_id", "id").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The documents with the smallest id of their group of linked ones, all columns kept; cases as in ``link_documents``.

    Rows that share an id stay or go together, and go only if each of them is linked to a smaller id. Documents without
    words link with nothing and stay.
    """
    found = link_documents(docs, id_col, text_col, words, percent)
    gone = found.groupBy(F.col(id_col).alias("_gone")).agg(
        F.every(~F.col(id_col).eqNullSafe(F.col("component_id"))).alias("_all")).where("_all").select("_gone")
    gone = small(materialize(gone, "gone"))
    return docs.join(gone, docs[id_col].eqNullSafe(gone["_gone"]), "left_anti")
