"""Repeated passages by sparse suffix arrays: suffixes at minimiser positions, sorted, compared with their neighbours."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize, shuffle_width, small
from .tokens import slices
from .words import hash_shingles, hash_words, mixed

# Words that a suffix is grouped by, and words that a position's rank is taken from.
PREFIX, RANKED = 20, 5
# Neighbours on either side that a suffix is compared with.
NEIGHBOURS = 4
# Rows of a frequent key that are carried from one batch to the next.
HELD = 10_000
SUFFIX = ["key", "right", "left", "c1", "c2", "pos"]
ENTRY = "key long, right binary, left binary, c1 long, c2 long, pos int, back int, n int"
MATCH = "c1 long, c2 long, start int, stop int, o1 long, o2 long, key long"
BORDER = "right binary, left binary, border boolean, part int, tail boolean"


class Sparse:
    """Word hashes of some texts with the suffixes kept for passages of ``least`` words.

    A suffix starts at a position whose RANKED words have the least hash among ``reach`` positions in a row, so a passage of
    ``least`` words keeps, wherever it stands, the same suffix with at least PREFIX words of the passage after it.
    """

    def __init__(self, texts: pa.Array, least: int):
        self.least, self.reach = least, least - PREFIX + 1
        self.words, self.bounds, _ = hash_words(texts)
        self.counts = np.diff(self.bounds)
        owner = np.repeat(np.arange(len(self.counts)), self.counts)
        inside = np.arange(len(self.words), dtype=np.uint64) - np.repeat(self.bounds[:-1], self.counts).astype(np.uint64)
        self.names = np.zeros((2, len(self.counts)), np.uint64)
        full = np.flatnonzero(self.counts)
        if len(full):
            for k, salt in enumerate((0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)):
                value = mixed(self.words ^ mixed(inside + np.uint64(salt)))
                self.names[k, full] = mixed(np.add.reduceat(value, self.bounds[:-1][full]))
        self.owner = owner

    def starts(self) -> np.ndarray:
        """Places of the kept suffixes among all words."""
        return self.kept()[0]

    def kept(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, back, n): the kept suffixes, and that they are kept for ``n`` windows of ``least`` words in a row, the first
        of which begins ``back`` words before. Every window keeps one suffix, chosen by its own words only."""
        n, reach = len(self.words), self.reach
        if n < self.least:
            return (np.empty(0, np.int64),) * 3
        rank, _ = hash_shingles(self.words, np.array([0, n]), RANKED)
        best, size = np.arange(len(rank)), 1
        while size * 2 <= reach:  # leftmost least of doubled runs
            a, b = best[:-size], best[size:]
            best = np.where(rank[b] < rank[a], b, a)
            size *= 2
        if size < reach:
            a, b = best[:len(best) - (reach - size)], best[reach - size:]
            best = np.where(rank[b] < rank[a], b, a)
        first = np.arange(len(best))
        first = first[first + self.least <= n]
        whole = self.owner[first] == self.owner[first + self.least - 1]
        first = first[whole]
        starts, at, count = np.unique(best[first], return_index=True, return_counts=True)
        return starts, starts - first[at], count

    def prefixes(self, starts: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(starts), np.uint64)
        for k in range(PREFIX):
            sums += mixed(self.words[starts + k] + np.uint64(k)) * np.uint64(2 * k + 1)
        return mixed(sums).view(np.int64)

    def around(self, starts: np.ndarray, left: bool) -> np.ndarray:
        """The ``reach`` - 1 words before the suffix, nearest first, or after its prefix; 4 bytes each, big-endian, 0 beyond the text."""
        step = np.arange(self.reach - 1)
        spots = starts[:, None] + (-1 - step if left else PREFIX + step)
        owner = self.owner[starts]
        beyond = (spots < self.bounds[owner][:, None]) | (spots >= self.bounds[owner + 1][:, None])
        words = (self.words[np.clip(spots, 0, max(len(self.words) - 1, 0))] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        return np.where(beyond, 0, words).astype(">u4")


def rows_of(block: np.ndarray) -> pa.Array:
    width = block.shape[1] * 4
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(block), [None, pa.py_buffer(block.tobytes())]).cast(pa.binary())


def keys_of(docs: DataFrame, least: int) -> DataFrame:
    """(c1, c2, n, id, key, pos): a row per document, and a row with ``key`` per kept suffix."""
    def tasks(batches):
        for batch in batches:
            for first, part in slices(batch.column(1)):
                sparse = Sparse(part, least)
                c1, c2 = sparse.names.view(np.int64)
                starts = sparse.starts()
                owner = sparse.owner[starts]
                n, m = len(part), len(starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([c1, c1[owner]])), pa.array(np.concatenate([c2, c2[owner]])),
                     pa.concat_arrays([pa.array(sparse.counts, pa.int64()), pa.nulls(m, pa.int64())]),
                     pa.concat_arrays([batch.column(0).slice(first, n), pa.nulls(m, pa.int64())]),
                     pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(sparse.prefixes(starts), pa.int64())]),
                     pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array((starts - sparse.bounds[owner]).astype(np.int32))])],
                    ["c1", "c2", "n", "id", "key", "pos"])

    return docs.mapInArrow(tasks, "c1 long, c2 long, n long, id long, key long, pos int")


def suffix_rows(texts: DataFrame, least: int) -> DataFrame:
    """The suffixes at the given places with the words around them; ``texts`` has text, places, c1, c2."""
    def tasks(batches):
        for batch in batches:
            for first, part in slices(batch.column(0)):
                sparse = Sparse(part, least)
                c1, c2 = sparse.names.view(np.int64)
                wanted = batch.slice(first, len(part))
                places = wanted.column(1)
                owner = np.repeat(np.arange(len(part)), np.diff(places.offsets.to_numpy()))
                same = (c1 == wanted.column(2).to_numpy()) & (c2 == wanted.column(3).to_numpy())
                pos = places.flatten().to_numpy()
                pos, owner = pos[same[owner]], owner[same[owner]]
                starts = sparse.bounds[owner] + pos
                if len(starts):
                    kept, back, count = sparse.kept()
                    spot = np.searchsorted(kept, starts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(sparse.prefixes(starts)), rows_of(sparse.around(starts, False)), rows_of(sparse.around(starts, True)),
                         pa.array(c1[owner]), pa.array(c2[owner]), pa.array(pos.astype(np.int32)),
                         pa.array(back[spot].astype(np.int32)), pa.array(count[spot].astype(np.int32))], [*SUFFIX, "back", "n"])

    return texts.mapInArrow(tasks, ENTRY)


def common(block: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading words two rows have in common."""
    equal = (block[a] == block[b]) & (block[a] != 0)
    return np.where(equal.all(axis=1), equal.shape[1], np.argmin(equal, axis=1))


def compare(rows: pa.RecordBatch, least: int, fresh: int) -> pa.RecordBatch | None:
    """Matches of at least ``least`` words between near rows of the sorted order. Pairs of rows before ``fresh`` have
    been compared."""
    key, c1, c2, pos = (rows.column(i).to_numpy() for i in (0, 3, 4, 5))
    n = len(key)
    width = least - PREFIX
    right, left = (np.frombuffer(b"".join(rows.column(i).to_pylist()), ">u4").reshape(n, width) for i in (1, 2))
    run = np.cumsum(np.concatenate([[0], ((key[1:] != key[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])).astype(int)]))
    first_of, last_of = np.searchsorted(run, run), np.searchsorted(run, run, side="right") - 1
    pairs = []
    for step in range(NEIGHBOURS):
        # the rows of a text that repeats itself stand together; they all meet the texts on either side
        before = first_of - 1 - step
        ok = np.flatnonzero(before >= 0)
        ok = ok[key[before[ok]] == key[ok]]
        pairs.append((ok, before[ok]))
        after = last_of + 1 + step
        ok = np.flatnonzero(after < n)
        ok = ok[key[after[ok]] == key[ok]]
        pairs.append((ok, after[ok]))
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
    other = (c1[a] != c1[b]) | (c2[a] != c2[b])
    a, b = a[other & (np.maximum(a, b) >= fresh)], b[other & (np.maximum(a, b) >= fresh)]
    if not len(a):
        return None
    back, on = common(left, a, b), common(right, a, b)
    good = back + PREFIX + on >= least
    if not good.any():
        return None
    a, b, back, on = a[good], b[good], back[good], on[good]
    # all matches of a suffix hold it, so together they are one span; its other text is that of the longest
    order = np.lexsort((back + on, a))
    a, b, back, on = a[order], b[order], back[order], on[order]
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    last = np.append(first[1:], len(a)) - 1
    back, on = (np.maximum.reduceat(x, first) for x in (back, on))
    a, b = a[last], b[last]
    start, stop = ((pos[a] + x).astype(np.int32) for x in (-back, PREFIX + on))
    return pa.RecordBatch.from_arrays(
        [pa.array(c1[a]), pa.array(c2[a]), pa.array(start), pa.array(stop), pa.array(c1[b]), pa.array(c2[b]), pa.array(key[a])],
        ["c1", "c2", "start", "stop", "o1", "o2", "key"])


def all_matches(suffixes: DataFrame, least: int, first: str, then: str) -> DataFrame:
    """MATCH rows of the suffixes in one sorted order, also across the borders of its ranges."""
    order = ["key", first, then, "c1", "c2", "pos"]
    compared = materialize(sorted_matches(suffixes, least, order), "compared")
    columns = [c.split()[0] for c in MATCH.split(", ")]
    return compared.where("NOT border").select(columns).union(
        border_matches(compared.where("border"), least, order).select(columns))


def sorted_matches(suffixes: DataFrame, least: int, order: list[str]) -> DataFrame:
    """Compare the neighbours of the sorted suffixes: MATCH rows, and rows of ``border`` with a suffix each.

    The sort is global, so that a frequent suffix is spread over tasks. The rows at both ends of each range are handed on,
    to be compared once more across the border; of a key with so many rows that its windows are compared by hash, none are, and no
    more than HELD from one batch to the next.
    """
    def tasks(batches):
        held, first = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = 0 if held is None else held.num_rows
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if first:
                yield handed_on(narrow(ends(rows, True)), False)
                first = False
            found = compare(rows, least, fresh)
            if found is not None:
                n = found.num_rows
                yield pa.RecordBatch.from_arrays(found.columns + [pa.nulls(n, pa.binary())] * 2 + [
                    pa.array([False] * n), pa.nulls(n, pa.int32()), pa.nulls(n, pa.bool_())], names)
            held = ends(rows, False)
            held = held.slice(max(0, held.num_rows - HELD))
        if held is not None:
            yield handed_on(narrow(held), True)

    def narrow(rows):
        # a key with more rows than that is wide, and its windows are compared by hash as well
        return rows if rows.num_rows <= NEIGHBOURS + 1 else rows.slice(0, 0)

    def handed_on(rows, tail):
        n, columns = rows.num_rows, dict(zip(rows.schema.names, rows.columns, strict=True))
        return pa.RecordBatch.from_arrays(
            [columns["c1"], columns["c2"], columns["pos"], pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
             columns["key"], columns["right"], columns["left"], pa.array([True] * n, pa.bool_()),
             pa.array([TaskContext.get().partitionId()] * n, pa.int32()), pa.array([tail] * n, pa.bool_())], names)

    names = [c.split()[0] for c in f"{MATCH}, {BORDER}".split(", ")]
    ranged = suffixes.repartitionByRange(shuffle_width(suffixes.sparkSession), *order).sortWithinPartitions(*order)
    return ranged.mapInArrow(tasks, f"{MATCH}, {BORDER}")


def ends(rows: pa.RecordBatch, head: bool) -> pa.RecordBatch:
    """The first or last NEIGHBOURS + 1 texts of the first or last key, with all their rows."""
    key, c1, c2 = (rows.column(i).to_numpy() for i in (0, 3, 4))
    new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])]))
    if head:
        stop = int(new[NEIGHBOURS + 1]) if len(new) > NEIGHBOURS + 1 else len(key)
        other = np.flatnonzero(key[:stop] != key[0])
        return rows.slice(0, int(other[0]) if len(other) else stop)
    start = int(new[-min(len(new), NEIGHBOURS + 1)])
    other = np.flatnonzero(key[start:] != key[-1])
    return rows.slice(start + (int(other[-1]) + 1 if len(other) else 0))


def border_matches(border: DataFrame, least: int, order: list[str]) -> DataFrame:
    """Compare what the ranges handed on, border by border: the last rows of one range with the first of the next, a few of each."""
    def task(rows: pa.Table) -> pa.Table:
        rows = rows.drop_columns(["edge"]).sort_by([(c, "ascending") for c in order]).combine_chunks()
        found = compare(rows.to_batches()[0], least, 0)
        return pa.Table.from_batches([] if found is None else [found], schema)

    types = {"long": pa.int64(), "int": pa.int32()}
    schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in MATCH.split(", ")])
    # ranges that hold rows, in order: no more than there are partitions
    ranges = border.select("part").distinct().withColumn("range", F.row_number().over(Window.orderBy("part")))
    edge = F.col("range") + F.col("tail").cast("int")
    rows = border.join(F.broadcast(ranges), "part").select(edge.alias("edge"), "key", "right", "left", "c1", "c2", F.col("start").alias("pos"))
    return rows.groupBy("edge").applyInArrow(task, MATCH)


def repeated_windows(suffixes: DataFrame, least: int) -> DataFrame:
    """Matches of exactly ``least`` words around the given suffixes, from hashes of all windows that a suffix is kept for."""
    def tasks(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            key, c1, c2, pos, most, n = (batch.column(i).to_numpy() for i in (0, 3, 4, 5, 6, 7))
            right, left = (np.frombuffer(b"".join(batch.column(i).to_pylist()), ">u4").reshape(len(key), -1).astype(np.uint64)
                           for i in (1, 2))
            for back in range(left.shape[1] + 1):
                on = left.shape[1] - back
                own = np.flatnonzero((back <= most) & (back > most - n))
                value = mixed(key[own].view(np.uint64) + np.uint64(back))
                for words in (left[own, :back], right[own, :on]):
                    for k in range(words.shape[1]):
                        value = mixed(value ^ words[:, k])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value.view(np.int64)), pa.array(c1[own]), pa.array(c2[own]), pa.array((pos[own] - back).astype(np.int32))],
                    ["window", "c1", "c2", "start"])

    windows = suffixes.mapInArrow(tasks, "window long, c1 long, c2 long, start int")
    first, last = F.min(F.struct("c1", "c2")), F.max(F.struct("c1", "c2"))
    shared = windows.groupBy("window").agg(first.alias("a"), last.alias("b")).where("a != b")
    met = windows.join(shared, "window")
    own = (F.col("c1") == F.col("a.c1")) & (F.col("c2") == F.col("a.c2"))
    other = F.when(own, F.col("b")).otherwise(F.col("a"))
    return met.select("c1", "c2", "start", (F.col("start") + least).alias("stop"), other["c1"].alias("o1"), other["c2"].alias("o2"))


def merged(matches: DataFrame) -> DataFrame:
    """(c1, c2, start, stop, o1, o2): overlapping matches of a text as one span, with the text of the match that opens it, of several the
    longest."""
    order = Window.partitionBy("c1", "c2").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("before").isNull() | (F.col("start") > F.col("before")), 1).otherwise(0)
    cut = matches.withColumn("before", before).withColumn("new", new).withColumn("span", F.sum("new").over(order))
    opening = F.min(F.struct("start", (-F.col("stop")).alias("n"), "o1", "o2"))
    return cut.groupBy("c1", "c2", "span").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), opening.alias("o")).select(
        "c1", "c2", "start", "stop", F.col("o.o1").alias("o1"), F.col("o.o2").alias("o2"))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 50) -> DataFrame:
    """One row per passage of at least ``least`` words that a document shares with another one:

    id, start_word, n_words, other_id (a document that has at least its first ``least`` words; of those it was compared with, one that
    has the most from there on). Words are runs without white space, A-Z lower-cased. Documents without such a passage have no row.

    Equal texts are one text in the suffix array; all of it is a passage of each. Of every other text the suffixes at minimiser
    positions are kept. Those whose first words occur in two texts are sorted by the words after them, compared with the
    neighbours in that order and extended right and left (with many suffixes around, also in the order of the words before); suffixes are at most ``least`` words apart inside a match, so that
    the extensions of one reach those of the next and together give the whole passage. Where a suffix has more suffixes around
    than it was compared with, all windows that it is kept for are compared by hash, whether it has a match or not. Passages that a
    document only shares with itself are not reported.

    Null, empty and short texts have no passage. Rows with the same id count as different documents (null ids too);
    repeated rows are copies of each other. An empty table gives no rows.
    """
    if least < PREFIX + RANKED:
        raise ValueError(f"passages need {PREFIX + RANKED} words")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = materialize(keys_of(texts, least), "suffix-keys")
    rows = found.where("n IS NOT NULL").select("id", "n", "c1", "c2")
    classes = materialize(rows.groupBy("c1", "c2").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.max("n").alias("n"),
                                                       F.count("*").alias("copies")), "texts")
    kept = found.where("key IS NOT NULL").select("key", "c1", "c2", "pos")
    # counted before the shuffle; the join that follows splits a frequent key
    again = kept.groupBy("key").agg((F.min("c1") != F.max("c1")).alias("_again")).where("_again").select("key")
    shared = materialize(kept.join(again, "key", "left_semi"), "shared")
    places = shared.groupBy("c1", "c2").agg(F.sort_array(F.collect_set("pos")).alias("places"))
    wanted = materialize(places.join(classes, ["c1", "c2"]).select("places", "c1", "c2", F.col("low").alias("_id")), "wanted")
    chosen = texts.join(small(wanted), texts.id.eqNullSafe(F.col("_id"))).select("text", "places", "c1", "c2")
    suffixes = materialize(suffix_rows(chosen, least).distinct(), "suffixes")

    # by rows, since a text that repeats itself stands between others as often as it has the key
    wide = suffixes.groupBy("key").count().where(F.col("count") > NEIGHBOURS + 1).select("key")
    wide = materialize(wide, "wide")
    many = suffixes.join(wide, "key", "left_semi")
    near, turned = suffixes.select(SUFFIX), many.select(SUFFIX)
    matches = materialize(all_matches(near, least, "right", "left").union(all_matches(turned, least, "left", "right")), "matches")
    windows = repeated_windows(many, least)
    ends_ = ["c1", "c2", "start", "stop", "o1", "o2"]
    spans = merged(matches.select(ends_).distinct().union(windows.select(ends_)))

    others = classes.select(F.col("c1").alias("o1"), F.col("c2").alias("o2"), F.col("low").alias("other_id"))
    once = (spans.join(classes.select("c1", "c2", "copies"), ["c1", "c2"]).where("copies = 1").join(others, ["o1", "o2"])
            .select("c1", "c2", F.col("start").cast("long").alias("start_word"), (F.col("stop") - F.col("start")).cast("long").alias("n_words"),
                    "other_id", F.lit(None).cast("long").alias("high")))
    copied = classes.where((F.col("copies") > 1) & (F.col("n") >= least)).select(
        "c1", "c2", F.lit(0).cast("long").alias("start_word"), F.col("n").alias("n_words"), F.col("low").alias("other_id"), "high")
    given = rows.where(F.col("n") >= least).join(once.union(copied), ["c1", "c2"])
    other = F.when(F.col("id").eqNullSafe(F.col("other_id")) & F.col("high").isNotNull(), F.col("high")).otherwise(F.col("other_id"))
    return given.select(F.col("id").alias(id_col), "start_word", "n_words", other.alias("other_id"))
