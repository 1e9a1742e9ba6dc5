"""Ranked lexical search by a dual tree over items and documents."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize
from .tokens import slices
from .words import _BYTE, mixed, raw_bytes

# fixed value: what a term is made of (of the signs below U+0080, digits and letters)
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_INSIDE = np.array([TERM.match(bytes([b])) is not None for b in range(256)])
_BASE = 0x9E3779B97F4A7C15
#: Bytes that are cut into terms at once; a longer text is cut between terms.
PIECE_BYTES = 2 << 20
#: Distinct terms that the items searched for together may have; a single item may have more. Bounds what is broadcast and
#: the width of the trees.
BLOCK_TERMS = 1 << 14
DOC_LEAF, DOC_FAN, ITEM_LEAF, ITEM_FAN = 64, 8, 8, 4
#: Stands for a null id, and sorts after all others.
NO_ID = np.iinfo(np.int64).max


def terms(text: bytes) -> list[bytes]:
    """The terms of a short text, A-Z lower-cased."""
    return [t.lower() for t in TERM.findall(text)]


class _Powers:
    """Powers of the base and their inverses, as far as a piece has needed them."""
    up = down = np.empty(0, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, np.uint64(b))]))
                                for b in (_BASE, pow(_BASE, -1, 1 << 64)))
        return cls.up[:n], cls.down[:n]


def hash_terms(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each term raw[start:end] with A-Z lower-cased."""
    up, down = _Powers.of(len(raw))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * up)])
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def pieces(raw: np.ndarray, bounds: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, raw, starts, ends) of all terms, a piece of the bytes at a time; ``text`` numbers each term's text."""
    first = 0
    while first < len(raw):
        last = min(first + size, len(raw))
        while last < len(raw) and _INSIDE[raw[last - 1]] and _INSIDE[raw[last]] and last not in bounds:
            step = raw[last:last + size]
            stop = np.flatnonzero(~_INSIDE[step])
            nearest = bounds[np.searchsorted(bounds, last, side="right")]
            last = int(min(last + (stop[0] if len(stop) else len(step)), nearest))
        part = raw[first:last]
        inside = _INSIDE[part]
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        cuts = bounds[(bounds > first) & (bounds < last)] - first
        begins[cuts] = inside[cuts]
        stops[cuts - 1] = inside[cuts - 1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        yield np.searchsorted(bounds, starts + first, side="right") - 1, part, starts, ends
        first = last


class Items(NamedTuple):
    """A block of items: their ids, the vocabulary they share, and how often each has each term, as rows over it."""
    ids: list
    vocabulary: list[bytes]
    counts: list[dict[int, int]]


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_terms: int = BLOCK_TERMS) -> Iterator[Items]:
    """Items with terms, in blocks of at most ``block_terms`` distinct terms, or one item."""
    ids, vocabulary, counts = [], {}, []
    for row in items.select(id_col, text_col).toLocalIterator():
        found = Counter(terms((row[1] or "").encode()))
        if not found:
            continue
        if ids and len(vocabulary.keys() | found.keys()) > block_terms:
            yield Items(ids, list(vocabulary), counts)
            ids, vocabulary, counts = [], {}, []
        ids.append(row[0])
        counts.append({vocabulary.setdefault(t, len(vocabulary)): n for t, n in found.items()})
    if ids:
        yield Items(ids, list(vocabulary), counts)


def occurrences(docs: DataFrame, vocabulary: Sequence[bytes], id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tfs) per document: its number of terms, and its terms of the vocabulary with their counts. Whole texts are
    read where they lie; terms are compared by a 64-bit hash and their length."""
    raw = np.frombuffer(b"".join(vocabulary), np.uint8)
    sizes = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary))
    ends = np.cumsum(sizes)
    hashes = hash_terms(raw, ends - sizes, ends)
    order = np.argsort(hashes)
    known = docs.sparkSession.sparkContext.broadcast((hashes[order], order, sizes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorted_hashes, numbers, lengths = known.value
        width = len(numbers)
        for batch in batches:
            for first, texts in slices(batch.column(1), PIECE_BYTES):
                raw, bounds = raw_bytes(texts)
                n = np.zeros(len(texts), np.int64)
                keys, tfs = [], []
                for text, part, starts, ends in pieces(raw, bounds):
                    n += np.bincount(text, minlength=len(texts))
                    found = hash_terms(part, starts, ends)
                    spot = np.minimum(np.searchsorted(sorted_hashes, found), width - 1)
                    term = numbers[spot]
                    hit = (sorted_hashes[spot] == found) & (lengths[term] == ends - starts)
                    key, tf = np.unique(text[hit] * width + term[hit], return_counts=True)
                    keys.append(key)
                    tfs.append(tf)
                key, back = np.unique(np.concatenate(keys or [np.empty(0, np.int64)]), return_inverse=True)
                tf = np.zeros(len(key), np.int64)
                np.add.at(tf, back, np.concatenate(tfs or [np.empty(0, np.int64)]))
                offsets = np.searchsorted(key, np.arange(len(texts) + 1) * width).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(n),
                     pa.ListArray.from_arrays(offsets, pa.array((key % width).astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(tf))],
                    ["id", "n", "terms", "tfs"])

    return docs.select(F.col(id_col).cast("long").alias("id"), text_col).mapInArrow(count, "id long, n long, terms array<int>, tfs array<long>")


class Corpus(NamedTuple):
    """What a score needs to know of all documents: those with a term, all terms, and each term's weight."""
    docs: int
    length: int
    weights: np.ndarray


def corpus(found: DataFrame, size: int) -> Corpus:
    """Counted over all documents; only the counts of the block's own terms come to the driver."""
    docs, length = found.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(size, np.int64)
    for term, n in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[term] = n
    weights = [math.floor(1000 * math.log((2 * docs + 2) / (2 * int(d) + 1))) for d in df]
    return Corpus(docs, length, np.array(weights, np.int64))


class Tree(NamedTuple):
    """Rows in an order, and levels of nodes over them from the root down: per node its first and last row (exclusive) and the maxima
    of its coordinates. A node's children are the nodes of the next level within its rows."""
    order: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def tree(rows: np.ndarray | None, order: np.ndarray, leaf: int, fan: int, maxima=None) -> Tree:
    """Maxima hierarchy over sorted rows. ``maxima(first, last)`` gives the maxima of a run of rows where they are not a matrix."""
    take = maxima or (lambda first, last: rows[order[first:last]].max(axis=0))
    first = np.arange(0, len(order), leaf)
    last = np.minimum(first + leaf, len(order))
    levels = [(first, last, np.stack([take(a, b) for a, b in zip(first, last)]))]
    while len(levels[0][0]) > 1:
        a, b, high = levels[0]
        groups = np.arange(0, len(a), fan)
        levels.insert(0, (a[groups], b[np.minimum(groups + fan, len(a)) - 1], np.maximum.reduceat(high, groups, axis=0)))
    return Tree(order, levels)


def item_tree(items: Items, weights: np.ndarray) -> tuple[Tree, np.ndarray]:
    """The tree over items, sorted by the terms that weigh most in them, and the matrix of their counts."""
    counts = np.zeros((len(items.ids), len(items.vocabulary)), np.int64)
    for row, found in enumerate(items.counts):
        counts[row, list(found)] = list(found.values())
    heavy = np.argsort(-(counts * weights), axis=1, kind="stable")[:, :2]
    order = np.lexsort((heavy[:, -1], heavy[:, 0]))
    return tree(counts, order, ITEM_LEAF, ITEM_FAN), counts


class Search:
    """The best ``k`` documents of each item so far, over batches of documents."""

    def __init__(self, items: Tree, counts: np.ndarray, corpus: Corpus, k: int, least: np.ndarray):
        self.items, self.counts, self.corpus, self.k = items, counts, corpus, k
        #: a score that the item's k-th document is known to reach, if not yet which document
        self.least = least.copy()
        self.scores = np.zeros((len(counts), k), np.int64)
        self.ids = np.full((len(counts), k), NO_ID)

    def values(self, n: np.ndarray, owner: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Weight times impact for each entry."""
        sizes, spot = np.unique(n, return_inverse=True)
        m = np.array([25 + 75 * int(x) * self.corpus.docs // max(self.corpus.length, 1) for x in sizes], np.int64)[spot]
        return self.corpus.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[owner]))

    def add(self, ids: np.ndarray, n: np.ndarray, offsets: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        """Search a batch: rows of (id, n) with the entries offsets[row] to offsets[row + 1]."""
        sizes = np.diff(offsets)
        if not len(term):
            return
        owner = np.repeat(np.arange(len(ids)), sizes)
        value = self.values(n, owner, term, tf)
        columns, column = np.unique(term, return_inverse=True)
        lead = np.zeros((len(ids), 2), np.int64)
        best = np.lexsort((-value, owner))
        for place in range(2):
            has = sizes > place
            lead[has, place] = 1 + column[best[(offsets[:-1] - offsets[0])[has] + place]]
        rows = np.flatnonzero(sizes)
        order = rows[np.lexsort((ids[rows], lead[rows, 1], lead[rows, 0]))]
        # sums of whole numbers are exact in a double below 2 ** 53, and products of doubles are the fast ones
        most = int(self.counts.sum(axis=1).max()) * int(value.max())
        kind = np.float64 if most < 1 << 53 else np.int64

        def dense(first: int, last: int) -> np.ndarray:
            out = np.zeros((last - first, len(columns)), kind)
            for spot, row in enumerate(order[first:last]):
                a, b = offsets[row] - offsets[0], offsets[row + 1] - offsets[0]
                out[spot, column[a:b]] = value[a:b]
            return out

        docs = tree(None, order, DOC_LEAF, DOC_FAN, lambda first, last: dense(first, last).max(axis=0))
        lowest = [np.array([ids[order[a:b]].min() for a, b in zip(first, last)]) for first, last, _ in docs.levels]
        high = [m[:, columns].astype(kind) for _, _, m in self.items.levels]
        self._visit(docs, high, lowest, dense, ids, columns, kind)

    def _open(self, level: int, node: int, bound: int, lowest: int) -> bool:
        """Whether documents scoring ``bound`` at most and numbered ``lowest`` at least may matter to an item below the node."""
        first, last, _ = self.items.levels[level]
        rows = self.items.order[first[node]:last[node]]
        kth, kth_id = self.scores[rows, -1], self.ids[rows, -1]
        weakest = np.maximum(kth, self.least[rows])
        ahead = (bound > weakest) | ((bound == weakest) & ((weakest > kth) | (lowest < kth_id)))
        return bound > 0 and bool(ahead.any())

    def _visit(self, docs: Tree, high: list, lowest: list, dense, ids: np.ndarray, columns: np.ndarray, kind) -> None:
        """Descend both trees in step, the most promising documents first; a pair whose bound beats no item's k-th score is left."""
        leaves = {}
        stack = [(0, 0, 0, 0, int(high[0][0] @ docs.levels[0][2][0]))]
        while stack:
            i_level, i, d_level, d, bound = stack.pop()
            if not self._open(i_level, i, bound, lowest[d_level][d]):
                continue
            i_next, d_next = min(i_level + 1, len(high) - 1), min(d_level + 1, len(docs.levels) - 1)
            if (i_next, d_next) == (i_level, d_level):
                if d not in leaves:
                    first, last = docs.levels[-1][0][d], docs.levels[-1][1][d]
                    leaves[d] = (dense(first, last), ids[docs.order[first:last]])
                self._score(i, *leaves[d], columns, kind)
                continue
            i_kids = self._children(self.items.levels, i_level, i, i_next)
            d_kids = self._children(docs.levels, d_level, d, d_next)
            bounds = high[i_next][i_kids] @ docs.levels[d_next][2][d_kids].T
            for a, b in np.dstack(np.unravel_index(np.argsort(bounds, axis=None, kind="stable"), bounds.shape))[0]:
                stack.append((i_next, int(i_kids[a]), d_next, int(d_kids[b]), int(bounds[a, b])))

    @staticmethod
    def _children(levels: list, level: int, node: int, below: int) -> np.ndarray:
        if below == level:
            return np.array([node])
        first, last = levels[level][0][node], levels[level][1][node]
        return np.arange(*np.searchsorted(levels[below][0], [first, last]))

    def _score(self, leaf: int, vectors: np.ndarray, ids: np.ndarray, columns: np.ndarray, kind) -> None:
        """Exact scores of an item leaf against a document leaf."""
        first, last, _ = self.items.levels[-1]
        rows = self.items.order[first[leaf]:last[leaf]]
        for row, scores in zip(rows, (self.counts[np.ix_(rows, columns)].astype(kind) @ vectors.T).astype(np.int64)):
            good = scores > 0
            scores, found = np.concatenate([self.scores[row], scores[good]]), np.concatenate([self.ids[row], ids[good]])
            best = np.lexsort((found, -scores))[:self.k]
            self.scores[row], self.ids[row] = scores[best], found[best]


def _search(found: DataFrame, items: Items, all_docs: Corpus, k: int, least: np.ndarray) -> DataFrame:
    """(item, id, score): each task's best documents per item."""
    hierarchy, counts = item_tree(items, all_docs.weights)
    known = found.sparkSession.sparkContext.broadcast((hierarchy, counts, all_docs, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Search(*known.value[:3], k, known.value[3])
        for batch in batches:
            ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            entries, tfs = batch.column(2), batch.column(3)
            state.add(ids, batch.column(1).to_numpy(zero_copy_only=False), entries.offsets.to_numpy().astype(np.int64),
                      entries.flatten().to_numpy(zero_copy_only=False), tfs.flatten().to_numpy(zero_copy_only=False))
        item, place = np.nonzero(state.scores)
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(state.ids[item, place]), pa.array(state.scores[item, place])],
                                         ["item", "id", "score"])

    return found.mapInArrow(run, "item long, id long, score long")


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents with a score above 0, equal scores by document id.

    Documents are read once per block of items, into their counts of the block's terms. Each task then holds batches of them as a tree whose
    nodes carry the maxima of their coordinates, next to the same kind of tree over the items. The product of two nodes'
    maxima bounds every score below them; a pair is left when that is under the weakest k-th score of its items, so no document
    that belongs to an answer is passed over. Scores known from the first file of counts start every task's bounds. The answers
    of the tasks, at most ``k`` an item each, are merged.

    Null and empty texts have no terms and are never found; a null document id ranks after all others; repeated rows are ranked each
    for itself. Items without terms have no rows; each row of ``items`` is searched for by itself, also one that
    repeats an id. Empty tables give no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    out = None
    for block in item_blocks(items, item_id, item_text, block_terms):
        found = materialize(occurrences(docs, block.vocabulary, id_col, text_col), "occurrences")
        all_docs = corpus(found, len(block.vocabulary))
        some = found.where(F.size("terms") > 0)
        least = np.zeros(len(block.ids), np.int64)
        if files := sorted(found.inputFiles())[:1]:
            first = _search(spark.read.schema(found.schema).parquet(*files), block, all_docs, k, least)
            for item, score in _best(first, k).where(F.col("rank") == k).select("item", "score").collect():
                least[item] = score
        best = _best(_search(some, block, all_docs, k, least), k)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"item long, {item_id} {items.schema[item_id].dataType.simpleString()}")
        ranked = best.join(F.broadcast(names), "item").select(
            item_id, F.col("rank").cast("int").alias("rank"), F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col), "score")
        ranked = materialize(ranked, "ranked")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        out = spark.createDataFrame([], f"{item_id} {items.schema[item_id].dataType.simpleString()}, rank int, {id_col} long, score long")
    return out
