"""Mixture-controlled packing: deficit round-robin over source queues into sequences of fixed length."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize, small
from .common import sums_before
from .tokens import encoder, slices

# Rounds that are sorted together in one task: with 4096 tokens a round about a million tokens.
ROUNDS_PER_RUN = 256
CHUNKS = ("id long, queue string, part int, before long, start long, length long, doc_tokens long, ids binary")


def token_chunks(docs: DataFrame, id_col: str, text_col: str, source_col: str, vocabulary: str, end_id: int,
                 grain: int) -> DataFrame:
    """Every document's ids in chunks of at most ``grain``: the packets of its source's queue.

    ``queue`` names the source (also a null one), ``before`` counts the ids that came earlier in the same queue
    and input partition. The caller writes the table, which fixes the order of the queues.
    """
    def chunks(batches):
        part, code, served = TaskContext.get().partitionId(), encoder(vocabulary), {}
        for batch in batches:
            keys, queues = batch.column(0), batch.column(2).to_pylist()
            for first, texts in slices(batch.column(1)):
                ids, counts = code.encode(texts)
                rows, at = [[] for _ in range(7)], 0
                for i, count in enumerate(counts.tolist()):
                    own = np.append(ids[at:at + count], np.uint32(end_id)).astype("<u4").tobytes()
                    at += count
                    queue = queues[first + i]
                    before = served.get(queue, 0)
                    served[queue] = before + count + 1
                    for start in range(0, count + 1, grain):
                        length = min(grain, count + 1 - start)
                        for values, value in zip(rows, (first + i, queue, before + start, start, length, count + 1,
                                                        own[4 * start:4 * (start + length)]), strict=True):
                            values.append(value)
                whose, queue, before, start, length, total, own = rows
                long = pa.int64()
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(whose, long)), pa.array(queue, pa.string()), pa.array([part] * len(whose), pa.int32()),
                     pa.array(before, long), pa.array(start, long), pa.array(length, long), pa.array(total, long),
                     pa.array(own, pa.binary())], names=[c.split()[0] for c in CHUNKS.split(", ")])

    # a prefix keeps the null source apart from every name
    queue = F.when(F.col(source_col).isNull(), "").otherwise(F.concat(F.lit("="), F.col(source_col)))
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), queue.alias("queue")).mapInArrow(
        chunks, CHUNKS)


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         length: int = 4096, end_id: int = 2, grain: int = 512, weights: Mapping[str | None, float] | None = None) -> DataFrame:
    """Pieces of documents in sequences: id, source, start, length, doc_tokens, ids (unsigned 32-bit,
    little-endian), sequence_id, offset.

    Each round gives every queue a quantum of ``length`` times its target share, and a queue sends its next chunks
    as far as the quanta it has got so far cover them; the rest is its deficit, kept for later rounds. The round of a
    chunk is therefore the ids sent up to its end, divided by the quantum, rounded up, which holds
    across windows and partitions without any task seeing a whole queue. Rounds follow each other without a gap, and
    every ``length`` ids make a sequence; in each, a source is at most a round's quantum and a chunk from its
    share. Target shares are ``weights`` by source (1 where missing), by default the sources' shares of all ids,
    with which all queues end together. A queue that has ended leaves the windows to the others.

    A null text is an empty one: its end id alone. A null source is a queue of its own; null and repeated ids
    are packed like others. Sequences are full but for the last. An empty table gives no rows.
    """
    if not 0 < grain <= length:
        raise ValueError("grain must lie between 1 and length")
    chunks = materialize(token_chunks(docs, id_col, text_col, source_col, vocabulary, end_id, grain), "chunks")
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = chunks.groupBy("queue", "part").agg(F.sum("length").alias("ids"))
    parts = parts.withColumn("earlier", F.coalesce(F.sum("ids").over(earlier), F.lit(0)))
    queues = parts.groupBy("queue").agg(F.sum("ids").cast("double").alias("weight"))
    if weights is not None:
        named = F.create_map(*[F.lit(v) for k, w in weights.items() for v in ("" if k is None else f"={k}", float(w))]
                             or [F.lit(""), F.lit(1.0)])
        queues = queues.withColumn("weight", F.coalesce(F.try_element_at(named, F.col("queue")), F.lit(1.0)))
    queues = queues.select("queue", (F.col("weight") / F.sum("weight").over(Window.partitionBy()) * length).alias("quantum"),
                           F.row_number().over(Window.orderBy("queue")).alias("rank"))
    places = small(materialize(parts.join(queues, "queue").select("queue", "part", "earlier", "quantum", "rank"), "queues"))

    served = F.col("earlier") + F.col("before") + F.col("length")
    placed = chunks.join(places, ["queue", "part"]).withColumn("served", served).withColumn(
        "round", F.ceil(F.col("served") / F.col("quantum")))
    placed = placed.withColumn("run", F.floor((F.col("round") - 1) / ROUNDS_PER_RUN))
    stream = sums_before(placed, [], "run", ["round", "rank", "served"], "length", "at", many=True)

    cut = stream.withColumn("sequence_id", F.explode(F.sequence(
        F.floor(F.col("at") / length), F.floor((F.col("at") + F.col("length") - 1) / length))))
    begin = F.greatest(F.col("at"), F.col("sequence_id") * length)
    end = F.least(F.col("at") + F.col("length"), (F.col("sequence_id") + 1) * length)
    skipped = begin - F.col("at")
    source = F.when(F.col("queue") != "", F.substring("queue", 2, 2**31 - 1))
    return cut.select(F.col("id").alias(id_col), source.alias(source_col), (F.col("start") + skipped).alias("start"),
                      (end - begin).alias("length"), "doc_tokens",
                      F.col("ids").substr((skipped * 4 + 1).cast("int"), ((end - begin) * 4).cast("int")).alias("ids"),
                      F.col("sequence_id").cast("long").alias("sequence_id"),
                      (begin - F.col("sequence_id") * length).alias("offset"))


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids) with the ids of its pieces joined; a sequence has a bounded length."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"])).alias("ids"))
