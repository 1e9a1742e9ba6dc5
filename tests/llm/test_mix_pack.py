"""Mixing and packing against plain versions."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import SCHEMA, odd_rows, plain, prose, table
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from articlespark.llm import mixing, packing
from articlespark.llm.common import word_count
from articlespark.llm.queries import vocabulary
from articlespark.llm.tokens import Encoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def share_out(sizes, weights, budget, repeats):
    """Share by weight, cap, reshare the excess until nothing is above its cap."""
    left, open_ = budget * sum(sizes), set(range(len(sizes)))
    out = [0.0] * len(sizes)
    while open_:
        level = left / sum(weights[i] for i in open_)
        above = {i for i in open_ if weights[i] * level >= repeats * sizes[i]}
        if not above:
            for i in open_:
                out[i] = weights[i] * level
            break
        for i in above:
            out[i] = float(repeats * sizes[i])
            left -= out[i]
        open_ -= above
    return out


def test_mix_takes_its_targets_from_a_fixed_order(spark):
    rows = odd_rows()
    size = lambda t: len(WORD.findall(t or ""))
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s))
    sizes = [sum(size(r[1]) for r in rows if r[3] == s) for s in sources]
    targets = dict(zip(sources, share_out(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))], 1.5, 2), strict=True))
    mixed = mixing.mix(table(spark), word_count(F.col("text")), F.col("doc_id"), weights=(3, 1, 2), budget=1.5, max_repeats=2)
    got = mixed.select("row.doc_id", "row.source", "size", "epoch", "taken", "target", "finish", "position").collect()
    assert sum(r.epoch == 0 for r in got) == len(rows)
    taken = collections.Counter()
    for r in got:
        taken[r.source, r.doc_id, r.size] += r.taken
        assert r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= r.size and (r.finish is None) == (r.taken == 0)
    assert taken == served(rows, targets, sources, int(1.5 * sum(sizes)))
    stream = sorted((r for r in got if r.taken), key=lambda r: r.position)
    assert [r.finish for r in stream] == sorted(r.finish for r in stream)
    assert [r.position for r in stream] == [0, *np.cumsum([r.taken for r in stream])[:-1].tolist()]
    longest = max(size(r[1]) for r in rows)
    for s, total in zip(sources, sizes, strict=True):
        assert abs(sum(n for (source, _, _), n in taken.items() if source == s) - targets[s]) <= longest + 1


def served(rows, targets, sources, budget):
    """Words taken per row: all repeats in the order of their finish times, until the budget is spent."""
    size = lambda t: len(WORD.findall(t or ""))
    queue = []
    for rank, s in enumerate(sources):
        order = sorted(((hashlib.md5(f"mix{'' if r[0] is None else r[0]}".encode()).hexdigest(), size(r[1]), r[0])
                        for r in rows if r[3] == s), key=lambda x: x[:2])
        total = sum(n for _, n, _ in order)
        for epoch in range(2):
            at = epoch * total
            for digest, n, doc in order:
                at += n
                if n:
                    queue.append((at / targets[s], rank, epoch, digest, n, doc, s))
    out, left = collections.Counter({(r[3], r[0], size(r[1])): 0 for r in rows}), budget
    for *_, n, doc, s in sorted(queue, key=lambda x: x[:5]):
        out[s, doc, n] += min(n, left)
        left -= min(n, left)
    return out


def test_the_budget_cuts_inside_a_document(spark):
    rows = [(i, " ".join(["w"] * 100), "en", "ab"[i % 2], 1) for i in range(8)]
    mixed = mixing.mix(table(spark, rows), word_count(F.col("text")), F.col("doc_id"), weights=(1, 1), budget=0.41).collect()
    # 328 words of 800: the fourth document in the order of finish times is under way when they are spent
    assert sorted(r.taken for r in mixed if r.taken) == [28, 100, 100, 100]
    assert [r.position for r in mixed if r.taken == 28] == [300]


def test_documents_are_mixed_by_number(spark):
    docs = table(spark)
    options = {"weights": (3, 1, 2), "budget": 1.5, "max_repeats": 2}
    whole = mixing.mixed_documents(mixing.mix(docs, word_count(F.col("text")), F.col("doc_id"), **options))
    got = mixing.mix_documents(docs, word_count(F.col("text")), F.col("doc_id"), **options)
    assert got.columns == whole.columns and plain(got) == plain(whole)


def test_mixed_documents_repeat_and_cut(spark):
    docs = table(spark)
    mixed = mixing.mix(docs, word_count(F.col("text")), F.col("doc_id"), weights=(3, 1, 2), budget=1.5, max_repeats=2)
    out = mixing.mixed_documents(mixed)
    assert out.columns == docs.columns
    assert (out.select(F.sum(word_count(F.col("text")))).first()[0] == mixed.agg(F.sum("taken")).first()[0])
    texts = {r[1] for r in odd_rows()}
    assert all(r.text in texts or any(t and t.startswith(r.text) for t in texts) for r in out.select("text").collect())


def test_nothing_to_mix(spark):
    assert mixing.mix(table(spark, [], SCHEMA), word_count(F.col("text")), F.col("doc_id")).collect() == []
    blank = mixing.mix(table(spark, [(1, None, None, None, None), (2, " ", None, "a", 1)]), word_count(F.col("text")), F.col("doc_id"))
    assert [r.taken for r in blank.collect()] == [0, 0]


def check_pieces(pieces, rows, tokenizer, length=4096):
    ids = collections.defaultdict(list)
    for r in rows:
        ids[r[0]].append(np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4"))
    documents, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        documents[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
        assert len(p.ids) == 4 * p.length
    for doc, own in ids.items():
        if len(own) == 1:
            joined = b"".join(bytes(p.ids) for p in sorted(documents[doc], key=lambda p: p.start))
            assert joined == own[0].tobytes() and {p.doc_tokens for p in documents[doc]} == {len(own[0])}
        assert sum(p.length for p in documents[doc]) == sum(map(len, own))
    fills = []
    for s in sorted(sequences):
        at = 0
        for p in sorted(sequences[s], key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        fills.append(at)
    assert all(f == length for f in fills[:-1]) and 0 < fills[-1] <= length
    return sequences


@pytest.mark.parametrize(("length", "grain"), [(4096, 512), (64, 64), (100, 7)])
def test_pack_round_trip(spark, length, grain):
    tokenizer = Tokenizer.from_file(vocabulary())
    rows = odd_rows()
    pieces = packing.pack(table(spark), vocabulary(), length=length, grain=grain)
    check_pieces(pieces.collect(), rows, tokenizer, length)
    whole = packing.sequences(pieces).collect()
    assert sum(len(r.ids) for r in whole) == 4 * sum(len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows)


def test_windows_hold_the_target_proportions(spark):
    import random
    rnd = random.Random(4)
    rows = [(i, prose(rnd, rnd.randint(5, 400)), "en", "abc"[min(2, i % 6 // 2 + i % 2)], 1) for i in range(300)]
    sequences = check_pieces(packing.pack(table(spark, rows, clashing=False), vocabulary(), length=1024, grain=64).collect(), rows,
                             Tokenizer.from_file(vocabulary()), 1024)
    total = collections.Counter()
    for pieces in sequences.values():
        for p in pieces:
            total[p.source] += p.length
    everything = sum(total.values())
    for s, pieces in list(sequences.items())[:-1]:
        for source, n in total.items():
            own = sum(p.length for p in pieces if p.source == source)
            assert abs(own - 1024 * n / everything) <= 2 * 64 * len(total)


def test_given_weights_hold_until_a_source_ends(spark):
    rows = [(i, "word " * 63, "en", "ab"[i % 2], 1) for i in range(200)]
    pieces = packing.pack(table(spark, rows, clashing=False), vocabulary(), length=512, grain=64, weights={"a": 3, "b": 1}).collect()
    first = collections.Counter()
    for p in pieces:
        if p.sequence_id < 16:
            first[p.source] += p.length
    assert first["a"] / first["b"] == pytest.approx(3, rel=0.1)


def test_nothing_to_pack(spark):
    assert packing.pack(table(spark, [], SCHEMA), vocabulary()).collect() == []
    with pytest.raises(ValueError, match="grain"):
        packing.pack(table(spark, [], SCHEMA), vocabulary(), grain=0)


ENCODER = Encoder(vocabulary())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'.,aAbßéÉ1½!<|>")), max_size=40))
def test_words_looked_up_alone_give_the_tokenizers_ids(text):
    ids, counts = ENCODER.encode(pa.array([text, "", text + " <|endoftext|>"], pa.large_string()))
    want = [ENCODER.tokenizer.encode(t, add_special_tokens=False).ids for t in (text, "", text + " <|endoftext|>")]
    assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]


def test_the_byte_vocabulary_is_encoded_whole():
    import public_tokenizers
    encoder = Encoder(str(public_tokenizers.path("byte_bpe_50k.json")))
    assert not encoder.by_word
    ids, counts = encoder.encode(pa.array(["a  b", "", "c"], pa.large_string()))
    assert ids.tolist() == encoder.tokenizer.encode("a  b").ids + encoder.tokenizer.encode("c").ids and counts[1] == 0


def test_checksum_column(spark):
    ids = np.array([1, 70000, 2], "<u4").tobytes()
    df = spark.createDataFrame([(bytearray(ids),)], "ids binary")
    assert df.select(F.crc32("ids")).first()[0] == zlib.crc32(ids)
