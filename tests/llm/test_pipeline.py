"""The corpus job, stage by stage, against plain versions."""

import collections
import re

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from articlespark.llm.common import table
from articlespark.llm.queries import vocabulary
from articlespark.runtime import materialize

SPACE = re.compile(r"[\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = table(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = (docs, docs := materialize(stage(spark, docs, sf_dir), name))
    return out


def test_all_but_the_last_return_documents(stages):
    names = list(stages)
    assert names == ["quality_classifier", "exact_dedup", "near_dedup", "mix_sources", "pack"]
    assert all(after.columns == before.columns for before, after in list(stages.values())[:-1])


def test_rejected_documents_go_and_good_ones_stay(spark, sf_dir, stages):
    before, after = stages["quality_classifier"]
    labels = table(spark, sf_dir, "labels")
    kept = {r.doc_id for r in after.collect()}
    judged = [(r.doc_id in kept, r.quality) for r in before.join(labels, "doc_id").collect()]
    assert all(k for k, q in judged if q) or sum(k for k, q in judged if q) >= 0.98 * sum(q for _, q in judged)
    assert not any(k for k, q in judged if not q) or sum(not k for k, q in judged if not q) >= 0.9 * sum(not q for _, q in judged)


def test_one_document_of_each_text(stages):
    before, after = stages["exact_dedup"]
    first = {}
    for r in before.collect():
        text = SPACE.sub(" ", r.text or "")
        first[text] = min(first.get(text, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after.collect()) == sorted(first.values())


def test_one_document_of_each_group_of_near_copies(stages):
    before, after = stages["near_dedup"]
    sets = {}
    for r in before.collect():
        w = [x for x in SPACE.split(re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")) if x]
        sets[r.doc_id] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    group = {d: d for d in sets}
    holders = collections.defaultdict(set)
    for d, s in sets.items():
        for x in s:
            holders[x].add(d)

    def find(d):
        while group[d] != d:
            d = group[d]
        return d
    for d, s in sets.items():
        for e in set().union(*(holders[x] for x in s)) if s else ():
            if e < d and 100 * len(s & sets[e]) >= 80 * len(s | sets[e]):
                a, b = sorted((find(d), find(e)))
                group[b] = a
    assert sorted(r.doc_id for r in after.collect()) == sorted(d for d in sets if find(d) == d)


def test_sources_reach_their_targets(stages):
    before, after = stages["mix_sources"]
    size = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    have = {r.source: r.n for r in before.groupBy("source").agg(F.sum(size).alias("n")).collect()}
    took = {r.source: r.n for r in after.groupBy("source").agg(F.sum(size).alias("n")).collect()}
    assert sum(took.values()) == pytest.approx(1.5 * sum(have.values()), rel=0.001)
    assert all(took.get(s, 0) <= 2 * n for s, n in have.items())


def test_the_mix_is_packed_whole(stages):
    before, after = stages["pack"]
    texts = [(None, r.text) for r in before.collect()]
    tokenizer = Tokenizer.from_file(vocabulary())
    total = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in texts)
    pieces = after.collect()
    assert sum(p.length for p in pieces) == total
    fills = collections.Counter()
    for p in pieces:
        fills[p.sequence_id] += p.length
    assert sorted(fills.values())[1:] == [4096] * (len(fills) - 1)
