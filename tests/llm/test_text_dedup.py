"""Exact dedup, Jaccard join and repeated passages against brute force."""

import collections
import hashlib
import re

import pytest
from cases import SCHEMA, odd_rows, plain, prose, table

from articlespark.llm import exact, jaccard, suffixes

SPACE = re.compile(r"[\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in SPACE.split((text or "").translate(LOWER)) if w]


def smallest(ids):
    known = [i for i in ids if i is not None]
    return min(known) if known else None


def test_exact_groups(spark):
    rows = odd_rows()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[SPACE.sub(" ", r[1] or "")].append(r[0])
    got = exact.exact_groups(table(spark)).collect()
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_sha[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == smallest(ids)
        assert not r.kept or r.doc_id == r.keep_id
    assert collections.Counter(r.text_sha256 for r in got if r.kept) == collections.Counter(dict.fromkeys(by_sha, 1))


def test_dropping_copies_keeps_one_row_of_each_text_with_its_columns(spark):
    docs = table(spark)
    got = exact.drop_copies(docs)
    assert got.columns == docs.columns
    groups = collections.defaultdict(list)
    for r in odd_rows():
        groups[SPACE.sub(" ", r[1] or "")].append(r[0])
    kept = collections.Counter((SPACE.sub(" ", r.text or ""), r.doc_id) for r in got.collect())
    assert kept == collections.Counter((t, smallest(ids)) for t, ids in groups.items())


def components(sets, linked):
    parent = list(range(len(sets)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and linked(len(sets[i] & sets[j]), len(sets[i] | sets[j])):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def near_rows(seed=11):
    """Chains of variants around some texts, so that links are not transitive and pivots do not settle everything."""
    import random
    rnd = random.Random(seed)
    rows, n = [], 1000
    shared = prose(rnd, 25).split()
    for _ in range(6):
        text = (shared + prose(rnd, rnd.randint(20, 120)).split())
        for _ in range(14):
            rows.append((n, " ".join(text), "en", "a", 1))
            n += 1
            text = list(text)
            for _ in range(rnd.randint(0, 3)):
                text[rnd.randrange(len(text))] = prose(rnd, 1)
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_jaccard_join(spark, size, percent):
    rows = odd_rows() + near_rows()
    sets = []
    for r in rows:
        w = words(r[1])
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    found = components(sets, lambda i, u: 100 * i >= percent * u)
    members = collections.defaultdict(list)
    for r, c in zip(rows, found, strict=True):
        members[c].append(r[0])
    want = sorted(((r[0], len(s), smallest(members[c]) if s else r[0]) for r, s, c in zip(rows, sets, found, strict=True)),
                  key=lambda r: tuple((x is None, x) for x in r))
    assert plain(jaccard.link_documents(table(spark, rows), words=size, percent=percent)) == want
    assert len({w[2] for w in want}) < len(rows) - 40


def test_small_blocks_give_the_same_links(spark, monkeypatch):
    docs = table(spark, near_rows(5), clashing=False)
    want = plain(jaccard.link_documents(docs, words=3, percent=90))
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    assert plain(jaccard.link_documents(docs, words=3, percent=90)) == want


def test_lists_in_blocks_give_the_same_links_as_whole_ones(spark, monkeypatch):
    docs = table(spark, near_rows(7), clashing=False)
    want = plain(jaccard.link_documents(docs, words=3, percent=80))
    monkeypatch.setattr(jaccard, "SHORT", 1)
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    assert plain(jaccard.link_documents(docs, words=3, percent=80)) == want


def test_sets_whose_counts_rule_out_a_link_are_not_read(spark, monkeypatch):
    import random
    rnd = random.Random(3)
    some = [f"w{i}" for i in range(8)]
    rows = [(i, " ".join(rnd.choices(some, k=60)), "en", "a", 1) for i in range(40)]
    fetched, fetch, rows_ = [], jaccard.fetch_sets, table(spark, rows, clashing=False)

    def count(docs, wanted, words):
        fetched.append(wanted.count())
        return fetch(docs, wanted, words)

    monkeypatch.setattr(jaccard, "fetch_sets", count)
    assert len({r[2] for r in plain(jaccard.link_documents(rows_, words=3, percent=90))}) == 40
    assert sum(fetched) == 0


def test_near_copies_go_and_other_columns_stay(spark):
    docs = table(spark, near_rows())
    got = jaccard.drop_near_copies(docs)
    linked = jaccard.link_documents(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted({r.component_id for r in linked.collect()})


def spans(rows, least):
    owners, texts = collections.defaultdict(set), [words(r[1]) for r in rows]
    for i, w in enumerate(texts):
        for k in range(len(w) - least + 1):
            owners[tuple(w[k:k + least])].add(i)
    out = collections.Counter()
    for i, w in enumerate(texts):
        found = []
        for k in range(len(w) - least + 1):
            if len(owners[tuple(w[k:k + least])]) > 1:
                if found and k <= found[-1][1]:
                    found[-1][1] = k + least
                else:
                    found.append([k, k + least])
        out.update((rows[i][0], a, b - a) for a, b in found)
    return out


def passage_rows(seed=2):
    import random
    rnd = random.Random(seed)
    passages = [prose(rnd, n) for n in (49, 50, 51, 75, 140)]
    rows = []
    for n in range(60):
        parts = [prose(rnd, rnd.randint(0, 40)), rnd.choice(passages), prose(rnd, rnd.randint(0, 40))]
        if n % 5 == 0:
            parts += [rnd.choice(passages), prose(rnd, 3)]
        if n % 7 == 0:
            words_ = parts[1].split()
            parts[1] = " ".join(words_[rnd.randint(0, 20):])
        rows.append((2000 + n, " ".join(parts), "en", "a", 1))
    self_repeating = prose(rnd, 12)
    return [*rows, (3000, " ".join([self_repeating] * 20), "en", "a", 1)]


@pytest.mark.parametrize("least", [50, 30])
def test_repeated_passages(spark, least):
    rows = odd_rows() + passage_rows()
    got = suffixes.repeated_passages(table(spark, rows), least=least).collect()
    assert collections.Counter((r.doc_id, r.start_word, r.n_words) for r in got) == spans(rows, least)
    by_id = collections.defaultdict(list)
    for r in rows:
        by_id[r[0]].append(" ".join(words(r[1])))
    for r in got:
        if r.doc_id is not None and len(by_id[r.doc_id]) == 1:
            window = " ".join(by_id[r.doc_id][0].split()[r.start_word:][:least])
            assert r.other_id is None or any(f" {window} " in f" {t} " for t in by_id[r.other_id])


def test_many_texts_with_one_passage_cross_ranges_and_neighbour_limits(spark):
    import random
    rnd = random.Random(9)
    parts = [prose(rnd, 40) for _ in range(4)]
    rows = [(n, " ".join([prose(rnd, rnd.randint(0, 5)), *rnd.sample(parts, 2), prose(rnd, 2)]), "en", "a", 1) for n in range(150)]
    got = suffixes.repeated_passages(table(spark, rows, clashing=False)).collect()
    assert collections.Counter((r.doc_id, r.start_word, r.n_words) for r in got) == spans(rows, 50)


def test_a_text_that_repeats_a_prefix_does_not_part_two_others(spark):
    import random
    rnd = random.Random(4)
    rows = []
    for n in range(12):
        passage = prose(rnd, 50)
        end = passage.split(" ", 1)[1]
        rows += [(10 * n + k, f"{prose(rnd, 9)} {passage} {prose(rnd, 40)}", "en", "a", 1) for k in (0, 1)]
        rows.append((10 * n + 2, " ".join(f"{prose(rnd, 9)} {end} {prose(rnd, 9)}" for _ in range(100)), "en", "a", 1))
    got = suffixes.repeated_passages(table(spark, rows, clashing=False)).collect()
    assert collections.Counter((r.doc_id, r.start_word, r.n_words) for r in got) == spans(rows, 50)


def test_a_key_that_fills_whole_ranges(spark):
    import random
    rnd = random.Random(8)
    notice = prose(rnd, 45)
    rows = [(n, " ".join([prose(rnd, 12), notice, prose(rnd, 3) if n % 2 else "the same end of it here", prose(rnd, 12)]), "en", "a", 1) for n in range(60)]
    rows += [(100, " ".join(f"{notice} {prose(rnd, 4)}" for _ in range(300)), "en", "a", 1)]
    got = suffixes.repeated_passages(table(spark, rows, clashing=False)).collect()
    assert collections.Counter((r.doc_id, r.start_word, r.n_words) for r in got) == spans(rows, 50)


def test_a_match_elsewhere_does_not_hide_a_distant_one(spark):
    """Texts around a notice that all have some match under its suffix, in which two share another window far apart in both orders."""
    import random
    rnd = random.Random(6)
    rows, n = [], 0

    def add(*parts):
        nonlocal n
        n += 1
        rows.append((n, " ".join([prose(rnd, 12), *parts, prose(rnd, 12)]), "en", "a", 1))
    for _ in range(8):
        notice, before, after = prose(rnd, 40), prose(rnd, 5), prose(rnd, 5)
        for _ in range(15):
            own = prose(rnd, 5)
            for _ in range(2):
                add(own, notice, after)
                add(before, notice, own)
        for _ in range(2):
            own = prose(rnd, 10)
            add(notice, own)
            add(before, notice, after, prose(rnd, 12), notice, own)
    got = suffixes.repeated_passages(table(spark, rows, clashing=False)).collect()
    assert collections.Counter((r.doc_id, r.start_word, r.n_words) for r in got) == spans(rows, 50)


@pytest.mark.parametrize("job", [exact.exact_groups, exact.drop_copies, jaccard.link_documents, jaccard.drop_near_copies,
                                 suffixes.repeated_passages])
def test_an_empty_table_gives_no_rows(spark, job):
    assert job(table(spark, [], SCHEMA)).collect() == []
