"""Near-duplicate vectors against all pairs."""

import numpy as np
import pytest

from articlespark.llm import neighbours
from articlespark.llm.graph import components

SCHEMA = "vec_id long, embedding array<float>, label int, node string, copies int, links int, u int"


def rows_of(seed=1):
    rnd = np.random.default_rng(seed)
    rows, n = [], 0

    def add(vector, label):
        nonlocal n
        n += 1
        rows.append((n, None if vector is None else [None if x is None else float(x) for x in vector], label, "x", 1, 2, 3))
    for label in (0, 1, None):
        for _ in range(40):
            add(rnd.standard_normal(16), label)
        centre = rnd.standard_normal(16)
        for _ in range(60):  # one dense region, more than a list holds
            add(centre + rnd.standard_normal(16) * 0.09, label)
        chain = rnd.standard_normal(16)
        for _ in range(12):
            chain = chain / np.linalg.norm(chain) + rnd.standard_normal(16) * 0.04
            add(chain, label)
    for vector in (None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]):
        add(vector, 1)
    add(rows[0][1], 0)
    add(rows[0][1], 0)
    rows.append(rows[3])  # a repeated row
    rows.append((None, rows[5][1], 0, "x", 1, 2, 3))
    return rows


def brute(rows, threshold=0.98):
    units = []
    for r in rows:
        v = np.array([np.nan if x is None else np.float32(x) for x in r[1] or []], float)
        fine = r[2] is not None and len(v) and np.isfinite(v).all() and (v != 0).any()
        units.append(v / np.linalg.norm(v) if fine else None)
    linked = [[j for j in range(len(rows)) if j != i and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
               and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold] for i in range(len(rows))]
    out = []
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        known = [rows[j][0] for j in seen if rows[j][0] is not None]
        component = min(known) if known else None
        out.append((r[0], len(linked[i]), component, r[0] == component))
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("block", [256, 7])
def test_links_and_components(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    rows = rows_of()
    assert plain(neighbours.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3))) == brute(rows)


def test_a_poor_start_is_widened(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ORDERS", 1)
    monkeypatch.setattr(neighbours, "PER_CODE", 0.01)
    seen = []
    audit = neighbours.audit
    monkeypatch.setattr(neighbours, "audit", lambda *a: seen.append(audit(*a)) or seen[-1])
    rows = rows_of(2)
    got = plain(neighbours.near_duplicates(spark.createDataFrame(rows, SCHEMA)))
    assert len(seen) > 1 or seen[0] >= neighbours.LEAST_RECALL
    want = brute(rows)
    assert sum(a == b for a, b in zip(got, want, strict=True)) >= 0.9 * len(want)


def test_a_large_label_does_not_make_the_codes_of_a_small_one_finer(spark, monkeypatch):
    seen = []
    sign_codes = neighbours.sign_codes
    monkeypatch.setattr(neighbours, "sign_codes", lambda *a: seen.append(sign_codes(*a)) or seen[-1])
    monkeypatch.setattr(neighbours, "ATTEMPTS", 1)
    rnd = np.random.default_rng(3)
    rows = [(n, rnd.standard_normal(8).tolist(), int(n < 4000), "x", 1, 2, 3) for n in range(4040)]
    neighbours.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    most = {r.label: r.most for r in seen[0].groupBy("label").agg({"code": "max"}).toDF("label", "most").collect()}
    assert most[0] < 8 and most[1] >= 256


def test_an_empty_table_gives_no_rows(spark):
    assert neighbours.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 299), (299, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {299: 299, 300: 299}
