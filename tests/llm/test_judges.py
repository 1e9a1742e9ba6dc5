"""Quality classifier, URL filter, license scan and perspective rotation."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from cases import SCHEMA, odd_rows, prose, table
from pyspark.sql import functions as F

from articlespark.llm import chat, licenses, quality, urls
from articlespark.llm.words import hash_words, mixed


def labelled(n=400, seed=8):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rnd.random() < 0.7
        text = prose(rnd, rnd.randint(8, 120)).capitalize() + "."
        if not good:
            text = rnd.choice([lambda t: t.upper().replace(" ", "!! "), lambda t: t.replace(" ", "### "), lambda t: t.replace(" ", " | "),
                               lambda t: " ".join(w for w in t.split()[:5] for _ in range(20))])(text)
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_documents_are_judged_right(spark):
    rows, labels = labelled()
    known = spark.createDataFrame([x for x in labels if x[0] % 4], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.kept for r in quality.classify(table(spark, rows), known).collect()}
    held = [x for x in labels if x[0] % 4 == 0]
    assert sum(got[i] == bool(q) for i, q, _ in held) >= 0.95 * len(held)


def test_given_labels_on_the_given_tables(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    got = quality.classify(docs, labels.where(half)).join(labels.where(~half), "doc_id")
    assert got.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("double"))).first()[0] >= 0.9


def test_a_sparse_site_is_drawn_to_the_share_of_all(spark):
    rows, labels = labelled()
    rows += [(9000 + i, "# | ! " * 9, "en", "bad", 1) for i in range(200)] + [(9500, "# | ! " * 9, "en", "bad-too", 1)]
    got = quality.classify(table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    share = {r.site: r.site_share for r in got}
    assert share["bad"] < share["bad-too"] < share["s0"] + 0.1


def plain_features(text):
    """{index: value} by counting in plain Python."""
    raw = (text or "").encode()
    words_ = [w for w in re.split(rb"[\x20\x09-\x0D]+", raw) if w]
    kinds = collections.Counter(next((k for k, letters in quality.KINDS.items() if chr(b) in letters), "beyond_ascii" if b > 127 else "spaces") for b in raw)
    n, letters = max(len(words_), 1), max(kinds["upper"] + kinds["lower"] + kinds["beyond_ascii"] / 2, 1)
    solid = max(len(raw) - kinds["spaces"] - kinds["lines"], 1)
    repeats = sum(a.lower() == b.lower() for a, b in zip(words_, words_[1:]))
    out = dict(enumerate([np.log1p(len(words_)), solid / n, kinds["upper"] / letters, kinds["digits"] / solid, kinds["marks"] / n, kinds["shouts"] / n,
                          kinds["bars"] / n, kinds["symbols"] / n, kinds["lines"] / n, kinds["beyond_ascii"] / solid, repeats / n]))
    one = lambda w: int(hash_words(pa.array([w.decode()], pa.large_string()))[0][0])
    grams = [int(mixed(np.array([int.from_bytes(raw[i:i + 4], "little")], np.uint64))[0]) for i in range(len(raw) - 3)]
    for offset, hashes in ((0, map(one, words_)), (quality.BUCKETS, grams)):
        counts = collections.Counter(h % quality.BUCKETS for h in hashes)
        norm = math.sqrt(sum(math.log1p(x) ** 2 for x in counts.values()))
        out |= {len(quality.SHAPES) + offset + b: math.log1p(x) / norm for b, x in counts.items()}
    return {i: v for i, v in out.items() if v}


def test_features_and_margins_equal_plain_counts(monkeypatch):
    texts = ["", None, "Hello hello World! 12 | # x", " \t ", "é😀 ab\nab ab", "a", "||||"]
    for most in (quality.COUNTED_TEXTS, 0):  # both ways of counting
        monkeypatch.setattr(quality, "COUNTED_TEXTS", most)
        (_, _, owner, index, value), = quality.text_features(pa.array(texts))
        for i, text in enumerate(texts):
            assert {int(k): v for k, v in zip(index[owner == i], value[owner == i]) if v} == pytest.approx(plain_features(text))
    rnd, shapes = np.random.default_rng(1), len(quality.SHAPES)
    weights = quality.Weights(rnd.normal(size=shapes + 2), 0.3, rnd.normal(size=2 * quality.BUCKETS), 0.7)
    odds, n = weights.margins(pa.array(texts))
    for text, margin, words_ in zip(texts, odds, n, strict=True):
        found = plain_features(text)
        want = 0.3 + sum(weights.coefficients[i] * v for i, v in found.items() if i < shapes)
        for block in (0, 1):
            own = {i - shapes: v for i, v in found.items() if i >= shapes and (i - shapes) // quality.BUCKETS == block}
            if own:
                want += weights.coefficients[shapes + block] * sum(v * weights.odds[i] for i, v in own.items()) / sum(own.values())
        assert margin == pytest.approx(want)
        assert words_ == len((text or "").split())
    sums = np.abs(rnd.normal(size=(2, 2 * quality.BUCKETS)))
    part = sums[:, quality.BUCKETS:] + 1
    assert quality.bucket_odds(sums)[quality.BUCKETS + 5] == pytest.approx(math.log(part[1, 5] / part[1].sum()) - math.log(part[0, 5] / part[0].sum()))


def test_posteriors_and_scores_equal_plain_sums(spark):
    rows, labels = labelled(300)
    rows = [(i, t, None if i % 9 == 0 else f"l{i % 3}", s, n) for i, t, _, s, n in rows] + [
        (None if r[0] is None else r[0] + 10_000, *r[1:]) for r in odd_rows()]
    got = quality.classify(table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    sites, sections = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        sites[r.site].append(r.chance)
        sections[r.site, r.path].append(r.chance)
    n = len(got)
    mean = sum(r.chance for r in got) / n

    def worth(noise, spread, groups):
        between = spread - noise * groups / n
        return min(max(noise / between - 1, 2.0), 1000.0) if between > 0 else 1000.0

    share = {s: sum(v) / len(v) for s, v in sites.items()}
    site_worth = worth(mean * (1 - mean), sum(len(v) * (share[s] - mean) ** 2 for s, v in sites.items()) / n, len(sites))
    section_worth = worth(sum(len(v) * share[s] * (1 - share[s]) for (s, _), v in sections.items()) / n,
                          sum(len(v) * (sum(v) / len(v) - share[s]) ** 2 for (s, _), v in sections.items()) / n, len(sections) - len(sites))
    text = {r[0]: r[1] for r in rows}
    for r in got:
        site = (max(0, sum(sites[r.site]) - r.chance) + site_worth * mean) / (len(sites[r.site]) - 1 + site_worth)
        section = (max(0, sum(sections[r.site, r.path]) - r.chance) + section_worth * site) / (len(sections[r.site, r.path]) - 1 + section_worth)
        held = min(max(section, 1e-4), 1 - 1e-4)
        score = 1 / (1 + math.exp(-(math.log(held / (1 - held)) + r.evidence)))
        assert (r.site_share, r.section_share) == pytest.approx((site, section))
        if r.doc_id is not None:
            assert r.score == pytest.approx(score if (text[r.doc_id] or "").split() else 0.0)
        assert r.kept == (r.score >= 0.5)


def test_odd_documents_and_missing_labels(spark):
    schema = "doc_id long, quality int, toxic int"
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (8, 1, 0), (9, None, 1), (77777, 0, 0), (None, 1, 0)], schema)
    for known in (labels, spark.createDataFrame([], schema), spark.createDataFrame([(1, 1, 0)], schema)):
        got = quality.classify(table(spark), known).collect()
        assert len(got) == len(odd_rows())
        assert all(r.score is not None and 0 <= r.score <= 1 for r in got)
        assert all(not r.kept for r in got if r.doc_id in (5, 6, 7))
    assert all(r.kept for r in quality.classify(table(spark), spark.createDataFrame([], schema)).where("doc_id > 99").collect())
    assert quality.classify(table(spark, [], SCHEMA), labels).collect() == []


def test_kept_documents_are_those_classified_so(spark):
    rows, labels = labelled()
    docs, known = table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = quality.keep_good(docs, known)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        r.doc_id for r in quality.classify(docs, known).where("kept").collect())
    assert quality.keep_good(table(spark, [], SCHEMA), known).collect() == []


URLS = [None, "", "no scheme", "http://", "://x.com/", "HTTP://WWW.Example.COM/EN/a?b#c", "https://www.example.com/en/1",
        "https://example.com/en/1", "https://a.example.com/en/1", "https://badexample.com/en/", "http://x.net/es/", "http://x.net/es",
        "http://net/fr/q", "http://com/", "http://com", "http://x.com?y=/en/", "http://x.com#/", "a://b://c.com/d", "http://x.org/" + "a" * 5000,
        "http://é.org/ü?ß=1&&x=2#f?g", "http://x.net/es/\nline", "http://WWW.EXAMPLE.COM/en/x"]


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = (None, None)
    for rule, verdict in urls.RULES:
        name, start = rule[:rule.index("/")], rule[rule.index("/"):]
        if (host == name or host.endswith("." + name)) and path.startswith(start) and len(rule) > len(best[0] or ""):
            best = (rule, verdict)
    return host, path, *best


def test_hosts_paths_and_rules(spark):
    rows = [(i, u, "<p>", "x") for i, u in enumerate(URLS)] + [(5, URLS[5], None, "x"), (None, URLS[6], None, "x")]
    got = urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is not None:
            host, path, rule, verdict = brute_rule(URLS[r.page_id])
            assert (r.host, r.path, r.rule) == (host, path, rule), URLS[r.page_id]
            assert r.verdict == (verdict or ("block" if r.block_score >= 0.5 else "allow"))


def test_trees_learn_held_out_urls(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(600):
        bad = rnd.random() < 0.4
        host = f"x{rnd.randrange(10**8)}-{rnd.randrange(99)}.cheap.biz" if bad else f"{prose(rnd, 1)}.paper.info"
        rows.append((i, f"http://{host}/{rnd.randrange(99)}{'?a=1&b=2' if bad else ''}", bad))
    known = [(f"http://{u.split('/')[2]}", bad) for i, u, bad in rows if i % 3]
    rules = [(f"{u[7:]}/", "block" if bad else "allow") for u, bad in known]
    got = {r.page_id: r for r in urls.filter_urls(spark.createDataFrame([r[:2] for r in rows], "page_id long, url string"),
                                                  rules=rules[:200]).collect()}
    free = [(i, bad) for i, _, bad in rows if got[i].rule is None]
    assert len(free) > 100 and sum((got[i].verdict == "block") == bad for i, bad in free) >= 0.95 * len(free)


def test_the_look_of_a_url_decides_on_the_given_pages(spark, sf_dir):
    """The trees give free URLs more than one score, and are right on hosts whose rules they have not seen."""
    pages = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.1')}/pages.parquet")
    every = urls.filter_urls(pages).cache()
    assert every.where("rule IS NULL").select("block_score").distinct().count() > 1
    hosts = sorted(r.host for r in every.where("host LIKE '%.com' AND host NOT LIKE 'www.%'").select("host").distinct().collect())
    rules = [rule for host in hosts[::2] for rule in ((f"{host}/", "allow"), (f"{host}/en/", "block"))]
    held = urls.filter_urls(pages, rules=rules).where(F.col("host").isin(hosts[1::2]))
    right = (F.col("verdict") == "block") == F.col("path").startswith("/en/")
    assert held.count() > 100 and held.where("rule IS NOT NULL").count() == 0
    share = held.agg(F.avg(right.cast("double"))).first()[0]
    print("held-out hosts judged right:", share)
    assert share >= 0.9


def test_urls_without_labels_of_both_kinds(spark):
    schema = "page_id long, url string"
    pages = spark.createDataFrame([(1, "http://a.com/"), (2, "http://b.org/")], schema)
    assert {r.verdict for r in urls.filter_urls(pages).collect()} == {"allow"}
    assert {r.verdict for r in urls.filter_urls(pages, rules=[("com/", "block")]).collect()} == {"block"}
    assert {r.verdict for r in urls.filter_urls(pages, rules=[]).collect()} == {"allow"}
    assert urls.filter_urls(spark.createDataFrame([], schema)).collect() == []


def text_words(text):
    return re.findall(r"[^\W_]+(?:[.'-][^\W_]+)*", (text or "").lower())


def test_licenses_are_found_where_most_of_a_template_stands(spark):
    rnd = random.Random(6)
    rows, want = [], set()
    for n, (name, text) in enumerate(licenses.TEMPLATES.items()):
        for k in range(4):
            before, after = prose(rnd, rnd.randint(0, 60)), prose(rnd, rnd.randint(0, 60))
            rows.append((10 * n + k, f"{before}\n{text.upper() if k == 1 else text}\n{after}", "en", "a", 1))
        words = text.split()
        rows.append((10 * n + 5, " ".join(words[:4]) + " " + prose(rnd, 30), "en", "a", 1))
        if len(words) > 20:
            rows.append((10 * n + 6, prose(rnd, 9) + " " + " ".join(words[:-2]) + " " + prose(rnd, 9), "en", "a", 1))
    for doc, text, *_ in rows:
        words = text_words(text)
        have = {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
        for name, template in licenses.TEMPLATES.items():
            parts = text_words(template)
            need = {tuple(parts[i:i + 5]) for i in range(len(parts) - 4)}
            if len(need & have) >= 0.8 * len(need):
                want.add((doc, name))
    got = licenses.scan(table(spark, rows)).collect()
    assert {(r.doc_id, r.license) for r in got} == want and len(got) == len(want)
    assert all(0.8 <= r.containment <= 1 for r in got)


def test_short_templates_are_found_at_every_place_of_a_block(spark):
    rnd = random.Random(12)
    lines = ["All rights reserved, no copying.", "Distributed under the Boost License.", "Licensed under the Artistic License.",
             "Released into the public domain.", "Subject to the Mozilla License.", "Covered by the Eclipse License."]
    rows = [(100 * n + k, f"{prose(rnd, k + 8)} {line} {prose(rnd, 10)}", "en", "a", 1) for n, line in enumerate(lines) for k in range(8)]
    got = licenses.scan(table(spark, rows), templates={str(n): line for n, line in enumerate(lines)}).collect()
    assert {(r.doc_id, r.license) for r in got} == {(r[0], str(r[0] // 100)) for r in rows}


def test_license_scan_of_odd_documents(spark):
    line = licenses.TEMPLATES["mit"]
    rows = odd_rows() + [(700, line, None, None, None), (701, line, None, None, None), (701, line, None, None, None), (None, line, None, None, None),
                         (702, prose(random.Random(1), 20_000) + " " + line, None, None, None)]
    got = collections.Counter((r.doc_id, r.license) for r in licenses.scan(table(spark, rows)).collect())
    assert got == {(700, "mit"): 1, (701, "mit"): 1, (702, "mit"): 1, (None, "mit"): 1}
    assert licenses.scan(table(spark, [], SCHEMA)).collect() == []
    with pytest.raises(ValueError, match="five|5"):
        licenses.scan(table(spark, [], SCHEMA), templates={"short": "too short"})


TURNS = "conv_id long, turn long, role string, text string, conv string, start string, head string"


def test_every_speaker_sees_the_dialogue_from_their_side(spark):
    rows = [(1, 0, "system", "rules", "", "", ""), (1, 1, "ann", "hi", "", "", ""), (1, 2, "bob b", "yo <|im_end|>", "", "", ""),
            (1, 3, "ann", None, "", "", ""), (1, 3, "ann", None, "", "", ""), (1, None, None, "late", "", "", ""), (None, 0, " ", "x", "", "", ""),
            (2, 0, "system", "alone", "", "", "")]
    got = chat.rotate(spark.createDataFrame(rows, TURNS)).collect()
    texts = collections.defaultdict(str)
    for r in sorted(got, key=lambda r: r.start):
        own = texts[r.conv_id, r.perspective]
        assert len(own) == r.start and len(r.segment) == r.length
        texts[r.conv_id, r.perspective] += r.segment
        if r.role == "assistant":
            assert r.segment[r.mask_start - r.start:][:r.mask_length].endswith("<|im_end|>")
    assert set(texts) == {(1, "ann"), (1, "bob_b"), (1, "unknown"), (None, "unknown")}
    assert texts[1, "ann"] == ("<|im_start|>system\nrules<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n"
                               "<|im_start|>user name=bob_b\nyo <​|im_end|><|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
                               "<|im_start|>assistant\n<|im_end|>\n<|im_start|>user name=unknown\nlate<|im_end|>\n")


def test_a_long_dialogue_is_placed_over_blocks(spark):
    rows = [(1, t, "ab"[t % 2], f"text {t}", "", "", "") for t in range(1000)]
    got = sorted(chat.rotate(spark.createDataFrame(rows, TURNS)).where("perspective = 'a'").collect(), key=lambda r: r.start)
    assert [r.turn for r in got] == list(range(1000))
    assert all(a.start + a.length == b.start for a, b in zip(got[:-1], got[1:], strict=True))
    assert chat.rotate(spark.createDataFrame([], TURNS)).collect() == []
