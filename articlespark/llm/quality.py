"""Quality by hierarchical empirical Bayes: text evidence per document with site and section posteriors."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize, small
from .tokens import slices
from .words import hash_words, mixed, raw_bytes

# The classifier is fitted on this many labelled documents, those with the smallest hashes.
TRAINING_DOCS = 20_000
# No document's text counts for more than this in log odds, and no share of good documents is nearer to 0 or 1.
MAX_EVIDENCE, NEAREST = 12.0, 1e-4
# Limits of the estimated worth of a prior, in documents.
LEAST_PRIOR, MOST_PRIOR = 2.0, 1000.0

# Parts of the sample by which what hashed features say of a training text is learned from others.
FOLDS = 5

# Bytes of text measured at a time; the arrays over them take some 100 times as much.
MEASURED_BYTES = 1 << 20

SHAPES = ("log_words", "word_bytes", "upper", "digits", "marks", "shouts", "bars", "symbols", "lines", "beyond_ascii", "repeats")
# Hashed features: words, and runs of GRAM bytes of the text as written; texts whose buckets are counted in one array.
BUCKETS, GRAM, COUNTED_TEXTS = 1 << 11, 4, 1 << 11
KINDS = {"upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": "abcdefghijklmnopqrstuvwxyz", "digits": "0123456789",
         "spaces": " \t\v\f\r", "lines": "\n", "marks": ".,;:'\"()-?", "shouts": "!", "bars": "|",
         "symbols": "#$%&*+/<=>@[\\]^_`{}~"}
_kind = np.full(256, len(KINDS), np.int64)
for _i, _letters in enumerate(KINDS.values()):
    _kind[[ord(c) for c in _letters]] = _i
_kind[:128][_kind[:128] == len(KINDS)] = list(KINDS).index("spaces")  # control characters


def hashed(owner: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, value): log counts per bucket, scaled to unit length in each of ``n`` texts, by text and bucket."""
    key = owner * BUCKETS + (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)
    if n <= COUNTED_TEXTS:
        count = np.bincount(key, minlength=n * BUCKETS)
        key = np.flatnonzero(count)
        count = count[key]
    else:  # very many short texts
        key, count = np.unique(key, return_counts=True)
    text, value = key // BUCKETS, np.log1p(count)
    norm = np.sqrt(np.bincount(text, value * value, minlength=n))
    return text, key % BUCKETS, value / norm[text]


def text_features(texts: pa.Array):
    """(first text, words, text, index, value) of each slice: how many words its texts have, and their features that are not zero: SHAPES
    from counts of kinds of bytes, then hashed words and byte runs."""
    names = [*KINDS, "beyond_ascii"]
    for first, part in slices(texts, MEASURED_BYTES):
        raw, ends = raw_bytes(part)
        sizes = np.diff(ends)
        n = len(sizes)
        owner = np.repeat(np.arange(n), sizes)
        counts = np.bincount(owner * len(names) + _kind[raw], minlength=n * len(names)).reshape(-1, len(names))
        hashes, bounds, _ = hash_words(part)
        words = np.diff(bounds)
        writer = np.repeat(np.arange(n), words)
        same = (hashes[1:] == hashes[:-1]) & (writer[1:] == writer[:-1])
        repeats = np.bincount(writer[1:][same], minlength=n)
        c = dict(zip(names, counts.T.astype(float), strict=True))
        letters, some = np.maximum(c["upper"] + c["lower"] + c["beyond_ascii"] / 2, 1), np.maximum(words, 1)
        solid = np.maximum(sizes - c["spaces"] - c["lines"], 1)
        shapes = np.column_stack([
            np.log1p(words), solid / some, c["upper"] / letters, c["digits"] / solid, c["marks"] / some, c["shouts"] / some,
            c["bars"] / some, c["symbols"] / some, c["lines"] / some, c["beyond_ascii"] / solid, repeats / some])
        runs = len(raw) - GRAM + 1
        grams = np.zeros(max(runs, 0), np.uint64)
        for k in range(GRAM if runs > 0 else 0):
            grams |= raw[k:k + runs].astype(np.uint64) << np.uint64(8 * k)
        whole = owner[:len(grams)] == owner[GRAM - 1:] if runs > 0 else np.zeros(0, bool)
        found = [(np.repeat(np.arange(n), len(SHAPES)), np.tile(np.arange(len(SHAPES)), n), shapes.ravel()),
                 hashed(writer, hashes, n), hashed(owner[:len(grams)][whole], mixed(grams[whole]), n)]
        text, index, value = (np.concatenate(x) for x in zip(*[
            (t, i + offset, v) for (t, i, v), offset in zip(found, (0, len(SHAPES), len(SHAPES) + BUCKETS), strict=True)], strict=True))
        yield first, words, text, index, value


def lean(owner: np.ndarray, index: np.ndarray, value: np.ndarray, n: int, odds: np.ndarray) -> np.ndarray:
    """Per text the mean log odds of its hashed words, and of its byte runs; ``odds`` has one number per bucket of either, for all texts or
    for each of them."""
    out = np.zeros((n, 2))
    hashed_ = index >= len(SHAPES)
    owner, bucket, value = owner[hashed_], index[hashed_] - len(SHAPES), value[hashed_]
    said = odds[bucket] if odds.ndim == 1 else odds[owner, bucket]
    for block in (0, 1):
        own = bucket // BUCKETS == block
        weight = np.bincount(owner[own], value[own], minlength=n)
        out[:, block] = np.bincount(owner[own], (value * said)[own], minlength=n) / np.maximum(weight, 1e-12)
    return out


def shapes_of(owner: np.ndarray, index: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, len(SHAPES)))
    own = index < len(SHAPES)
    out[owner[own], index[own]] = value[own]
    return out


def bucket_odds(sums: np.ndarray) -> np.ndarray:
    """Log odds of each bucket from its summed values in bad and in good texts, each block a distribution with one more in every bucket."""
    shares = (sums + 1).reshape(2, 2, BUCKETS)
    shares = np.log(shares / shares.sum(axis=2, keepdims=True))
    return (shares[1] - shares[0]).ravel()


@dataclass
class Weights:
    """A fitted classifier: log odds that a text is good from its shapes and how its hashed features lean, and the labels' own share of
    good ones."""

    coefficients: np.ndarray
    intercept: float
    odds: np.ndarray
    base: float

    def margins(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log odds and number of words of each text."""
        odds, words = [], []
        for _, n, *entries in text_features(texts):
            inputs = np.hstack([shapes_of(*entries, len(n)), lean(*entries, len(n), self.odds)])
            odds.append(self.intercept + inputs @ self.coefficients)
            words.append(n)
        return (np.concatenate(odds), np.concatenate(words)) if odds else (np.empty(0), np.empty(0, np.int64))


def log_odds(share: Column) -> Column:
    held = F.greatest(F.lit(NEAREST), F.least(F.lit(1 - NEAREST), share))
    return F.log(held / (1 - held))


def train(docs: DataFrame, labels: DataFrame, label: str, training_docs: int) -> Weights | float:
    """Fit on (id, text) and (id, label); without labels of both kinds the chance that a text is good.

    Hashed features are counted per class over the sample. What they say of a training text comes from the other folds, so
    that the regression over shapes and leanings learns how far they hold for new texts.
    """
    known = labels.where(F.col(label).isNotNull()).groupBy("id").agg(F.min(label).cast("double").alias("label"))
    drawn = (docs.select("id").join(known, "id").withColumn("_draw", F.xxhash64(F.lit(6), "id"))
             .orderBy("_draw", "id").limit(training_docs).select("id", "label", "_draw"))
    # bounded by training_docs, whose texts are read once more
    chosen = F.broadcast(materialize(drawn.distinct(), "drawn"))
    sample = docs.join(chosen, "id").select("_draw", "id", "label", F.pmod("_draw", F.lit(FOLDS)).cast("int").alias("fold"), "text")
    sample = materialize(sample, "quality-sample")
    seen = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(seen) < 2:
        return 0.9 if seen else 0.5

    def counted(batches):
        # whole numbers, so that the order of adding does not matter
        sums = np.zeros((FOLDS, 2, 2 * BUCKETS), np.int64)
        for batch in batches:
            fold, good = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)
            for first, words, owner, index, value in text_features(batch.column(2)):
                own = index >= len(SHAPES)
                text = first + owner[own]
                np.add.at(sums, (fold[text], good[text], index[own] - len(SHAPES)), np.rint(value[own] * 1e6).astype(np.int64))
        for kind in np.ndindex(FOLDS, 2):
            yield pa.RecordBatch.from_pydict({"kind": [kind[0] * 2 + kind[1]], "sums": [sums[kind]]},
                                             schema=pa.schema([("kind", pa.int32()), ("sums", pa.list_(pa.int64()))]))

    # a row per task, fold and class, added up by bucket
    partial = sample.select("fold", "label", "text").mapInArrow(counted, "kind int, sums array<long>")
    sums = np.zeros((FOLDS * 2, 2 * BUCKETS))
    for kind, bucket, total in partial.select("kind", F.posexplode("sums")).groupBy("kind", "pos").agg(F.sum("col")).collect():
        sums[kind, bucket] = total / 1e6
    sums = sums.reshape(FOLDS, 2, 2 * BUCKETS)
    whole = sums.sum(axis=0)
    others = np.stack([bucket_odds(whole - sums[fold]) for fold in range(FOLDS)])

    @F.arrow_udf("array<double>")
    def inputs(texts: pa.Array, fold: pa.Array) -> pa.Array:
        fold, rows = fold.to_numpy(), []
        for first, words, *entries in text_features(texts):
            n = len(words)
            rows.append(np.hstack([shapes_of(*entries, n), lean(*entries, n, others[fold[first:first + n]])]))
        rows = np.concatenate(rows) if rows else np.empty((0, len(SHAPES) + 2))
        return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32), rows.ravel())

    # one partition in a fixed order, so that reruns fit the same model
    rows = sample.select("_draw", "id", "label", array_to_vector(inputs("text", "fold")).alias("features"))
    rows = materialize(rows.coalesce(1).sortWithinPartitions("_draw", "id", "label"), "quality-inputs").coalesce(1)
    model = LogisticRegression(featuresCol="features", labelCol="label", regParam=0.001, maxIter=100).fit(rows)
    return Weights(model.coefficients.toArray(), model.intercept, bucket_odds(whole), seen[1.0] / sum(seen.values()))


def evidence(texts: DataFrame, weights: Weights | float) -> DataFrame:
    """Replace ``text`` by ``words``, ``evidence`` (log odds the text adds to a prior) and ``chance`` (with the labels' own prior)."""
    if isinstance(weights, float):
        words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
        return texts.withColumns({"words": words, "evidence": F.lit(0.0), "chance": F.lit(weights)}).drop("text")
    known = texts.sparkSession.sparkContext.broadcast(weights)
    prior = float(np.log(weights.base / (1 - weights.base)))

    @F.arrow_udf("struct<margin:double,words:long>")
    def judged(batch: pa.Array) -> pa.Array:
        odds, words = known.value.margins(batch)
        return pa.StructArray.from_arrays([pa.array(odds, pa.float64()), pa.array(words, pa.int64())], ["margin", "words"])

    rows = texts.withColumn("_judged", judged("text")).drop("text")
    odds = F.col("_judged.margin")
    return rows.withColumns({"words": F.col("_judged.words"), "evidence": F.greatest(F.lit(-MAX_EVIDENCE), F.least(F.lit(MAX_EVIDENCE), odds - prior)),
                             "chance": 1 / (1 + F.exp(-odds))}).drop("_judged")


def worth(noise: float, spread: float, groups: float, docs: float) -> float:
    """How many documents a prior is worth, by the method of moments: how far shares of groups spread beyond what their sizes explain."""
    between = spread - noise * groups / max(docs, 1)
    return float(np.clip(noise / between - 1, LEAST_PRIOR, MOST_PRIOR)) if between > 0 else MOST_PRIOR


def judge(measured: DataFrame) -> DataFrame:
    """Add site_share, section_share, score and kept to stored rows with site, path, words, evidence and chance.

    The share of good documents of a site is drawn to the global one, that of a section (site and path) to its site's, the more the
    fewer documents there are; how much is estimated from all sites, and from all sections within sites. A document's own judgement
    is left out of the shares it is weighed against.
    """
    sections = materialize(measured.groupBy("site", "path").agg(F.sum("chance").alias("section_good"), F.count("*").alias("section_docs")), "sections")
    sites = sections.groupBy("site").agg(F.sum("section_good").alias("site_good"), F.sum("section_docs").alias("site_docs"))
    places = materialize(sections.join(sites, "site"), "places")
    share, own = F.col("site_good") / F.col("site_docs"), F.col("section_good") / F.col("section_docs")
    total = sites.agg((F.sum("site_good") / F.sum("site_docs")).alias("share"), F.sum("site_docs").alias("docs"), F.count("*").alias("sites")).first()
    mean, docs = (total["share"] if total["share"] is not None else 0.5), total["docs"] or 0
    spread = sites.agg(F.sum(F.col("site_docs") * (share - mean) ** 2)).first()[0] or 0.0
    inner = places.agg(F.sum(F.col("section_docs") * (own - share) ** 2).alias("spread"), F.sum(F.col("section_docs") * share * (1 - share)).alias("noise"),
                       F.count("*").alias("sections")).first()
    many = max(docs, 1)
    site_worth = worth(mean * (1 - mean), spread / many, total["sites"], docs)
    section_worth = worth((inner["noise"] or 0.0) / many, (inner["spread"] or 0.0) / many, inner["sections"] - total["sites"], docs)

    judged = measured.join(small(places), ["site", "path"])
    others = lambda total: F.greatest(F.lit(0.0), F.col(total) - F.col("chance"))
    site = (others("site_good") + site_worth * mean) / (F.col("site_docs") - 1 + site_worth)
    section = (others("section_good") + section_worth * F.col("site_share")) / (F.col("section_docs") - 1 + section_worth)
    score = 1 / (1 + F.exp(-(log_odds(F.col("section_share")) + F.col("evidence"))))
    judged = judged.withColumn("site_share", site).withColumn("section_share", section)
    judged = judged.withColumn("score", F.when(F.col("words") == 0, 0.0).otherwise(score))
    return judged.withColumn("kept", F.col("score") >= 0.5).drop("site_good", "site_docs", "section_good", "section_docs")


def place(c: str) -> Column:
    """A null site or path is a place of its own."""
    return F.when(F.col(c).isNull(), "").otherwise(F.concat(F.lit("="), F.col(c).cast("string")))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
             path_col: str = "lang", label_col: str = "quality", training_docs: int = TRAINING_DOCS) -> DataFrame:
    """One row per document: id, site, path, evidence, chance, site_share, section_share, score, kept.

    The classifier sees hashed words and byte runs of a bounded sample of labelled documents; the shares of sites and sections are sums over
    all documents. Without labels of both kinds there is no evidence, and every document with a word is kept.

    A null or empty text, or one of white space only, scores 0 and is rejected. Null sites and paths are places of
    their own. Repeated rows are judged alike; labels of ids that are not there do not matter, contradicting labels of an
    id count as the lowest. Null ids have no label. An empty table gives no rows.
    """
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(site_col).alias("_site"), F.col(path_col).alias("_path"))
    weights = train(chosen.select("id", "text"), labels.withColumnRenamed(id_col, "id"), label_col, training_docs)
    measured = materialize(evidence(chosen.withColumns({"site": place("_site"), "path": place("_path")}), weights), "evidence")
    return judge(measured).select(F.col("id").alias(id_col), F.col("_site").alias("site"), F.col("_path").alias("path"), "evidence", "chance",
                                  "site_share", "section_share", "score", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
              path_col: str = "lang", label_col: str = "quality", training_docs: int = TRAINING_DOCS) -> DataFrame:
    """The documents that ``classify`` keeps, with all their columns; cases as there. Rows are numbered once and judged by number, so that
    texts are shuffled only where the numbers that go are too many to be broadcast."""
    numbered = materialize(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number")), "numbered")
    c = F.col("row")
    chosen = numbered.select("number", c[id_col].alias("id"), c[text_col].alias("text"), c[site_col].alias("_site"), c[path_col].alias("_path"))
    weights = train(chosen.select("id", "text"), labels.withColumnRenamed(id_col, "id"), label_col, training_docs)
    rows = chosen.select("number", "text", place("_site").alias("site"), place("_path").alias("path"))
    gone = judge(materialize(evidence(rows, weights), "evidence")).where("NOT kept").select("number")
    return numbered.join(small(materialize(gone, "gone")), "number", "left_anti").select("row.*")
