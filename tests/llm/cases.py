"""Small tables with the cases every operator has to stand."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names the operators use inside
CLASHING = ["row", "id", "size", "rank", "part", "spot", "taken", "key", "length", "prefix", "sha", "node", "site", "path",
            "features", "score", "kept", "queue", "round", "_offset", "words", "codes"]


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghijklmnopqrst") for _ in range(rnd.randint(2, 7))) for _ in range(n))


def odd_rows(seed=3):
    """Nulls in every column, empty and blank texts, a long text, copies, near copies, repeated rows, a hot source."""
    rnd = random.Random(seed)
    base, long = prose(rnd, 80), prose(rnd, 20_000)
    rows = [(1, base, "en", "a", 1), (2, base.upper(), "en", "a", 1), (3, base.replace(" ", "\n", 9), None, None, None),
            (4, base + " one more", "fr", "a", 4), (5, None, "en", "b", None), (6, "", "en", "b", 0), (7, " \t\n ", "en", None, 4),
            (8, "Word", "en", "b", 4), (9, "two words", "en", "c", 9), (10, "two words", "en", "a", 9), (10, "two words", "en", "a", 9),
            (11, long, "de", "a", None), (12, long[:-5], "de", "c", None), (None, base, "en", "a", 1), (None, None, None, None, None),
            (13, "é̂ ½ ﬁ 'tis it's <|endoftext|> ΑΣ İ x" + chr(0x85) + "y 12345 !!!", "xx", "É", 3),
            (14, prose(rnd, 30) + " " + base, "en", "a", 5), (15, "a" * 70_000 + " b", "en", "a", 5)]
    return rows + [(100 + i, prose(rnd, rnd.randint(1, 60)), "en", "a" if i % 3 else f"s{i % 7}", i) for i in range(60)]


def table(spark, rows=None, schema=SCHEMA, clashing=True):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(odd_rows() if rows is None else rows, schema).repartition(3)
    return df.withColumns({c: F.lit("x") for c in CLASHING}) if clashing else df


def plain(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))
