"""License scan: MinHash bands over overlapping windows retrieve templates, shingle containment verifies them."""

from __future__ import annotations

import random
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: public license notices
TEMPLATES = {
    "mit": "Released under the MIT License.",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": "you may not use this file except in compliance with the License. You may obtain a copy of the "
                         "License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation",
    "bsd-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                  "provided that the following conditions are met",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
}
WORDS = r"[\p{L}\p{N}]+(?:[.'-][\p{L}\p{N}]+)*"
SHINGLE = 5
THRESHOLD = 0.8
# A window is a run of blocks of this many shingles and moves on by one block.
BLOCK = 4
# One row per band. Bands are read block by block: a template's smallest shingle under a band's order is also the smallest of
# the block that holds it with a chance of at least 1/4, and a match of 0.8 holds it with a chance of 0.8, so that a
# band agrees with at least 0.2 and 64 bands miss a match with a chance of less than 1 in a million. This needs orders in which
# every shingle is as likely to come first: those of a hash of shingle and seed, not of the shingle with some bits flipped.
BANDS = 64


def seeds() -> list[int]:
    draw = random.Random(20)
    return [draw.getrandbits(64) - 2**63 for _ in range(BANDS)]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORDS), F.lit(0))


def shingles_of(words: Column) -> Column:
    """Runs of five words, joined; empty with fewer words."""
    starts = F.when(F.size(words) >= SHINGLE, F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1)))
    return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.array_join(F.slice(words, i, SHINGLE), " "))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later lambdas read as a value; a plain projection could be inlined into them and evaluated
    again for every element."""
    return df.withColumn(name, F.explode(F.array(value)))


def shingle_hashes(hashes: Column) -> Column:
    parts = lambda i: [F.get(hashes, i + k) for k in range(SHINGLE)]
    count = F.size(hashes) - SHINGLE
    return F.when(count >= 0, F.transform(F.sequence(F.lit(0), count), lambda i: F.xxhash64(*parts(i)))).otherwise(
        F.array().cast("array<bigint>"))


def smallest(shingles: Column, seed: int) -> Column:
    return F.array_min(F.transform(shingles, lambda x: F.xxhash64(x.bitwiseXOR(F.lit(seed)))))


def template_table(spark: SparkSession, templates: Mapping[str, str]) -> DataFrame:
    """(license, parts, codes, m, blocks, signature): the distinct shingles of each template and its band values."""
    rows = spark.createDataFrame(list(templates.items()), "license string, text string")
    rows = once(rows, "words", words_of(F.col("text")))
    rows = once(rows, "hashes", F.transform("words", lambda w: F.xxhash64(w)))
    rows = once(rows, "codes", F.array_distinct(shingle_hashes(F.col("hashes"))))
    return rows.select("license", F.array_distinct(shingles_of(F.col("words"))).alias("parts"), "codes", F.size("codes").alias("m"),
                       (F.ceil(F.size("codes") / BLOCK) + 1).cast("int").alias("blocks"),
                       F.array(*[smallest(F.col("codes"), s) for s in seeds()]).alias("signature"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Mapping[str, str] = TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """One row per document and license found: id, license, containment (the best of its windows, at least
    ``threshold``), first_word (of the first window that reaches the threshold), windows (how many do).

    Words are lower-cased runs of letters and digits; shingles are five words. Each window's smallest shingle under every
    band's order is its signature; a template is retrieved by a window if they agree in a band, and holds
    if the window has at least ``threshold`` of its distinct shingles. Null and short texts have no shingles and
    match nothing. Repeated ids are reported once. Templates are a parameter of bounded number, each of
    five words at least. An empty table gives no rows.
    """
    spark = docs.sparkSession
    known = template_table(spark, templates)
    listed = known.collect()
    if any(not t["m"] for t in listed):
        raise ValueError(f"a template needs {SHINGLE} words")
    keys = F.lit(sorted({v for t in listed for v in t["signature"]}))
    # a window that agrees in a band holds a shingle of the template
    needed = F.lit(sorted({c for t in listed for c in t["codes"]}))

    read = once(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "words", words_of(F.col("text"))).drop("text")
    read = once(read, "hashes", F.transform("words", lambda w: F.xxhash64(w)))
    read = once(read, "codes", shingle_hashes(F.col("hashes"))).drop("hashes")
    # a window agrees with a template in a band only if one of its blocks does
    count = F.floor((F.size("codes") + (BLOCK - 1)) / BLOCK).cast("int")
    block = lambda i: F.slice("codes", i * BLOCK + 1, BLOCK)
    agreeing = F.filter(F.sequence(F.lit(0), count - 1), lambda i: F.arrays_overlap(
        F.array(*[smallest(block(i), s) for s in seeds()]), keys))
    hits = read.where(F.arrays_overlap("codes", needed)).withColumn("block", F.explode(agreeing))
    hits = hits.withColumn("signature", F.array(*[smallest(block(F.col("block")), s) for s in seeds()]))

    # templates are joined on the band value, then windows over the block are checked as a whole
    bands = F.posexplode(F.col("signature")).alias("band", "value")
    retrieved = hits.select("id", "words", "codes", "block", bands).join(
        F.broadcast(known.select("license", "parts", "m", "blocks", bands)), ["band", "value"])
    windows = retrieved.dropDuplicates(["id", "license", "block", "words"]).withColumn(
        "first", F.explode(F.sequence(F.greatest(F.lit(0), F.col("block") - F.col("blocks") + 1), F.col("block"))))
    start = F.col("first") * BLOCK + 1
    inside = shingles_of(F.slice("words", start, F.col("blocks") * BLOCK + (SHINGLE - 1)))
    windows = windows.withColumn("containment", F.size(F.array_intersect("parts", inside)) / F.size("parts"))
    found = windows.where(F.col("containment") >= threshold)
    return found.groupBy("id", "license").agg(
        F.max("containment").alias("containment"), (F.min("first") * BLOCK).cast("long").alias("first_word"),
        F.countDistinct("first").alias("windows")).select(F.col("id").alias(id_col), "license", "containment", "first_word", "windows")
