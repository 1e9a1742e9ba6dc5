"""The operators of this package as queries over the given tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import materialize
from . import chat, exact, jaccard, lexical, licenses, mixing, neighbours, packing, prefix_trie, quality, sharding, suffixes, urls
from .common import table, word_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f
    return add


# fixed value: the reversed polynomial of the checksum, as its table over all bytes
_CRC_SQL = """
crc_table AS (SELECT list(list_reduce([b::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, _:
                          xor(a >> 1, CASE WHEN a % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)) ORDER BY b) AS t FROM range(256) r(b))"""


def crc_sql(blob: str) -> str:
    """The checksum of the bytes of a blob; needs the table."""
    return f"""xor(list_reduce(list_prepend(4294967295, [('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex({blob}), '..')]),
      lambda a, b: xor(a >> 8, t[xor(a, b) % 256 + 1])), 4294967295)"""


# fixed values of the mix: weights by source, share of all words, most repeats
MIX_WEIGHTS, MIX_BUDGET, MIX_REPEATS = (3.0, 1.0, 2.0), 1.5, 2


@query("op1_mix", r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  md5(concat('mix', coalesce(doc_id::VARCHAR, ''))) AS digest FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
      FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][rank % 3 + 1] AS weight FROM s),
v AS (SELECT *, row_number() OVER o AS spot, coalesce(sum(source_size) OVER o - source_size, 0) AS before,
             (sum(source_size) OVER () * 1.5::DOUBLE - 2 * (sum(source_size) OVER o - source_size))
             / sum(weight) OVER (ORDER BY source_size / weight DESC, rank DESC) AS level
      FROM w WINDOW o AS (ORDER BY source_size / weight, rank)),
f AS (SELECT min(spot) AS spot, arg_min(level, spot) AS level FROM v WHERE 2 * source_size > weight * level),
t AS (SELECT v.*, CASE WHEN v.spot >= f.spot THEN v.weight * f.level ELSE 2.0::DOUBLE * source_size END AS target FROM v, f),
p AS (SELECT d.*, t.rank, t.source_size, t.target, row_number() OVER (PARTITION BY t.rank ORDER BY digest, size) AS spot,
             coalesce(sum(size) OVER (PARTITION BY t.rank ORDER BY digest, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             AS start FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN size > 0 THEN (epoch * source_size + start + size)::DOUBLE / target END AS finish FROM p, range(2) r(epoch)),
o AS (SELECT *, coalesce(sum(size) OVER (ORDER BY finish, rank, epoch, digest, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             AS position FROM e),
b AS (SELECT floor(sum(size) * 1.5::DOUBLE) AS budget FROM d)
SELECT doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
       sum(CASE WHEN size > 0 THEN greatest(0, least(size, budget - position)) ELSE 0 END)::BIGINT AS taken
FROM o, b GROUP BY doc_id, rank, spot""")
def op1_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    mixed = mixing.mix(materialize(docs, "sizes"), F.col("size"), F.col("doc_id"), weights=MIX_WEIGHTS,
                       budget=MIX_BUDGET, max_repeats=MIX_REPEATS)
    first = [F.first(c).alias(c) for c in ("size", "source_size", "target")]
    return (mixed.groupBy("rank", "part", "spot").agg(F.first("row.doc_id").alias("doc_id"), *first, F.sum("taken").alias("taken"))
            .select("doc_id", "size", "source_size", "target", "taken"))


def vocabulary() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


@query("op2_pack")
def op2_pack(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "source")


@query("op3_perspectives", r"""
WITH t AS (SELECT conv_id, turn, CASE WHEN n = '' THEN 'unknown' ELSE n END AS speaker, body FROM (
    SELECT conv_id, turn, regexp_replace(trim(coalesce(role, '')), '[^\p{L}\p{N}_.-]', '_', 'g') AS n,
           replace(coalesce(text, ''), '<|', '<' || chr(8203) || '|') AS body FROM conversations)),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (SELECT t.*, perspective, CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS role,
             CASE WHEN speaker <> perspective AND speaker <> 'system' THEN speaker END AS name
      FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (SELECT *, '<|im_start|>' || role || coalesce(' name=' || name, '') || chr(10) AS head FROM r),
l AS (SELECT *, length(head) + length(body) + 11 AS n FROM h),
s AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS LAST, speaker, body
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM l)
SELECT conv_id, perspective, turn, role, name, head || body || '<|im_end|>' || chr(10) AS segment, start, n::BIGINT AS length,
       CASE WHEN role = 'assistant' THEN (start + length(head))::BIGINT END AS mask_start,
       (CASE WHEN role = 'assistant' THEN length(body) + 10 ELSE 0 END)::BIGINT AS mask_length FROM s""")
def op3_perspectives(spark, sf_dir):
    return chat.rotate(table(spark, sf_dir, "conversations"))


@query("op4_repeated_passages")
def op4_repeated_passages(spark, sf_dir):
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"))


@query("op5_near_vectors", """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
g AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
      AND list_dot_product(e, e) > 0),
l AS (SELECT a.r AS x, b.r AS y FROM g a JOIN g b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
      AND list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
c(r, m) AS (SELECT r, vec_id FROM v UNION SELECT l.y, c.m FROM c JOIN l ON c.r = l.x),
m AS (SELECT r, min(m) AS component_id FROM c GROUP BY r),
n AS (SELECT x AS r, count(*) AS n FROM l GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN m USING (r) LEFT JOIN n USING (r)""")
def op5_near_vectors(spark, sf_dir):
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op6_quality")
def op6_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_exact_dedup", r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS sha FROM documents),
g AS (SELECT sha, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY sha)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id
       AND row_number() OVER (PARTITION BY sha, doc_id) = 1 AS kept, sha AS text_sha256
FROM d JOIN g USING (sha)""")
def op7_exact_dedup(spark, sf_dir):
    return exact.exact_groups(table(spark, sf_dir, "documents"))


@query("op8_jaccard", r"""
WITH RECURSIVE w AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(w) >= 3 THEN list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])
             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
t AS (SELECT r, len(s) AS n, unnest(s) AS t FROM s),
p AS (SELECT a.r AS x, b.r AS y FROM t a JOIN t b ON a.t = b.t AND a.r < b.r AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 90
      GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
c(r, m) AS (SELECT r, r FROM s UNION SELECT e.y, c.m FROM c JOIN e ON c.r = e.x WHERE c.m < e.y),
m AS (SELECT r, min(m) AS m FROM c GROUP BY r)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(s.doc_id) OVER (PARTITION BY m.m) AS component_id FROM s JOIN m USING (r)""")
def op8_jaccard(spark, sf_dir):
    return jaccard.link_documents(table(spark, sf_dir, "documents"), words=3, percent=90)


@query("op9_url_filter")
def op9_url_filter(spark, sf_dir):
    return urls.filter_urls(table(spark, sf_dir, "pages"))


@query("op10_licenses")
def op10_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


SHARDS = 8


def _place_sql(shards: int, name: str) -> str:
    """CTEs that walk the tree of ``shards`` shards; the last one, ``name``, is (r, shard)."""
    def level(out, before, column, parent, children):
        rows = ", ".join(f"({p}, {n}, {w}::DOUBLE)" for p, ws in children.items() for n, w in ws.items())
        draw = f"('0x' || substr(md5('{column}' || n || ':' || k), 1, 13))::BIGINT"
        return f"""{out}_w(p, n, w) AS (VALUES {rows}),
{out} AS (SELECT r, k, arg_min(n, -ln(({draw} + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / w) AS {column}
  FROM {before} JOIN {out}_w ON p = {parent} GROUP BY r, k)"""
    regions, racks, leaves = sharding._children(sharding.even_tree(shards))
    return ",\n".join([level(f"{name}1", "d", "region", "0", {0: regions}), level(f"{name}2", f"{name}1", "rack", "region", racks),
                       level(name, f"{name}2", "shard", "rack", leaves)])


@query("op12_shards", f"""
WITH {_CRC_SQL.strip()},
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(doc_id::VARCHAR, '') AS k FROM documents),
{_place_sql(SHARDS, "s")},
{_place_sql(SHARDS + 1, "g")},
c AS (SELECT r, doc_id, k, strlen(text) + 1 AS size, {crc_sql("encode(text)")} AS crc FROM d, crc_table)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'key' AS law, s.shard,
       row_number() OVER (PARTITION BY s.shard ORDER BY CASE WHEN doc_id IS NULL THEN md5(crc || ':' || size) ELSE md5('slot:' || c.k) END,
                          md5('slot:' || c.k), crc, size) - 1 AS slot, g.shard AS grown_shard
FROM c JOIN s USING (r) JOIN g USING (r)""")
def op12_shards(spark, sf_dir):
    placed = sharding.assign(table(spark, sf_dir, "documents"), sharding.even_tree(SHARDS), sharding.even_tree(SHARDS + 1))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


# fixed values: conversations of a family share the family's first turns, as many as a checksum modulo HEADS says
FAMILY, HEADS = 100, 6


@query("op11_prefix_trie", f"""
WITH {_CRC_SQL.strip()},
t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({{'r': r, 'x': x}} ORDER BY turn NULLS FIRST, md5(length(r) || ':' || r || x)) AS s FROM t GROUP BY conv_id),
h AS (SELECT conv_id, s, {crc_sql("encode(conv_id::VARCHAR)")} % {HEADS} AS h FROM o, crc_table),
b AS (SELECT h.conv_id, list_concat(coalesce(o.s[1:h.h], []), h.s[h.h + 1:]) AS s
      FROM h LEFT JOIN o ON o.conv_id = h.conv_id - h.conv_id % {FAMILY}),
p AS (SELECT conv_id, len(s) AS n, d, s[1:d] AS k FROM (SELECT *, unnest(range(len(s) + 1)) AS d FROM b)),
n AS (SELECT d, k, min(conv_id) AS c, count(*) AS n, coalesce(length(k[d].x), 0) AS chars,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS e FROM p GROUP BY d, k),
l AS (SELECT n.*, u.c AS parent FROM n LEFT JOIN n u ON u.d = n.d - 1 AND u.k = n.k[1:n.d - 1]),
m AS (SELECT n.d, n.k, count(u.c) AS children FROM n LEFT JOIN n u ON u.d = n.d + 1 AND u.k[1:n.d] = n.k GROUP BY n.d, n.k),
a AS (SELECT k[1:d0] AS k, sum((n - 1) * chars) AS saved, count(*) FILTER (children = 0) AS leaves
      FROM (SELECT n.*, m.children, unnest(range(n.d + 1)) AS d0 FROM n JOIN m ON n.d = m.d AND n.k = m.k) GROUP BY 1)
SELECT l.c AS conv_id, l.d::BIGINT AS depth, l.parent AS parent_conv_id, l.n AS n_convs, m.children AS n_children, a.leaves AS n_leaves,
       a.saved::BIGINT AS saved_tokens, l.e AS ends_sha256 FROM l JOIN m ON l.d = m.d AND l.k = m.k JOIN a ON a.k = l.k""")
def op11_prefix_trie(spark, sf_dir):
    turns = prefix_trie.digested(table(spark, sf_dir, "conversations"))
    return prefix_trie.build(prefix_trie.spliced(turns, FAMILY, HEADS))


@query("op13_search", r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
i AS (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
q AS (SELECT i, item_id, t, count(*) AS q FROM i GROUP BY ALL),
c AS (SELECT count(*) FILTER (len(t) > 0) AS n, sum(len(t))::BIGINT AS l FROM d),
f AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(t) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f, c GROUP BY t, n),
m AS (SELECT r, doc_id, 25 + (75 * len(t) * n) // l AS m FROM d, c WHERE l > 0),
s AS (SELECT i, item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN f USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY i, item_id, r, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k WHERE rank <= 10""")
def op13_search(spark, sf_dir):
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
