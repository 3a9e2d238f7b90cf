"""Queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinora.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@register("op1_token_store")
def op1(spark, sf_dir):
    from kinora.llm.token_store import token_store
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_store(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@register("op8_warc_archive")
def op8(spark, sf_dir):
    from kinora.llm.warc import warc_archive
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc_archive(pages, min_revisit_bytes=0)


@register("op2_pii_spans")
def op2(spark, sf_dir):
    from kinora.llm import pii
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.fit(docs))


@register("op10_minhash_dedup")
def op10(spark, sf_dir):
    from kinora.llm.minhash_dedup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), least=85)


SQL["op10_minhash_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT p.doc_id AS a, q.doc_id AS b FROM shingles p JOIN shingles q ON p.x = q.x AND p.doc_id <> q.doc_id
  GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM sets s JOIN low ON low.a = s.doc_id"""


@register("op3_toxicity")
def op3(spark, sf_dir):
    from kinora.llm import toxicity
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(toxicity.remainder("doc_id") != 2)
    rows = toxicity.fit_score(docs, learned)
    return rows.select("doc_id", (toxicity.remainder("doc_id") == 2).alias("held_out"), "score",
                       F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


@register("op7_hnsw")
def op7(spark, sf_dir):
    from kinora.llm.hnsw import nearest
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0, k=20)


@register("op9_decontaminate")
def op9(spark, sf_dir):
    from kinora.llm.decontaminate import flag
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = flag(docs, table(spark, sf_dir, "benchmark"), least=80, min_words=1)
    return found.select("doc_id", (F.size("items") > 0).alias("contaminated"), F.size("items").cast("long").alias("n_items"),
                        F.array_join("items", ",").alias("items"))


@register("op5_unigram_counts")
def op5(spark, sf_dir):
    from kinora.llm.unigram_count import token_counts
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))


@register("op6_merge_dropout")
def op6(spark, sf_dir):
    from kinora.llm import merge_dropout
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = merge_dropout.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model, seed=6, dropout=0.1)
    rows = merge_dropout.decode(rows, model)
    return rows.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
                       F.crc32(F.encode(F.coalesce(F.array_join(F.col("ids").cast("array<string>"), ","), F.lit("")), "UTF-8")).alias("ids_crc32"),
                       F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


@register("op4_suffix_dedup")
def op4(spark, sf_dir):
    from kinora.llm.suffix_dedup import digest, remove_repeats
    return digest(remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")))


# Two hexadecimal digits a byte: a string of 50 bytes is one of 100 digits.
SQL["op4_suffix_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(coalesce(text, '')) AS h FROM documents),
w AS (SELECT r, coalesce(doc_id, 9223372036854775807) AS doc_id, i, substr(h, 2 * i + 1, 100) AS s
  FROM (SELECT r, doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d)),
least AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING count(*) > 1),
hit AS (SELECT r, i FROM w JOIN least USING (s) WHERE least.first < w.doc_id),
edge AS (SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + 50, true) AS opens FROM hit),
run AS (SELECT r, i, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS n FROM edge),
span AS (SELECT r, min(i) AS a, max(i) + 50 AS b FROM run GROUP BY r, n),
bound AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS since FROM span),
kept AS (SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
    string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS head FROM bound JOIN d USING (r) GROUP BY r)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""


# Base32 of a digest: four letters for each five hexadecimal digits.
SQL["op8_warc_archive"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS s FROM pages),
firsts AS (SELECT s, strlen(h) AS n, min(page_id) AS first FROM p GROUP BY s, strlen(h))
SELECT p.page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(p.s, (i // 4) * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
  CASE WHEN p.page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN p.page_id = f.first THEN NULL ELSE f.first END AS refers_to
FROM p JOIN firsts f ON f.s = p.s AND f.n = strlen(p.h)"""


@register("op12_filter_audit")
def op12(spark, sf_dir):
    from kinora.llm.filter_audit import filter_audit
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL["op12_filter_audit"] = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS smallest FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
f AS (SELECT part, len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
    100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) AS c,
    regexp_matches(t, '[#$%&*|]') AS d, coalesce(w.doc_id > smallest, false) AS e, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
g AS (SELECT part, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
    || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
  FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS y),
o AS (SELECT p.y || q.y || r.y || s.y || t.y AS filter_order FROM x p, x q, x r, x s, x t
  WHERE len(list_distinct([p.y, q.y, r.y, s.y, t.y])) = 5),
steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS earlier
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
rows AS (SELECT part, filter_order, step, own, n, good, toxic, fails = own AS only_own, contains(fails, own) AS failing,
    fails <> '' AND regexp_matches(fails, '[' || earlier || '-]') AS gone FROM g, steps),
r AS (SELECT part, filter_order, step, own, sum(CASE WHEN gone OR failing THEN 0 ELSE n END) AS kept,
    sum(CASE WHEN failing AND NOT gone THEN n ELSE 0 END) AS removed, sum(CASE WHEN failing AND gone THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN only_own THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN failing AND NOT gone THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN failing AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost FROM rows GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r"""


@register("op11_simhash_dedup")
def op11(spark, sf_dir):
    from kinora.llm.simhash import simhash_components
    return simhash_components(table(spark, sf_dir, "documents").select("doc_id", "text"), errors=4)


@register("op13_conversation_trie")
def op13(spark, sf_dir):
    from kinora.llm.conversation_trie import conversation_trie
    return conversation_trie(table(spark, sf_dir, "conversations"))


# The crc32 of a decimal number is taken byte by byte: -1 stands for one shift.
SQL["op13_conversation_trie"] = r"""
WITH t AS (SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w, turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, {'k': k, 'w': w} AS k, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS pos FROM t),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
    string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
u AS (SELECT c.conv_id, 0 AS part, pos, k FROM c JOIN o ON o.conv_id = c.base WHERE pos <= h
  UNION ALL SELECT c.conv_id, 1, pos, k FROM c JOIN o ON o.conv_id = c.conv_id WHERE pos > h),
s AS (SELECT c.conv_id, coalesce(any_value(l), []) AS s FROM c LEFT JOIN
  (SELECT conv_id, list(k ORDER BY part, pos) AS l FROM u GROUP BY conv_id) q ON q.conv_id = c.conv_id GROUP BY c.conv_id),
p AS (SELECT conv_id, d, s[1:d] AS p, len(s) = d AS ends, CASE WHEN d > 0 THEN s[d].w ELSE 0 END AS w
  FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM s)),
n AS (SELECT d, p, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM p GROUP BY d, p),
k AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.d = n.d AND k.p = n.p),
a AS (SELECT a.a AS d, p[1:a.a] AS p, sum((n_convs - 1) * w) AS saved, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM m) a GROUP BY ALL)
SELECT m.conv_id, CAST(m.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children, CAST(a.leaves AS BIGINT) AS n_leaves,
  CAST(a.saved AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN a ON a.d = m.d AND a.p = m.p LEFT JOIN n up ON up.d = m.d - 1 AND up.p = m.p[1:m.d - 1]"""
