"""TF-IDF weights as a long table, computed with native Spark expressions.

Weighting (the reference's vectoriser settings):

* tokens: lower-cased runs of >= 2 word characters ([\\p{L}\\p{N}_])
* English stop words removed, then uni- and bigrams (bigrams over the
  stop-filtered sequence, joined by one space)
* tf = 1 + ln(count)            (sublinear)
* idf = ln((1 + N) / (1 + df)) + 1  (smoothed; N counts every document)
* rows L2-normalised

Plan: only texts are shuffled by document.  They are dealt into blocks of about
``BLOCK_BYTES`` by id; tokens, n-grams and (doc, term) counts are made inside a block.
For document frequencies a block sends each of its distinct terms once, with the number
of its documents that have it, to the term's part, where they are summed up over the
blocks.  Weights and vectors are worked out with Arrow and NumPy (``term_blocks``): a
block is counted twice, first for its lists of terms, which get back the frequencies in
the same order, then for the weights.  No (doc, term) row is moved.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinora.functions.stopwords import ENGLISH_STOP_WORDS
from kinora.operators import term_blocks
from kinora.session import default_parallelism

# FIXED VALUE: token pattern equivalent to the vectoriser's (?u)\b\w\w+\b.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
# Text of a block: its (doc, term) rows are some 20 times as large in a task's memory.
BLOCK_BYTES = 8 << 20


def token_array(text: Column, stop_words=ENGLISH_STOP_WORDS) -> Column:
    """Lower-case, tokenise, drop stop words; order kept (array<string>).

    ``isin`` over many literals is rewritten by Catalyst into a hash-set lookup.
    """
    toks = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)
    if not stop_words:
        return toks
    return F.filter(toks, lambda t: ~t.isin(list(stop_words)))


def spaced(text: Column) -> Column:
    """Lower-cased text whose tokens are ``token_array``'s for other regular expressions
    too: what stands between them is a space, unless all characters are ASCII."""
    low = F.lower(text)
    return F.when(F.octet_length(low) == F.length(low), low).otherwise(F.regexp_replace(low, term_blocks.GAP_PATTERN, " "))


# Zero-width match at each token start of the space-joined token string; the
# lookahead captures "token next-token" (tokens never contain spaces).
BIGRAM_PATTERN = r"(?:^| )(?=([^ ]+ [^ ]+))"


def gram_array(toks: Column) -> Column:
    """Unigrams followed by bigrams of adjacent tokens.

    Bigrams come from one regex over the joined tokens rather than a
    ``zip_with`` lambda: same pairs, but codegen'd instead of interpreted.
    Pass a column reference so the token array is computed once."""
    bigrams = F.regexp_extract_all(F.array_join(toks, " "), F.lit(BIGRAM_PATTERN), 1)
    return F.concat(toks, bigrams)


def tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, pos, token) - 0-based position after stop-word removal."""
    return (docs.select(F.col(id_col).alias("doc_id"), token_array(F.col(text_col)).alias("t"))
            .select("doc_id", F.posexplode("t").alias("pos", "token"))
            .select("doc_id", F.col("pos").cast("int").alias("pos"), "token"))


def in_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """(b, doc_id, text) dealt by the block ``b`` of the document, and the number of blocks."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n = max(default_parallelism(docs.sparkSession), math.ceil(size / BLOCK_BYTES))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.select(F.pmod(F.hash("doc_id"), F.lit(n)).alias("b"), "doc_id", "text").repartitionById(n, "b"), n


def block_counts(blocks: DataFrame, ngram_max: int = 2) -> DataFrame:
    """(b, doc_id, term, tf_count) of documents ``in_blocks``, without a shuffle."""
    toks = blocks.select("b", "doc_id", token_array(F.col("text")).alias("t"))
    grams = gram_array(F.col("t")) if ngram_max >= 2 else F.col("t")
    return (toks.select("b", "doc_id", F.explode(grams).alias("term"))
            .groupBy("b", "doc_id", "term").agg(F.count(F.lit(1)).alias("tf_count")))


def _packed(rows: DataFrame, *keys: str) -> DataFrame:
    """Lists of the terms of equal keys; a term has no line end."""
    return rows.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list("term")), "\n").alias("terms"))


def _unpacked(lists: DataFrame, *keys: str) -> DataFrame:
    return lists.select(*keys, F.explode(F.split("terms", "\n")).alias("term"))


def term_parts(spark: SparkSession, n_blocks: int) -> int:
    return max(default_parallelism(spark), n_blocks // 2)


def weighed_blocks(docs: DataFrame, kernel, schema: T.StructType, id_col: str = "doc_id", text_col: str = "text",
                   ngram_max: int = 2, numbered: bool = False) -> DataFrame:
    """What ``kernel(parts)`` of ``term_blocks`` gives for each block and the frequencies of
    its terms; ``numbered``: and their numbers."""
    blocks, n = in_blocks(docs, id_col, text_col)
    parts = term_parts(docs.sparkSession, n)
    spaces = blocks.select("b", "doc_id", spaced(F.col("text")).alias("text"))
    lists = spaces.groupBy("b").applyInArrow(term_blocks.term_lists(parts, ngram_max), term_blocks.LISTS_SCHEMA)
    found = lists.repartitionById(parts, "p").groupBy("p").applyInArrow(
        term_blocks.frequencies(numbered), term_blocks.NUMBERED_SCHEMA if numbered else term_blocks.FREQUENCIES_SCHEMA)
    found = found.repartitionById(n, "b").withColumn("n_docs", docs.agg(F.count(F.lit(1))).scalar())
    id_field = T.StructField("doc_id", docs.schema[id_col].dataType)
    return spaces.groupBy("b").cogroup(found.groupBy("b")).applyInArrow(kernel(parts), T.StructType([id_field, *schema]))


def shared_terms(counts: DataFrame, n_blocks: int) -> DataFrame:
    """(b, p, term, df, tid) of each block's terms that at least two documents have, dealt
    by the term's part ``p``; ``tid`` numbers a term, the same in all blocks (store the
    rows before using it)."""
    parts = term_parts(counts.sparkSession, n_blocks)
    own = counts.groupBy("b", "term").agg(F.count(F.lit(1)).alias("n")).withColumn("p", F.pmod(F.hash("term"), F.lit(parts)))
    dealt = _unpacked(_packed(own, "b", "p", "n").repartitionById(parts, "p"), "b", "p", "n")
    term = Window.partitionBy("p", "term")  # one row a block at most
    return (dealt.withColumn("row", F.monotonically_increasing_id())
            .select("b", "p", "term", F.sum("n").over(term).alias("df"), F.min("row").over(term).alias("tid")).where("df > 1"))


def term_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                ngram_max: int = 2) -> DataFrame:
    """(doc_id, term, tf_count) for uni- (and bi-) grams."""
    return block_counts(in_blocks(docs, id_col, text_col)[0], ngram_max).drop("b")


def tfidf_weights(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  ngram_max: int = 2) -> DataFrame:
    """(doc_id, term, weight) with L2-normalised sublinear TF-IDF."""
    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType())])
    return weighed_blocks(docs, lambda parts: term_blocks.weights(parts, ngram_max), schema, id_col, text_col, ngram_max)
