"""Corpus pipeline: filters and rewrites ``documents`` stage by stage.

STAGES names the stages in order.  Each takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next stage's docs:

1. toxicity: documents that the models of ``labels`` score 0.3 or more go;
2. near_duplicates: of documents linked at a similarity of 0.8 over five-word shingles
   the one with the smallest doc_id stays; documents without words or id stay;
3. decontamination: documents that hold an item of ``benchmark`` go;
4. personal_data: personal data is replaced by ``[KIND]`` in the texts;
5. sentencepiece: ids under seeded merge-dropout are added, and the text is what they
   decode to, which is the text that was encoded.

All but the last return the columns of ``documents``.  An empty stage result is passed
on as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinora.llm import decontaminate, merge_dropout, pii
from kinora.llm import toxicity as toxic_models
from kinora.llm.common import table
from kinora.llm.minhash_dedup import near_duplicates as near
from kinora.session import materialize

TOXIC, SIMILAR, HELD = 0.3, 80, 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(toxic_models.remainder("doc_id") != 2)
    scored = toxic_models.fit_score(docs, labels, "_score")
    return scored.where(F.col("_score") < TOXIC).drop("_score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row of a doc_id that is not the smallest of its group goes."""
    found = near(docs.select("doc_id", "text"), least=SIMILAR).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    flagged = decontaminate.flag(docs, table(spark, sf_dir, "benchmark"), "_items", least=HELD, min_words=1)
    return flagged.where(F.size("_items") == 0).drop("_items")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs, pii.fit(docs))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = merge_dropout.decode(merge_dropout.encode(docs, model, seed=6, dropout=0.1), model)
    return rows.withColumn("text", F.col("decoded")).drop("decoded")


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("personal_data", personal_data), ("sentencepiece", sentencepiece)]
#: The classifiers, the sampled walks and the ids cannot be put in SQL; tests/llm holds
#: every stage against a brute-force version of its decisions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
