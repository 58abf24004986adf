"""The corpus pipeline: documents to packed token sequences, in five stages, each written and read again.

Every stage takes all rows that its predecessor kept. The first four return the columns of documents: quality
rules drop rows, near-duplicates leave one row a group, personal data is replaced in the text, and mixing
drops rows. The last returns the pieces of packed sequences.

Defined cases: a null or empty text fails the quality rules; very long texts are read whole; repeated rows are
one group of near-duplicates, of which the rows of the least id stay; rows without an id link with nothing; an
empty table, or one of which a stage keeps nothing, gives an empty result; further columns pass through the first
four stages, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafspark.llm import near_dedup, packing, pii, quality_rules, registry, soft_mixing, store

#: Shares of tokens of the domains of the labelled table. Documents likeliest of the first stay as they are; shares
#: of the others are upper bounds, so poor and toxic text shrinks where there is more of it, and nothing else does.
MIX = {"good": 0.989, "poor": 0.01, "toxic": 0.001}

#: Words that a worker keeps while it tokenizes: after four other stages the executor has less memory left.
CACHE_WORDS = 400_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.cascade(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicated(docs, near_dedup.Similarity(width=5, percent=80))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = registry.labelled_domains(registry.table(spark, sf_dir, "labels"))
    model = soft_mixing.train(docs, labels, list(MIX))
    if model.weights is None:  # labels of fewer than two domains tell no document from another
        return docs
    members = soft_mixing.memberships(docs, model, carry=True)
    return soft_mixing.mixed(members, soft_mixing.fit_rates(members, list(MIX.values()), keep="first"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tokens = packing.tokenized(docs, registry.tokenizer("word_bpe_49k.json"), "dropped", end_id=2, cache_words=CACHE_WORDS)
    return packing.pack(tokens).sequences()


STAGES = [("quality", quality), ("near_dedup", dedup), ("pii", redact), ("mixing", mix), ("packing", pack)]

#: MinHash, boosted trees, a trained classifier and a tokenizer are not SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with store.scratch(spark):  # what stages leave goes when the last one is written
        for name, stage in STAGES:
            docs = store.cut(stage(spark, docs, sf_dir), name, keep=name == STAGES[-1][0])
    return docs
