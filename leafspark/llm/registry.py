"""Queries of the corpus operators, with production parameters, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafspark.llm import hash_search, kd_shards, near_dedup, oracles, packing, pii, pu_quality, quality_rules, repeats, soft_mixing, store, token_file

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def settled(q: Query) -> Query:
    """The query's result as a written table, and what it cut on its way deleted."""

    @wraps(q)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with store.scratch(spark):
            return store.cut(q(spark, sf_dir), q.__name__, keep=True)

    return run


@settled
def op1_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = pu_quality.featured(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels").filter(~pu_quality.held_out("doc_id"))
    model = pu_quality.fit(features, labels)
    return pu_quality.scored(features, model).select(
        "doc_id",
        F.coalesce(pu_quality.held_out("doc_id"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@settled
def op2_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tokens = packing.tokenized(docs, tokenizer("word_bpe_49k.json"), "dropped", end_id=2)
    packed = packing.pack(tokens)
    digests = packed.pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return digests.join(packed.places, ["row", "start"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op3_odd_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    like = near_dedup.Similarity(width=3, percent=85)
    return near_dedup.grouped(table(spark, sf_dir, "documents"), like)


def op4_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hash_search.search(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


def op5_pii_boosted_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detected(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)],
        F.sha2(pii.written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
    )


def op6_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.placed(table(spark, sf_dir, "documents"), shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@settled
def op7_interval_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.removed(table(spark, sf_dir, "documents"), length=50)
    out = store.cut(repeats.digests(found), "digests")
    found.close()
    return out


#: Domains of the labelled table, and the share of tokens that each shall have.
MIX = {"good": 0.97, "poor": 0.02, "toxic": 0.01}


def labelled_domains(labels: DataFrame) -> DataFrame:
    toxic, poor = F.col("toxic") == 1, F.col("quality") == 0
    domain = F.when(toxic, "toxic").when(poor, "poor").when(F.col("quality") == 1, "good")
    return labels.select("doc_id", domain.alias("domain"))


@settled
def op8_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = soft_mixing.train(docs, labelled_domains(labels), list(MIX))
    members = soft_mixing.memberships(docs, model)
    out = soft_mixing.rated(members, soft_mixing.fit_rates(members, list(MIX.values())))
    return out.select(
        "doc_id", "tokens", *[F.get("p", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(MIX)], "rate", "copies"
    )


def op9_addressable_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = store.new_path(spark, "token-file")
    docs = table(spark, sf_dir, "documents")
    token_file.write_tokens(docs, path, tokenizer("byte_bpe_50k.json"), "glued", end_id=2)
    return token_file.read_tokens(spark, path).select(
        "doc_id",
        "start",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op10_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents")).drop("rejected_by")


def queries() -> dict[str, Query]:
    return {
        "op1_pu_quality": op1_pu_quality,
        "op2_nnls_packing": op2_nnls_packing,
        "op3_odd_sketch_dedup": op3_odd_sketch_dedup,
        "op4_multi_index_hashing": op4_multi_index_hashing,
        "op5_pii_boosted_spans": op5_pii_boosted_spans,
        "op6_kd_shards": op6_kd_shards,
        "op7_interval_tree_dedup": op7_interval_tree_dedup,
        "op8_soft_mixing": op8_soft_mixing,
        "op9_addressable_tokens": op9_addressable_tokens,
        "op10_quality_cascade": op10_quality_cascade,
    }


def oracle_sql() -> dict[str, str]:
    """The others learn models, tokenize, search approximately or are far too slow in SQL: tests compare them."""
    return {"op3_odd_sketch_dedup": oracles.NEAR_DEDUP, "op10_quality_cascade": oracles.QUALITY_RULES}
