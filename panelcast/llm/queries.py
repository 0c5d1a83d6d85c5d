"""The registered queries of these operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelcast.llm import (conversation_repair, embed_dedup, language, language_model, minhash, mixing, packing, pii, quality, secret_scan,
                           spelling, sql, topk, toxicity)
from panelcast.llm.labelled import remainder
from panelcast.llm.staging import ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return function
    return register


def vocabulary() -> str:
    """The file of the tokenizer that packing and language models use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def surrogate_key(spark: SparkSession) -> str:
    """The secret of the session's owner; the given tables are no secret and have a key that is none."""
    return spark.conf.get("spark.panelcast.surrogateKey", "public key of the given tables")


@query("op1_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, place = table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 5)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), place > 0)
    return (toxicity.scored(docs.select("doc_id", "text"), model)
            .select("doc_id", (place == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


@query("op3_language")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, place = table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 3)
    model = language.fit(docs, (place != 1) & (place >= 0))
    return (language.labelled(docs.select("doc_id", "text"), model)
            .select("doc_id", (place == 1).alias("held_out"), "lang_pred", "score"))


@query("op4_mixing", sql.MIXING)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


@query("op5_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), surrogate_key(spark), count_col="n_entities")


@query("op6_lm_scoring")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against conversations as the target; the background is the documents themselves."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    models = language_model.learn(table(spark, sf_dir, "conversations"), docs, vocabulary())
    return language_model.scored(docs, models, vocabulary(), keep_text=False)


@query("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, place = table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 4)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), (place != 2) & (place >= 0))
    return (quality.scored(docs.select("doc_id", "text"), model)
            .select("doc_id", (place == 2).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")))


@query("op8_minhash_dedup", sql.NEAR_DUPLICATES)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.NearDuplicates().classify(table(spark, sf_dir, "documents"))


@query("op9_topk", sql.TOPK)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


@query("op10_embedding_dedup", sql.EMBEDDING_DEDUP)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op11_spelling_variants", sql.SPELLING_VARIANTS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query("op12_conversation_repair", sql.CONVERSATION_REPAIR)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair(rows).withColumnRenamed("conv", "conv_id")


@query("op13_secret_scans")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.with_secrets(docs, secret_scan.word_bits(docs))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, secret_scan.KINDS), F.sha2(secret_scan.listed("secrets", secret_scan.KINDS[:3]), 256).alias("base_sha256"),
        secret_scan.listed("secrets").alias("spans"), F.array_max(F.transform("secrets", lambda s: s["bits"])).alias("most_bits"))
