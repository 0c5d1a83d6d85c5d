"""From raw documents to packed training sequences: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelcast.llm import minhash, mixing, packing, pii, toxicity
from panelcast.llm.labelled import remainder
from panelcast.llm.queries import surrogate_key, vocabulary
from panelcast.llm.staging import fresh, ship, staged, table

ORACLE_SQL = None  # learned scores, keyed surrogates and token ids have no SQL; a test compares with a brute-force version


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not call toxic: null, empty and repeated rows are scored like others, all columns
    stay, an empty table stays empty."""
    ship(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), remainder(F.col("doc_id"), 5) > 0)
    (score,) = fresh(docs, "toxicity")
    return toxicity.scored(docs, model, score_col=score).where(F.col(score) < 0.5).drop(score)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates, the one with the smallest id; see ``keep_one`` for null and repeated ids."""
    ship(spark)
    return minhash.keep_one(docs, minhash.NearDuplicates())


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; ``n_chars`` follows the text. Rows and other columns stay as they are."""
    ship(spark)
    (mentions,) = fresh(docs, "mentions")
    changed = pii.pseudonymise(docs, surrogate_key(spark), count_col=mentions)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.col(mentions) > 0, F.length("text")).otherwise(F.col("n_chars"))
                                     .cast(docs.schema["n_chars"].dataType))
    return changed.drop(mentions)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them; a document at a cut gives its first words. Texts
    without words are left out; see ``mixing.repeated``."""
    return mixing.repeated(docs, mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and the sequences they are in; see ``packing.pack``."""
    ship(spark)
    return packing.pack(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("near_duplicates", keep_one_of_each_group),
    ("personal_data", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
