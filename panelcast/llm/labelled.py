"""Held-out rows, labels to learn from, and bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelcast.llm.staging import staged

SAMPLE_ROWS = 12_000


def remainder(id_col: Column, modulus: int) -> Column:
    """crc32 of an id as text, modulo ``modulus``; -1 for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % modulus, F.lit(-1))


def labels_of(labels: DataFrame, training: Column, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """All ids that may be learned from, once each, with their largest label."""
    return (labels.where(training & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
            .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("label")))


def labelled_sample(docs: DataFrame, labels: DataFrame, training: Column, label_col: str, limit: int = SAMPLE_ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """At most ``limit`` labelled documents for a fit, the first in the order of a hash of the id, as ``text`` and ``label``.

    ``training`` says on the labels which ids may be learned from. Null labels, ids and texts are left out. A repeated
    id has its largest label. The ids are few by that bound, so they go to the documents, not the texts to them.
    """
    rows = labels_of(labels, training, label_col, id_col).orderBy(F.xxhash64("_id"), "_id").limit(limit)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    return staged(texts.join(F.broadcast(rows), "_id").where("text is not null").select("text", "label"), "labelled")
