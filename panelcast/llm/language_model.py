"""Cross-entropy difference of two n-gram models with one vocabulary."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelcast.llm.packing import Tokenizer
from panelcast.llm.staging import fresh, staged

VOCABULARY = 50_257
MAX_PAIRS = 1_000_000
STRENGTH = 20.0
FLUSH_PAIRS = 2_000_000


def _pairs(ids: np.ndarray) -> np.ndarray:
    """Each token with the one before it; the first has a start mark before it."""
    before = np.concatenate([[VOCABULARY], ids[:-1]])
    return before * (VOCABULARY + 1) + ids


def count_pairs(texts: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """``pair`` and ``n`` over whole texts, summed in each task before the shuffle. Null and empty texts have none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer.load(vocabulary)
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = [np.frombuffer(tokenizer.encode(t), "<u4").astype(np.int64) for t in batch.column(0)[at:at + 1000].to_pylist()]
                new, often = np.unique(np.concatenate([np.zeros(0, np.int64), *(_pairs(r) for r in rows if len(r))]), return_counts=True)
                both, place = np.unique(np.concatenate([keys, new]), return_inverse=True)
                keys, counts = both, np.bincount(place, np.concatenate([counts, often]), len(both)).astype(np.int64)
                if len(keys) > FLUSH_PAIRS:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["pair", "n"])
                    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["pair", "n"])

    return (texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")))


@dataclass
class MatchedModels:
    """Two models over the same pairs and tokens; the second axis is target, background.

    ``pairs`` and ``counts`` are the most frequent pairs, which tasks hold. ``rest`` is a table of all other counted pairs
    with what each takes off the losses that it has as an unseen pair; ``contexts`` and ``tokens`` are of all pairs.
    """

    pairs: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    tokens: np.ndarray
    rest: DataFrame | None = None

    def losses(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Negative log probability of every token under either model, its pair, and whether that is held; others count as unseen."""
        keys = _pairs(ids)
        at = np.minimum(np.searchsorted(self.pairs, keys), max(0, len(self.pairs) - 1))
        found = self.pairs[at] == keys if len(self.pairs) else np.zeros(len(ids), bool)
        seen = self.counts[at] * found[:, None] if len(self.pairs) else np.zeros((len(ids), 2))
        before = self.contexts[keys // (VOCABULARY + 1)]
        return -np.log((seen + STRENGTH * self.tokens[ids]) / (before + STRENGTH)), keys, found

    def total(self, ids: np.ndarray, block: int = 1 << 16) -> np.ndarray:
        """The sums of both losses; a long text is read in blocks, each with the token before it."""
        return self.split(ids, block)[0]

    def split(self, ids: np.ndarray, block: int = 1 << 16) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The sums of both losses, and the pairs that are not held with how often each occurs."""
        out, missing = np.zeros(2), [np.zeros(0, np.int64)]
        for at in range(0, len(ids), block):
            first = max(0, at - 1)
            losses, keys, found = (x[at - first:] for x in self.losses(ids[first:at + block]))
            out += losses.sum(axis=0)
            missing.append(keys[~found])
        return out, *np.unique(np.concatenate(missing), return_counts=True)


def learn(target: DataFrame, background: DataFrame, vocabulary: str, text_col: str = "text", max_pairs: int = MAX_PAIRS) -> MatchedModels:
    """Bigram models of two corpora, counted over all their texts.

    The vocabulary is the tokenizer's, so no token is unknown. Background counts are scaled to the target's number of
    tokens, and both models lean on their token frequencies with the same strength, so that neither gains by its size.
    Both keep all counted pairs. Those above the least count that leaves ``max_pairs`` or fewer are held by the tasks that
    score; that count is found from a histogram. The others stay a table, which scoring joins with the pairs of texts. So
    ``max_pairs`` bounds the memory of a task and changes no score.
    """
    both = (count_pairs(target, vocabulary, text_col).select("pair", F.col("n").alias("target"), F.lit(0).cast("long").alias("background"))
            .union(count_pairs(background, vocabulary, text_col).select("pair", F.lit(0).cast("long"), "n")))
    counts = staged(both.groupBy("pair").agg(F.sum("target").alias("target"), F.sum("background").alias("background")), "pairs")
    token = counts.groupBy((F.col("pair") % (VOCABULARY + 1)).alias("token")).agg(F.sum("target").alias("target"), F.sum("background").alias("background"))
    totals = token.toPandas()
    size = totals[["target", "background"]].sum().to_numpy(float)
    scale = np.array([1.0, size[0] / size[1] if size[1] and size[0] else 1.0])
    tokens = np.ones((VOCABULARY, 2))
    tokens[totals["token"].to_numpy(int)] += totals[["target", "background"]].to_numpy(float) * scale
    tokens /= tokens.sum(axis=0)

    amount = F.col("target") + F.col("background")
    bins = counts.groupBy(F.floor(F.log2(amount.cast("double")) * 8).alias("bin")).count().orderBy(F.desc("bin")).collect()
    least, kept = None, 0
    for row in bins:
        kept += row["count"]
        if kept > max_pairs:
            break
        least = row["bin"]
    is_held = F.lit(False) if least is None else F.floor(F.log2(amount.cast("double")) * 8) >= least
    table = counts.where(is_held).toPandas().sort_values("pair")
    pairs, seen = table["pair"].to_numpy(np.int64), table[["target", "background"]].to_numpy(float) * scale
    before = (counts.groupBy(F.floor(F.col("pair") / F.lit(VOCABULARY + 1)).alias("before"))
              .agg(F.sum("target").alias("target"), F.sum("background").alias("background")).toPandas())
    contexts = np.zeros((VOCABULARY + 1, 2))
    contexts[before["before"].to_numpy(int)] = before[["target", "background"]].to_numpy(float) * scale

    def gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, seen = batch.column(0).to_numpy(), np.stack([batch.column(1).to_numpy(), batch.column(2).to_numpy()], axis=1) * scale
            gain = np.log1p(seen.astype(np.float32) / (STRENGTH * tokens[keys % (VOCABULARY + 1)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(gain[:, 0]), pa.array(gain[:, 1])], names=["pair", "target_gain", "background_gain"])

    rest = counts.where(~is_held).select("pair", "target", "background").mapInArrow(gains, "pair long, target_gain double, background_gain double")
    return MatchedModels(pairs, seen.astype(np.float32), contexts, tokens, rest)


def scored(docs: DataFrame, models: MatchedModels, vocabulary: str, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens``, ``target_loss``, ``background_loss`` (means per token) and ``score``, their difference.

    A low score says that a text is more like the target than like the background. Null and empty texts have no tokens
    and zeros. Columns that already have these names are replaced. Every row is scored by itself, whatever its id. Pairs
    that tasks do not hold are taken out once per text and joined with ``models.rest``. The rows are written on the way,
    without the text unless ``keep_text``. Very long texts are read whole, in blocks; an empty table stays empty; all other
    columns stay, whatever their names.
    """
    held = replace(models, rest=None)

    @F.pandas_udf("n_tokens long, target_loss double, background_loss double, pairs array<long>, times array<long>")
    def score(texts: pd.Series) -> pd.DataFrame:
        tokenizer, out = Tokenizer.load(vocabulary), []
        for text in texts:
            ids = np.frombuffer(tokenizer.encode(text), "<u4").astype(np.int64)
            sums, pairs, times = held.split(ids)
            out.append((len(ids), *sums, pairs, times))
        return pd.DataFrame(out, columns=["n_tokens", "target_loss", "background_loss", "pairs", "times"])

    row, losses, one, target, background = fresh(docs, "row", "losses", "one", "target", "background")
    rows = docs.withColumns({row: F.monotonically_increasing_id(), losses: score(F.col(text_col).cast("string"))})
    rows = staged(rows if keep_text else rows.drop(text_col), "losses")
    missing = (rows.select(row, F.explode(F.arrays_zip(F.col(f"{losses}.pairs").alias("pair"), F.col(f"{losses}.times").alias("times"))).alias(one))
               .select(row, f"{one}.pair", f"{one}.times"))
    gained = (missing.join(models.rest, "pair").groupBy(row)
              .agg(F.sum(F.col("times") * F.col("target_gain")).alias(target), F.sum(F.col("times") * F.col("background_gain")).alias(background)))
    tokens = F.greatest(F.col(f"{losses}.n_tokens"), F.lit(1))
    rows = rows.join(gained, row, "left").withColumns({
        target: (F.col(f"{losses}.target_loss") - F.coalesce(target, F.lit(0.0))) / tokens,
        background: (F.col(f"{losses}.background_loss") - F.coalesce(background, F.lit(0.0))) / tokens})
    return rows.withColumns({"n_tokens": F.col(f"{losses}.n_tokens"), "target_loss": F.col(target), "background_loss": F.col(background),
                             "score": F.col(target) - F.col(background)}).drop(row, losses, target, background)
