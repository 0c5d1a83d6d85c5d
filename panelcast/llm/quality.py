"""Quality: Bradley-Terry ranking of documents from preference pairs, cut at a quantile of the scores."""

from __future__ import annotations

import math
import operator
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from panelcast.llm.labelled import labels_of
from panelcast.llm.logistic import fit_logistic, newton
from panelcast.llm.staging import staged
from panelcast.operators.normal_equations import moments

#: Documents of the other kind that each document of the more frequent kind is compared with.
OPPONENTS = 4
THRESHOLD = 0.7
SEED = 7
PENALTY, ROUNDS = 1.0, 15
#: Documents of the rarer kind that are sent to the tasks of the other; more are joined by their numbers.
FEW_ROWS = 2_000
SYMBOLS = re.compile(r"[^\w\s.,;:!?'\"()-]")
ENDED = re.compile(r"[.!?][\"')\]]?(?:\s|\Z)")

FEATURES = (
    "log_words", "mean_word", "long_words", "distinct_words", "adjacent_repeats", "top_word", "distinct_pairs", "top_pair",
    "upper_letters", "digits", "symbols", "symbol_words", "marks", "bars", "ended", "sentence_length", "capital_words",
    "lines", "repeated_lines", "letters", "bits_a_word", "distinct_letters", "short_text",
)


LETTER, UPPER, DIGIT, SYMBOL = 1, 2, 4, 8


@cache
def _kinds() -> np.ndarray:
    """What each character of the basic plane is; all others count as symbols."""
    return np.fromiter((
        LETTER * c.isalpha() | UPPER * c.isupper() | DIGIT * c.isdigit() | SYMBOL * bool(SYMBOLS.match(c))
        for c in map(chr, range(1 << 16))), np.uint8, 1 << 16)


def features(text: str | None) -> list[float]:
    """Shares and counts of a whole text that tell prose from junk; all zero without words."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(FEATURES)
    n, size = len(words), len(text)
    counts, pairs = Counter(words), Counter(map(hash, zip(words, words[1:])))
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.bincount(np.where(codes < 1 << 16, _kinds()[np.minimum(codes, (1 << 16) - 1)], SYMBOL), minlength=16)
    letters, upper, digits, symbols = (int(kinds[[k for k in range(16) if k & bit]].sum()) for bit in (LETTER, UPPER, DIGIT, SYMBOL))
    lines = [line for line in text.split("\n") if line.strip()]
    ended = len(ENDED.findall(text))
    often = np.fromiter(counts.values(), float, len(counts)) / n
    expected = math.log2(n) if n > 1 else 1.0
    long_words = capital = bare = 0
    for word, c in counts.items():
        long_words += c * (len(word) > 15)
        capital += c * word[0].isupper()
        if not word.isalpha():
            bare += c * (not any(map(str.isalnum, word)))
    return [
        math.log1p(n) / 10, letters / n / 10, long_words / n, len(counts) / n,
        sum(map(operator.eq, words, words[1:])) / n, float(often.max()), len(pairs) / n, max(pairs.values(), default=0) / n,
        upper / max(1, letters), digits / size, min(1.0, symbols / n), bare / n,
        min(1.0, text.count("!") / n), min(1.0, text.count("|") / n), min(1.0, ended / n), math.log1p(n / max(1, ended)) / 10,
        capital / n, min(1.0, len(lines) / n), 1 - len(set(lines)) / max(1, len(lines)), letters / size,
        float(-(often * np.log2(often)).sum()) / expected, len(set(text)) / 100, 1 / n,
    ]


@dataclass
class QualityModel:
    """Weights on standardised features, and the line that maps a Bradley-Terry strength to a score."""

    mean: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    spread: np.ndarray = field(default_factory=lambda: np.ones(len(FEATURES)))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(_width()))
    cut: float = 0.0
    scale: float = 1.0

    def strengths(self, rows: np.ndarray) -> np.ndarray:
        return _expanded((rows - self.mean) / self.spread) @ self.weights

    def scores(self, texts) -> np.ndarray:
        rows = np.array([features(t) for t in texts]).reshape(-1, len(FEATURES))
        line = (self.strengths(rows) - self.cut) * self.scale + math.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(line, -30, 30)))


def _width() -> int:
    return 3 * len(FEATURES)


def _expanded(z: np.ndarray) -> np.ndarray:
    """Standardised features, their squares and excesses, so that too much and too little both can count against a text."""
    z = np.clip(z, -6, 6)
    return np.hstack([z, z * z / 6, np.maximum(0, np.abs(z) - 2)])


def preferences(good: int, bad: int, opponents: int = OPPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of numbers of a good and a bad document: each of the more frequent kind meets ``opponents`` different ones of
    the other, in turn, so that every document takes part and those of a kind equally often, give or take one round."""
    many, few = max(good, bad), min(good, bad)
    rounds = np.repeat(np.arange(min(opponents, few)), many)
    own = np.tile(np.arange(many), min(opponents, few))
    other = (own + rounds) % few
    return (own, other) if good >= bad else (other, own)


def train(rows: np.ndarray, labels: np.ndarray, opponents: int = OPPONENTS, seed: int = SEED) -> QualityModel:
    """``trained`` on rows in memory.

    Strengths from preferences of a good document over a bad one, by the logistic loss on the differences of their
    features; all documents take part. The cut is the quantile of the strengths that leaves the share of good ones above it."""
    model = QualityModel()
    good, bad = rows[labels == 1], rows[labels == 0]
    if not len(good) or not len(bad):
        return model
    rng = np.random.default_rng(seed)
    model.mean, model.spread = rows.mean(axis=0), rows.std(axis=0) + 1e-3
    spread = lambda x: _expanded((x - model.mean) / model.spread)
    first, second = preferences(len(good), len(bad), opponents)
    differences = spread(rng.permutation(good))[first] - spread(rng.permutation(bad))[second]
    sign = rng.integers(0, 2, len(first)) * 2 - 1  # either order of a pair
    model.weights = fit_logistic(differences * sign[:, None], (sign > 0).astype(float), penalty=PENALTY, rounds=ROUNDS, intercept=False)[1:]
    strengths = model.strengths(rows)
    model.cut = float(np.quantile(strengths, (labels == 0).mean()))
    above, below = strengths[labels == 1], strengths[labels == 0]
    model.scale = 2.0 / max(1e-3, float(np.median(above) - np.median(below)) / 2)
    return model


def _numbered(rows: DataFrame, *order: str) -> tuple[DataFrame, dict[str, int]]:
    """Rows with their ``number`` from 0 within their ``kind`` in an order, and how many each kind has.

    The sort leaves the rows of a kind in a partition one after the other, so the driver needs only counts by partition and kind.
    """
    laid = staged(rows.sort("kind", *order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33)  # the partition's number is in the upper bits
    found = laid.groupBy("kind", part.alias("part")).agg(F.min("_at").alias("first"), F.count("kind").alias("n")).collect()
    sizes, shifts = Counter(), []
    for kind, at, first, n in sorted(found):
        shifts.append((kind, at, sizes[kind] - first))
        sizes[kind] += n
    shift = rows.sparkSession.createDataFrame(shifts, "kind string, _part long, _shift long")
    joined = laid.withColumn("_part", part).join(F.broadcast(shift), ["kind", "_part"])
    return joined.withColumn("number", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift"), dict(sizes)


def _pairs(numbered: DataFrame, good: int, bad: int, opponents: int = OPPONENTS) -> DataFrame:
    """The ``preferences`` of all numbered rows, as the features of the ``better`` and the ``worse`` document."""
    many, few = ("1", "0") if good >= bad else ("0", "1")
    names, n_few = (("better", "worse") if good >= bad else ("worse", "better")), min(good, bad)
    rounds = F.explode(F.sequence(F.lit(0), F.lit(min(opponents, n_few) - 1))).alias("_round")
    own = numbered.where(F.col("kind") == many).select("number", F.col("x").alias(names[0]), rounds)
    other = numbered.where(F.col("kind") == few).select(F.col("number").alias("_other"), F.col("x").alias(names[1]))
    own = own.withColumn("_other", (F.col("number") + F.col("_round")) % n_few)
    # A row of the rarer kind meets many / few of a round: few of them are no keys to shuffle by.
    return staged(own.join(F.broadcast(other) if n_few <= FEW_ROWS else other.hint("merge"), "_other").select("better", "worse"), "pairs")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), len(FEATURES))


def _sums(pairs: DataFrame, model: QualityModel, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slope and curve of the logistic loss over all pairs: one state per task, added in the order of the tasks."""
    mean, spread, width = model.mean, model.spread, len(weights)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slope, curve = np.zeros(width), np.zeros((width, width))
        for batch in batches:
            better, worse = (_expanded((_matrix(batch.column(i)) - mean) / spread) for i in (0, 1))
            gap = better - worse
            chance = 1 / (1 + np.exp(-np.clip(gap @ weights, -30, 30)))
            slope += gap.T @ (chance - 1)
            curve += (gap * (chance * (1 - chance))[:, None]).T @ gap
        both = np.concatenate([slope, curve.ravel()])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(len(both))), pa.array(np.full(len(both), TaskContext.get().partitionId(), np.int64)), pa.array(both)],
            names=["at", "part", "value"])

    states = F.array_sort(F.collect_list(F.struct("part", "value")))
    total = F.aggregate(states, F.lit(0.0), lambda acc, s: acc + s["value"])
    rows = pairs.mapInArrow(partial, "at long, part long, value double").groupBy("at").agg(total.alias("value")).collect()
    both = np.zeros(width + width * width)
    for at, value in rows:
        both[at] = value
    return both[:width], both[width:].reshape(width, width)


def _quantiles(rows: DataFrame, wanted: dict[str, float]) -> dict[str, float]:
    """The quantile of ``strength`` that is wanted of each kind, exact, between two rows in proportion."""
    numbered, sizes = _numbered(rows, "strength")
    places = {kind: share * (sizes[kind] - 1) for kind, share in wanted.items()}
    either = [F.col("kind").eqNullSafe(kind) & F.col("number").isin(math.floor(p), math.ceil(p)) for kind, p in places.items()]
    found = {(r["kind"], r["number"]): r["strength"] for r in numbered.where(reduce(operator.or_, either)).collect()}
    out = {}
    for kind, p in places.items():
        low, high = found[kind, math.floor(p)], found[kind, math.ceil(p)]
        out[kind] = low + (high - low) * (p - math.floor(p))
    return out


def trained(rows: DataFrame, opponents: int = OPPONENTS) -> QualityModel:
    """Strengths from preferences of a good document over a bad one, by the logistic loss on the differences of their
    features, and the cut at the quantile that leaves the share of good ones above it.

    ``rows`` has every document's ``label``, features ``x`` and ``place`` in an order that knows nothing of either. All of
    them give the means, the pairs, the slopes and the quantiles, in tasks; the driver gets sums. Weights are kept to nine
    decimals, so that the order of additions does not show.
    """
    model = QualityModel()
    rows = rows.withColumn("kind", F.col("label").cast("string"))
    numbered, sizes = _numbered(rows.select("kind", "place", "x"), "place", "x")
    good, bad, n = sizes.get("1", 0), sizes.get("0", 0), sum(sizes.values())
    if not good or not bad:
        return model
    state = moments(rows.withColumn("_all", F.lit(0)), "_all", "x", "label", len(FEATURES) + 1)[0]
    model.mean, model.spread = state.mean[:-1], np.sqrt(np.diag(state.scatter)[:-1] / state.n) + 1e-3
    pairs, width = _pairs(numbered, good, bad, opponents), _width()
    weights = newton(lambda w: _sums(pairs, model, w), np.zeros(width), np.zeros(width, bool), np.full(width, PENALTY), ROUNDS)
    model.weights = np.round(weights, 9)

    def strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.strengths(_matrix(batch.column(1))))], names=["kind", "strength"])

    strong = rows.select("kind", "x").mapInArrow(strengths, "kind string, strength double")
    strong = strong.select(F.explode(F.array(F.lit("all"), "kind")).alias("kind"), "strength")
    found = _quantiles(strong, {"all": bad / n, "1": 0.5, "0": 0.5})
    model.cut = round(found["all"], 9)
    model.scale = 2.0 / max(1e-3, round(found["1"] - found["0"], 9) / 2)
    return model


def fit(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> QualityModel:
    """Learn from all labelled documents that ``training`` allows. Without labels of both kinds every text scores alike.

    Labels may be as many as documents, so neither side is broadcast. Features are made before the join: a shuffle of them
    takes some 200 bytes a document, one of the texts their whole size.
    """
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).where("_id is not null and text is not null")
    schema = StructType([texts.schema["_id"], StructField("x", ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["_id", "x"])

    found = texts.mapInArrow(run, schema).join(labels_of(labels, training, "quality", id_col).hint("merge"), "_id")
    return trained(staged(found.select("x", F.col("label").cast("long").alias("label"), F.xxhash64("_id").alias("place")), "labelled"))


def scored(docs: DataFrame, model: QualityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for each whole text; ``THRESHOLD`` is the cut between good and bad.

    Null texts and texts without words score as a text whose features are all zero. Very long texts are read whole. Rows
    that repeat score alike, and an empty table stays empty. A column that already has the score's name is replaced; all
    others stay.
    """
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts))

    return docs.withColumn(score_col, score(F.col(text_col).cast("string")))
