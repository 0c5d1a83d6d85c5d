"""Language of words in code-switched text: a linear-chain conditional random field, read by forward-backward."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelcast.llm.staging import fresh, staged

WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
BUCKETS = 1 << 17
GRAMS = (2, 3, 4)
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
LEXICON_COUNT = 5
LEXICON_SHARE = 0.9
SAMPLE_DOCUMENTS = 2_000
SHARES = 64
GROUP_LIMIT = 1_000  # the largest rank that Spark filters before a shuffle
SURPLUS = 2
RUNS = 12
RUN_WORDS = 48
SEQUENCES = 3_000
SEQUENCE_WORDS = 64
EPOCHS = 3
BATCH = 64
RATE = 0.2
BLOCK = 512
GROUP_NUMBERS = 1 << 20
SLICE_CHARACTERS = 4_000_000
SEED = 3


def buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words in a row, and the word each belongs to.

    A word's features are its n-grams with its ends marked, so those at an end are its affixes, and the word itself.
    """
    codes = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), lengths)
    ends = lengths.cumsum()
    left = np.repeat(ends, lengths) - np.arange(len(codes))  # characters up to the word's end
    found, owners = [], []
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        hashed = np.full(len(at), n, np.uint64)
        for i in range(n):
            hashed += codes[at + i] * FACTORS[i]
            hashed ^= hashed >> np.uint64(29)
            hashed *= FACTORS[3 - i % 4]
        found.append(hashed)
        owners.append(owner[at])
    spread = codes * FACTORS[0]
    spread = (spread ^ (spread >> np.uint64(31))) * (2 * left.astype(np.uint64) + np.uint64(1)) * FACTORS[1]
    if len(words):
        found.append(np.add.reduceat(spread, ends - lengths))
        owners.append(np.arange(len(words)))
    hashed = np.concatenate(found) if found else np.zeros(0, np.uint64)
    hashed = (hashed ^ (hashed >> np.uint64(32))) * FACTORS[2]
    return (hashed >> np.uint64(64 - 17)).astype(np.int64), np.concatenate(owners)


@dataclass
class LanguageModel:
    """Languages in order, weights of features and transitions, and the words typical of one language."""

    languages: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, 0), np.float32))
    lexicon: dict[str, int] = field(default_factory=dict)
    lexicon_weight: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    transitions: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def emissions(self, words: list[str]) -> np.ndarray:
        """A row of language scores for each word."""
        at, owner = buckets(words)
        count = len(self.languages)
        out = np.stack([np.bincount(owner, self.weights[at, k], len(words)) for k in range(count)], axis=1) if words else np.zeros((0, count))
        typical = np.fromiter((self.lexicon.get(w, -1) for w in words), np.int64, len(words))
        known = typical >= 0
        out[known] += self.lexicon_weight[typical[known]]
        return out

    def marginals(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Posterior of every word, given its whole text; ``scores`` holds the words of all texts in a row.

        Texts are cut into blocks of ``BLOCK`` words that are read side by side. What a block passes on is a matrix; along the
        blocks of a text these give the messages that enter each of them from both sides, so the result is that of one piece.
        """
        if not len(scores):
            return scores
        begins = lengths.cumsum() - lengths
        counts = -(-lengths // BLOCK)
        text = np.repeat(np.arange(len(lengths)), counts)
        place = np.arange(len(text)) - np.repeat(counts.cumsum() - counts, counts)
        first = begins[text] + place * BLOCK
        sizes = np.minimum(lengths[text] - place * BLOCK, BLOCK)
        labels = len(self.start)
        entering = np.tile(np.exp(self.start - self.start.max()), (len(text), 1))
        leaving = np.full((len(text), labels), 1 / labels)
        out = np.zeros_like(scores)

        def groups(chosen: np.ndarray, cells: int):
            """Blocks of like length together, as many as have ``cells`` numbers each in ``GROUP_NUMBERS``."""
            order = chosen[np.argsort(sizes[chosen], kind="stable")]
            for group in np.array_split(order, min(len(order), -(-len(order) * cells // GROUP_NUMBERS))):
                steps = np.arange(sizes[group].max())
                there = steps[None, :] < sizes[group][:, None]
                yield group, there, np.where(there, first[group][:, None] + steps, 0)

        parted = np.flatnonzero(counts[text] > 1)
        if len(parted):
            move = np.exp(self.transitions)
            passed = np.zeros((len(text), labels, labels))
            for group, there, index in groups(parted, max(BLOCK * labels, labels * labels)):
                passed[group] = passage(scores[index], there, move)
            for b in parted:  # in the order of a text's words
                if place[b]:
                    entering[b] = _unit(_unit(entering[b - 1] @ passed[b - 1]) @ move)
            for b in parted[::-1]:
                if place[b] < counts[text[b]] - 1:
                    leaving[b] = _unit(move @ _unit(passed[b + 1] @ leaving[b + 1]))
        for group, there, index in groups(np.arange(len(text)), BLOCK * labels):
            posterior = forward_backward(scores[index], there, self.transitions, entering[group], leaving[group])[0]
            out[index[there]] = posterior[there]
        return out

    def predict(self, texts) -> tuple[list[str], list[float]]:
        """The language with the largest share of a text's words, and that share."""
        names, shares, waiting, size = [], [], [], 0
        for text in texts:
            waiting.append(text)
            size += len(text or "")
            if size > SLICE_CHARACTERS:
                self._slice(waiting, names, shares)
                waiting, size = [], 0
        self._slice(waiting, names, shares)
        return names, shares

    def _slice(self, texts: list, names: list, shares: list) -> None:
        found = [WORD.findall((text or "").lower()) for text in texts]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        if not self.languages or not lengths.sum():
            names += [UNKNOWN] * len(texts)
            shares += [0.0] * len(texts)
            return
        codes, distinct = pd.factorize(np.array([w for words in found for w in words], object))
        posterior = self.marginals(self.emissions(list(distinct))[codes], lengths)
        some = np.flatnonzero(lengths)
        starts = (lengths.cumsum() - lengths)[some]
        share = np.add.reduceat(posterior, starts, axis=0) / lengths[some][:, None]
        best = np.full(len(texts), -1)
        best[some] = share.argmax(axis=1)
        top = np.zeros(len(texts))
        top[some] = np.clip(share.max(axis=1), 0, 1)
        names += [UNKNOWN if k < 0 else self.languages[k] for k in best]
        shares += top.tolist()


def _unit(message: np.ndarray) -> np.ndarray:
    return message / message.sum()


def passage(scores: np.ndarray, there: np.ndarray, move: np.ndarray) -> np.ndarray:
    """For each run of words the matrix from a message at its first word to one at its last, up to a factor."""
    emitted = np.exp(scores - scores.max(axis=2, keepdims=True))
    now = np.eye(len(move)) * emitted[:, 0, None, :]
    for t in range(1, scores.shape[1]):
        further = (now @ move) * emitted[:, t, None, :]
        further /= further.max(axis=(1, 2), keepdims=True)
        now = np.where(there[:, t, None, None], further, now)
    return now


def forward_backward(scores: np.ndarray, there: np.ndarray, transitions: np.ndarray, entering: np.ndarray,
                     leaving: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors (text, word, label), and posteriors of neighbouring labels summed over all words; sums are scaled at each step.

    ``entering`` weighs the labels of the first words and ``leaving`` what follows the last ones, alike for all texts or a
    row for each; nothing follows by default.
    """
    texts, steps, labels = scores.shape
    emitted = np.exp(scores - scores.max(axis=2, keepdims=True))
    move = np.exp(transitions)
    forward, backward = np.empty_like(emitted), np.empty_like(emitted)
    now = entering * emitted[:, 0]
    forward[:, 0] = now / now.sum(axis=1, keepdims=True)
    for t in range(1, steps):
        now = (forward[:, t - 1] @ move) * emitted[:, t]
        forward[:, t] = now / now.sum(axis=1, keepdims=True)
    last = np.broadcast_to(1 / labels if leaving is None else leaving, (texts, labels))
    backward[:, steps - 1] = now = last
    for t in range(steps - 2, -1, -1):
        now = (backward[:, t + 1] * emitted[:, t + 1]) @ move.T
        now /= now.sum(axis=1, keepdims=True)
        now = np.where(there[:, t + 1, None], now, last)
        backward[:, t] = now
    posterior = forward * backward
    posterior /= posterior.sum(axis=2, keepdims=True)
    onward = backward[:, 1:] * emitted[:, 1:]
    pair = forward[:, :-1, :, None] * move[None, None] * onward[:, :, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    return posterior, (pair * there[:, 1:, None, None]).sum(axis=(0, 1)) if steps > 1 else np.zeros((labels, labels))


def train(texts: list[list[str]], labels: list[str], lexicon: dict[str, str] | None = None, seed: int = SEED) -> LanguageModel:
    """Maximise the likelihood of label sequences by adaptive gradient steps.

    A training sequence is spliced from runs of words of different documents, each word labelled with its document's
    language: that is where the model learns to switch. Documents without words teach nothing. ``lexicon`` gives the words
    that are typical of one language.
    """
    kept = [(words, label) for words, label in zip(texts, labels) if words]
    model = LanguageModel(sorted({label for _, label in kept}))
    count = len(model.languages)
    if not count:
        return model
    number = {name: k for k, name in enumerate(model.languages)}
    rng = np.random.default_rng(seed)
    model.lexicon = {w: number[name] for w, name in sorted((lexicon or {}).items()) if name in number}
    sequences, targets = [], []
    for _ in range(SEQUENCES):
        words: list[str] = []
        marks: list[int] = []
        while len(words) < SEQUENCE_WORDS:
            source, label = kept[rng.integers(len(kept))]
            length = int(rng.integers(8, 48))
            at = int(rng.integers(0, max(1, len(source) - length)))
            run = source[at:at + length]
            words += run
            marks += [number[label]] * len(run)
        sequences.append(words[:SEQUENCE_WORDS])
        targets.append(marks[:SEQUENCE_WORDS])
    codes, distinct = pd.factorize(np.array([w for s in sequences for w in s], object))
    codes, targets = codes.reshape(SEQUENCES, SEQUENCE_WORDS), np.array(targets)
    distinct = list(distinct)
    at, owner = buckets(distinct)
    order = np.argsort(owner, kind="stable")
    at, begins = at[order], np.searchsorted(owner[order], np.arange(len(distinct) + 1))
    typical = np.array([model.lexicon.get(w, -1) for w in distinct])
    # weights of buckets, then of the lexicon, then the transitions and the start
    weights = np.zeros((BUCKETS + count, count))
    seen = np.full(weights.shape, 1e-3)
    chain, chain_seen = np.zeros((count + 1, count)), np.full((count + 1, count), 1e-3)
    there = np.ones((BATCH, SEQUENCE_WORDS), bool)
    one_hot = np.eye(count)
    for _ in range(EPOCHS):
        shuffled = rng.permutation(SEQUENCES)
        for b in range(0, SEQUENCES - BATCH + 1, BATCH):
            picked = shuffled[b:b + BATCH]
            words, back = np.unique(codes[picked], return_inverse=True)
            sizes = begins[words + 1] - begins[words]
            flat = at[np.repeat(begins[words] - (sizes.cumsum() - sizes), sizes) + np.arange(sizes.sum())]
            holder = np.repeat(np.arange(len(words)), sizes)
            lexical = np.flatnonzero(typical[words] >= 0)
            flat, holder = np.concatenate([flat, BUCKETS + typical[words][lexical]]), np.concatenate([holder, lexical])
            emitted = np.stack([np.bincount(holder, weights[flat, k], len(words)) for k in range(count)], axis=1)
            posterior, pairs = forward_backward(emitted[back.reshape(BATCH, -1)], there, chain[:count], np.exp(chain[count] - chain[count].max()))
            goal = one_hot[targets[picked]]
            error = (goal - posterior).reshape(-1, count)
            by_word = np.stack([np.bincount(back.ravel(), error[:, k], len(words)) for k in range(count)], axis=1) / BATCH
            rows, place = np.unique(flat, return_inverse=True)
            slope = np.stack([np.bincount(place, by_word[holder, k], len(rows)) for k in range(count)], axis=1) - 1e-5 * weights[rows]
            seen[rows] += slope * slope
            weights[rows] += RATE * slope / np.sqrt(seen[rows])
            chain_slope = np.vstack([np.einsum("btk,btl->kl", goal[:, :-1], goal[:, 1:]) - pairs, (goal - posterior)[:, 0].sum(axis=0)[None]]) / BATCH
            chain_seen += chain_slope * chain_slope
            chain += RATE * chain_slope / np.sqrt(chain_seen)
    model.weights, model.lexicon_weight = weights[:BUCKETS].astype(np.float32), weights[BUCKETS:]
    model.transitions, model.start = chain[:count], chain[count]
    return model


def typical_words(sample: DataFrame) -> dict[str, str]:
    """The words that occur ``LEXICON_COUNT`` times or more in the whole texts of a sample (``lang``, ``text``), nearly always in
    one language, and that language."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.update((lang, m.group()) for m in WORD.finditer(text.lower()))
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()),
                                              pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "n"])

    rows = (sample.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
            .groupBy("word", "lang").agg(F.sum("n").alias("n"))
            .groupBy("word").agg(F.sum("n").alias("total"), F.max_by("lang", "n").alias("lang"), F.max("n").alias("n"))
            .where((F.col("n") >= LEXICON_COUNT) & (F.col("n") >= LEXICON_SHARE * F.col("total"))))
    return {r["word"]: r["lang"] for r in rows.select("word", "lang").collect()}


def sampled_ids(rows: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` of the distinct rows (``_id``, ``lang``), in the order of a hash of the id. Every language gives the same
    share, or all it has if that is less, and what is left is filled up from all of them.

    A language's ids are dealt over ``SHARES`` by another hash, and each gives at most ``SURPLUS * limit / SHARES`` of its first
    ones, a rank that Spark filters before the shuffle. So no task sorts a language, only ``SURPLUS * limit`` of its ids.
    """
    order = [F.xxhash64("_id"), F.col("_id")]
    distinct = rows.distinct()
    share = F.pmod(F.hash("_id"), F.lit(SHARES))
    first = (distinct.withColumn("_share", share)
             .withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order)))
             .where(F.col("_rank") <= min(-(-SURPLUS * limit // SHARES), GROUP_LIMIT)))
    each = rows.agg(F.greatest(F.lit(1), F.floor(limit / F.countDistinct("lang")))).scalar()
    ranked = (first.withColumn("_rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("_rank") <= limit)
              .withColumn("_each", each))
    return ranked.orderBy(F.col("_rank") > F.col("_each"), *order, "lang").limit(limit).select("_id", "lang")


def fit(docs: DataFrame, training: Column, limit: int = SAMPLE_DOCUMENTS, lang_col: str = "lang", text_col: str = "text",
        id_col: str = "doc_id") -> LanguageModel:
    """Learn from at most ``limit`` documents that ``training`` allows, dealt over all languages (see ``sampled_ids``), so
    ``limit`` also bounds the languages; a language costs 2 MB of driver memory to learn and 0.5 MB in the model. Words typical of
    a language are counted over the sample's whole texts. The gradient steps draw from at most ``RUNS`` runs of words of a
    document, spread over its whole text. Null languages and texts teach nothing, repeated rows count as often as they are there."""
    rows = docs.where(training & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(lang_col).alias("lang"))
    picked = sampled_ids(rows, limit).select(F.col("_id").cast("string"), "lang")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_runs(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.string()))], names=["_id", "lang", "runs"])

    sample = staged(docs.select(F.col(id_col).cast("string").alias("_id"), F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text"))
                    .join(F.broadcast(picked), ["_id", "lang"]).where("text is not null").select("_id", "lang", "text"), "languages")
    runs = sorted(sample.mapInArrow(cut, "_id string, lang string, runs array<string>").collect())
    return train([run.split() for r in runs for run in r["runs"]], [r["lang"] for r in runs for _ in r["runs"]], typical_words(sample))


def _runs(text: str) -> list[str]:
    """At most ``RUNS`` runs of ``RUN_WORDS`` words at even distances over a text."""
    words = WORD.findall(text.lower())
    starts = np.unique(np.linspace(0, max(0, len(words) - RUN_WORDS), RUNS).astype(int)) if words else []
    return [" ".join(words[at:at + RUN_WORDS]) for at in starts]


def labelled(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the share of the text's words that the model gives that language.

    Null texts and texts without a letter are ``und`` with score 0, as is every text when nothing was learned. Ties go to
    the language first in code point order. Very long texts are read whole, repeated rows get equal answers, an empty table
    stays empty. Columns that already have these names are replaced, all others stay.
    """
    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        names, shares = model.predict(texts)
        return pd.DataFrame({"lang_pred": names, "score": shares})

    (answer,) = fresh(docs, "language")
    return (docs.withColumn(answer, predict(F.col(text_col).cast("string")))
            .withColumns({"lang_pred": F.col(answer)["lang_pred"], "score": F.col(answer)["score"]}).drop(answer))
