"""Toxicity: Levenshtein automata over a lexicon's trie, and windows of context around what they find."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelcast.llm.labelled import SAMPLE_ROWS, labelled_sample
from panelcast.llm.logistic import fit_logistic, probability
from panelcast.llm.minhash import random_factors, shingle_set, signature
from panelcast.llm.staging import staged

#: Characters that often stand for letters belong to a word.
TOKEN = re.compile(r"\w[\w@$*]*")
QUOTE = re.compile("[\"“”„«»‹›]")
WINDOW = 8
LEAST_DOCUMENTS = 3
LEAST_LOG_ODDS = 3.0
PREFIXES = range(4, 9)
MAX_STATES = 50_000
MINIMA = 32

# Words that report another's words, and words that address a reader, in the languages of the tables.
REPORTING = set("said says say wrote writes quote quoted quotes called calls told claims claimed according reported word term "
                "sagte sagt schrieb zitat zitierte nannte laut wort dit disait écrit citation appelle selon mot "
                "dijo dice escribió cita llamó según palabra".split())
ADDRESSING = set("you your yours yourself u ur du dich dir dein deine euch ihr tu te toi ton ta vous votre tú ti usted ustedes".split())


def edits_for(length: int, is_open: bool) -> int:
    """Misspellings allowed in a term; short terms and stems have none, as other words are too near."""
    return 0 if length < 5 or is_open and length < 7 else 1 if length < 9 else 2


class LexiconAutomaton:
    """All words within a term's number of edits, as one automaton.

    Its states are sets of (trie node, edits so far): the trie of the lexicon run in step with every term's
    Levenshtein automaton. They are made deterministic as words ask for them and kept, at most ``MAX_STATES``.
    An open term (a stem) also accepts whatever follows it.
    """

    def __init__(self, terms: list[tuple[str, bool]]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[tuple[int, int, bool]]] = [[]]
        self.allowed = [0]
        for index, (term, is_open) in enumerate(terms):
            edits, node = edits_for(len(term), is_open), 0
            path = [0]
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.allowed.append(0)
                node = self.children[node][letter]
                path.append(node)
            self.ends[node].append((index, edits, is_open))
            for passed in path:
                self.allowed[passed] = max(self.allowed[passed], edits)
        self.letters = {letter for node in self.children for letter in node}
        self._clear()

    def _clear(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.sets: list[tuple] = []
        self.steps: list[dict[str, int]] = []
        self.accepts: list[tuple] = []
        self.start = self._number(self._closed({0: 0}), frozenset())

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """With the nodes reached by leaving out letters of a term."""
        queue = list(nodes)
        while queue:
            node = queue.pop()
            for child in self.children[node].values():
                edits = nodes[node] + 1
                if edits <= self.allowed[child] and edits < nodes.get(child, 99):
                    nodes[child] = edits
                    queue.append(child)
        return nodes

    def _number(self, nodes: dict[int, int], settled: frozenset) -> int:
        settled = settled | {(i, e) for node, e in nodes.items() for i, most, is_open in self.ends[node] if is_open and e <= most}
        key = (tuple(sorted(nodes.items())), settled)
        if key not in self.numbers:
            self.numbers[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            found: dict[int, int] = {}
            for i, e in [*settled, *((i, e) for node, e in nodes.items() for i, most, _ in self.ends[node] if e <= most)]:
                found[i] = min(e, found.get(i, 99))
            self.accepts.append(tuple(sorted(found.items())))
        return self.numbers[key]

    def _step(self, state: int, letter: str) -> int:
        nodes, settled = self.sets[state]
        reached: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.allowed[node] and edits < reached.get(node, 99):
                reached[node] = edits

        for node, edits in nodes:
            reach(node, edits + 1)
            for other, child in self.children[node].items():
                reach(child, edits + (other != letter))
        target = -1 if not reached and not settled else self._number(self._closed(reached), settled)
        self.steps[state][letter] = target
        return target

    def match(self, word: str) -> tuple:
        """(term, edits) of the terms that accept the word."""
        if len(self.sets) > MAX_STATES:
            self._clear()
        state, letters, steps = self.start, self.letters, self.steps
        for letter in word:
            letter = letter if letter in letters else "\0"
            following = steps[state].get(letter)
            if following is None:
                following = self._step(state, letter)
            if following < 0:
                return ()
            state = following
        return self.accepts[state]


FEATURES = ("exact", "exact_quoted", "fuzzy", "fuzzy_quoted", "addressed", "strongest", "density")
UNSEEN = (0.0, 0.4, 0.9, 0.3, 0.0, 0.0, 0.0)


@dataclass
class ToxicityModel:
    """What was learned: terms with their log odds, words that are no misspellings, and the weights of the features."""

    terms: list[tuple[str, bool]] = field(default_factory=list)
    log_odds: list[float] = field(default_factory=list)
    innocent: frozenset = frozenset()
    coefficients: np.ndarray = field(default_factory=lambda: np.array([-6.0, *([0.0] * len(FEATURES))]))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def _hit(self, word: str) -> tuple[float, bool] | None:
        """(log odds, exact) of the best term for a word."""
        known = self.__dict__.setdefault("_known", {})
        if word not in known:
            if len(known) > 200_000:
                known.clear()
            if "_automaton" not in self.__dict__:
                self._automaton = LexiconAutomaton(self.terms)
            found = [(self.log_odds[i] / (1 + edits / 2), edits == 0) for i, edits in self._automaton.match(word)
                     if edits == 0 or word not in self.innocent]
            known[word] = max(found, default=None)
        return known[word]

    def hits(self, text: str) -> list[tuple[int, str, float, bool, bool, bool]]:
        """(position, word, log odds, exact, quoted, addressed) of the words found."""
        lowered = text.lower()
        tokens = TOKEN.findall(lowered)
        found = {word: hit for word in set(tokens) if (hit := self._hit(word))}
        if not found:
            return []
        out, spans = [], [m.span() for m in TOKEN.finditer(lowered)]
        for i, word in enumerate(tokens):
            if word in found:
                first, last = max(0, i - WINDOW), min(len(tokens) - 1, i + WINDOW)
                before, after = lowered[spans[first][0]:spans[i][0]], lowered[spans[i][1]:spans[last][1] + 1]
                near = set(tokens[first:last + 1])
                quoted = bool(QUOTE.search(before) and QUOTE.search(after)) or bool(near & REPORTING and (QUOTE.search(before) or QUOTE.search(after)))
                out.append((i, word, *found[word], quoted, bool(near & ADDRESSING)))
        return out

    def features(self, text: str | None) -> list[float]:
        hits = self.hits(text or "")
        if not hits:
            return [0.0] * len(FEATURES)
        total = lambda exact, quoted: math.log1p(sum(h[2] for h in hits if h[3] == exact and h[4] == quoted))
        direct = [h[2] for h in hits if not h[4]]
        length = len(text) / 6 + 1
        return [total(True, False), total(True, True), total(False, False), total(False, True),
                math.log1p(sum(h[5] and not h[4] for h in hits)), max(direct, default=0.0) / 4, min(1.0, 20 * len(hits) / length)]

    def scores(self, texts) -> np.ndarray:
        return probability(np.array([self.features(t) for t in texts]).reshape(-1, len(FEATURES)), self.coefficients)


def _terms_of(text: str) -> set[tuple[str, bool]]:
    words = {w for w in TOKEN.findall(text.lower()) if len(w) > 2}
    return {(w, False) for w in words} | {(w[:n], True) for w in words for n in PREFIXES if len(w) > n}


def _counted(sample: DataFrame, terms) -> DataFrame:
    """Documents of either label that hold a term; ``terms`` says of a text what to count."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (toxic if label else clean).update(terms(text))
        keys = list({*toxic, *clean})
        yield pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()),
            pa.array([toxic[k] for k in keys], pa.int64()), pa.array([clean[k] for k in keys], pa.int64())],
            names=["term", "open", "toxic", "clean"])

    counted = sample.select("text", "label").mapInArrow(count, "term string, open boolean, toxic long, clean long")
    return counted.groupBy("term", "open").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _different_documents(sample: DataFrame, terms: list[tuple[str, bool]]) -> dict[tuple[str, bool], float]:
    """How many documents hold each term if near copies count as one: n / (1 + (n - 1) * mean likeness of two of them).

    Agreeing minima of word hashes estimate the likeness; up to a half it is that of any two texts of a language and
    counts as none. All documents of the sample are compared, one with all others at a time."""
    number = {term: i for i, term in enumerate(terms)}
    factors, shifts = random_factors(MINIMA, 1), random_factors(MINIMA, 2)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([
                pa.array([signature(shingle_set(t, 1), factors, shifts).tolist() for t in texts], pa.list_(pa.int64())),
                pa.array([[number[k] for k in _terms_of(t) if k in number] for t in texts], pa.list_(pa.int64()))], names=["minima", "terms"])

    rows = sample.select("text").mapInArrow(sketch, "minima array<long>, terms array<long>").collect()
    minima = np.array([r["minima"] for r in rows], np.uint32).reshape(-1, MINIMA)
    holders: list[list[int]] = [[] for _ in terms]
    for i, r in enumerate(rows):
        for k in r["terms"]:
            holders[k].append(i)
    places = [np.array(own, np.int64) for own in holders]
    alike = np.zeros(len(terms))
    for i, r in enumerate(rows):
        if r["terms"]:
            likeness = np.maximum(0, 2 * (minima == minima[i]).mean(axis=1) - 1)
            for k in r["terms"]:
                alike[k] += likeness[places[k]].sum() - 1
    return {term: len(places[k]) / (1 + alike[k] / max(1, len(places[k]))) for term, k in number.items()}


def _surprise(toxic: float, clean: int, base: float) -> float:
    """A lower bound of -log of the chance to see so large a share of toxic documents (Chernoff)."""
    share = toxic / (toxic + clean)
    if share <= base:
        return 0.0
    rest = clean * math.log((1 - share) / (1 - base)) if clean else 0.0
    return toxic * math.log(share / base) + rest


def learn_lexicon(sample: DataFrame, toxic_rows: int, clean_rows: int) -> tuple[list[tuple[str, bool]], list[float]]:
    """Terms whose odds of a toxic document are high, with their log odds.

    Chance must be an unlikely reason for so many different toxic documents, given that so many terms were looked at.
    All terms of the sample are tested in tasks, and only those that pass come to the driver. Stems come first, the
    shortest of a family; a stem that one word makes up, nearly alone, is that word.
    """
    looked_at = staged(_counted(sample, _terms_of).where(F.col("toxic") >= LEAST_DOCUMENTS), "terms")
    base, doubt = toxic_rows / (toxic_rows + clean_rows), math.log(10 * max(1, looked_at.count()))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = list(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()))
            odds = [math.log((t + 0.5) / (toxic_rows + 1)) - math.log((c + 0.5) / (clean_rows + 1)) for t, c in counts]
            passed = [o >= LEAST_LOG_ODDS and _surprise(t, c, base) >= doubt for o, (t, c) in zip(odds, counts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(odds, pa.float64())], names=["term", "open", "toxic", "clean", "odds"]).filter(pa.array(passed, pa.bool_()))

    tested = looked_at.mapInArrow(test, "term string, open boolean, toxic long, clean long, odds double")
    strong = {(r["term"], r["open"]): (r["odds"], r["toxic"], r["clean"]) for r in tested.collect()}
    different = _different_documents(sample.where("label = 1"), sorted(strong))
    strong = {k: v for k, v in strong.items() if different[k] >= LEAST_DOCUMENTS - 0.5 and _surprise(different[k], v[2], base) >= doubt}
    kept: dict[tuple[str, bool], float] = {}
    words = sorted(k[0] for k in strong if not k[1])
    for term, _ in sorted((k for k in strong if k[1]), key=lambda k: (len(k[0]), k[0])):
        share = max((strong[(w, False)][1] for w in words if w.startswith(term)), default=0) / strong[(term, True)][1]
        if share < 0.8 and not any((term[:n], True) in kept for n in PREFIXES if n < len(term)):
            kept[(term, True)] = strong[(term, True)][0]
    for word in words:
        if not any((word[:n], True) in kept for n in PREFIXES):
            kept[(word, False)] = strong[(word, False)][0]
    best = sorted(kept, key=lambda k: (-strong[k][1], k))
    return best, [kept[k] for k in best]


def innocent_words(clean: DataFrame, model: ToxicityModel) -> frozenset:
    """All words of clean texts that look like misspellings of a term."""
    def near(text: str) -> set[tuple[str, bool]]:
        return {(w, False) for w in set(TOKEN.findall(text.lower())) if (hit := model._hit(w)) and not hit[1]}

    return frozenset(r["term"] for r in _counted(clean, near).collect())


def fit(docs: DataFrame, labels: DataFrame, training: Column, limit: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn from at most ``limit`` labelled documents: two thirds give the lexicon, the rest the weights of the features.

    Without labels of both kinds the model has no terms and gives every text the same low score.
    """
    sample = labelled_sample(docs, labels, training, "toxic", limit)
    fold = F.pmod(F.xxhash64("text"), F.lit(3))
    lexicon_part, weight_part = sample.where(fold > 0), sample.where(fold == 0)
    counts = {r["label"]: r["count"] for r in lexicon_part.groupBy("label").count().collect()}
    model = ToxicityModel()
    if not counts.get(1) or not counts.get(0):
        return model
    model.terms, model.log_odds = learn_lexicon(lexicon_part, counts[1], counts[0])
    if not model.terms:
        return model

    model.innocent = innocent_words(lexicon_part.where("label = 0"), model)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [model.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1).cast(pa.int64())], names=["x", "label"])

    rows = weight_part.select("text", "label").mapInArrow(featured, "x array<double>, label long").collect()
    if len({r["label"] for r in rows}) == 2:
        x = np.array([r["x"] for r in rows])
        model.coefficients = fit_logistic(x, np.array([r["label"] for r in rows], float), least=0.0)
        for i, share in enumerate(UNSEEN):  # what no labelled text shows is weighed against a direct, exact word
            if share and not x[:, i].any():
                model.coefficients[1 + i] = share * model.coefficients[1]
    else:  # too few labels to weigh the features: any strong word counts
        model.coefficients = np.array([-4.0, 3.0, 0.0, 1.0, 0.0, 0.5, 1.0, 1.0])
    return model


def scored(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for each whole text.

    Null and empty texts and texts without a term have the score of no hits. Long texts are read whole; only their words
    are kept. Rows that repeat score alike, and an empty table stays empty. A column that already has the score's name is
    replaced; all others stay.
    """
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts))

    return docs.withColumn(score_col, score(F.col(text_col).cast("string")))
