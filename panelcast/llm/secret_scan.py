"""Secrets in texts: fixed forms, and credential values that are expensive to guess."""

from __future__ import annotations

import math
import re
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from panelcast.llm.spelling import RUN, lowered
from panelcast.llm.staging import staged

# The base forms and the least length of what they must hold.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"[0-9a-f]+")
HEX_LONG = re.compile(r"[0-9a-f]{24,}")  # the same runs, found faster
KINDS = ("assign", "access", "hex", "guess")

#: Words that announce a credential beyond the base forms, what may stand between, and the value.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth(?:orization)?|bearer|(?:api|access|private|secret|client|signing|master)[_\x20-]?key)"""
    r"""["']?(?:\x20*(?::|=>|=)\x20*|\x20+is:?\x20+)(?:(?:bearer|basic)\x20+)?["'`]?([^\s"'`<>,;(){}\[\]]{8,})""", re.ASCII | re.IGNORECASE)

LEAST_BITS = 45.0
SPAN = 64
SPAN_BITS = 1.0
WORD_SHARE = 200_000
WORD_LEAST = 5
UNITS = 8
YEARS = (1900, 2099)
LEET = str.maketrans("013457@$", "oleastas")
KEYBOARD = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = str.maketrans('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./")
PLACE = {letter: (row, column) for row, letters in enumerate(KEYBOARD) for column, letter in enumerate(letters)}
STARTS, STEPS = math.log2(len(PLACE)), math.log2(6)
DATES = re.compile(r"(\d{4})([-/._]?)(\d{1,2})\2(\d{1,2})|(\d{1,2})([-/._]?)(\d{1,2})\6(\d{4}|\d{2})")


def word_bits(docs: DataFrame, text_col: str = "text", share: int = WORD_SHARE, least: int = WORD_LEAST) -> dict[str, float]:
    """The guess cost, in bits, of every word that is at least one in ``share`` of all words of three letters and more.

    All texts are counted. As shares add up to one, no more than ``share`` words can pass, however large the corpus.
    """
    runs = docs.select(F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"({RUN})"), F.lit(1))).alias("run"))
    counts = staged(runs.where(F.length("run").between(3, SPAN)).groupBy("run").agg(F.count("*").alias("n"))
              .groupBy(lowered(F.col("run")).alias("word")).agg(F.sum("n").alias("n")), "counts")
    total = counts.agg(F.sum("n").alias("total")).first()["total"] or 0
    passed = counts.where((F.col("n") >= least) & (F.col("n") * share >= total))
    return {r["word"]: math.log2(total / r["n"]) for r in passed.collect()}


class Guesser:
    """The least number of bits that name a value as a row of spans.

    A span is a word (its frequency, its capitals, letters written as digits), a date, a unit of up to ``UNITS`` characters
    repeated (the unit's own cost and the repeats), a walk on the keyboard or through the alphabet (start, turns, length),
    or characters tried one by one (the alphabet of the kinds that occur). A span has at most ``SPAN`` characters and
    costs ``SPAN_BITS`` beyond what is in it; a value of any length is covered, in time linear in its length.
    """

    def __init__(self, words: dict[str, float]):
        self.words = words
        self.longest = min(SPAN, max(map(len, words), default=0))

    def bits(self, value: str) -> float:
        return self._least(value, True)

    def spans(self, value: str) -> list[tuple[str, int, int]]:
        """The spans of one least-cost segmentation."""
        last: list[tuple[str, int]] = []
        self._least(value, True, last)
        out, at = [], len(value)
        while at:
            kind, start = last[at]
            out.append((kind, start, at))
            at = start
        return out[::-1]

    def _least(self, value: str, repeats: bool, last: list | None = None) -> float:
        size = len(value)
        cost = [0.0] + [math.inf] * size
        how: list[tuple[str, int]] = [("", 0)] * (size + 1)
        for start in range(size):
            base = cost[start] + SPAN_BITS
            for kind, end, bits in self._from(value, start, repeats):
                if base + bits < cost[end]:
                    cost[end], how[end] = base + bits, (kind, start)
        if last is not None:
            last[:] = how
        return cost[size]

    def _from(self, value: str, start: int, repeats: bool):
        piece = value[start:start + SPAN]
        yield from self._tried(piece, start)
        yield from self._words(piece, start)
        yield from self._dates(piece, start)
        yield from self._walks(piece, start)
        if repeats:
            yield from self._repeats(piece, start)

    def _tried(self, piece: str, start: int):
        digit = lower = upper = other = 0
        for i, c in enumerate(piece, 1):
            if "0" <= c <= "9":
                digit = 10
            elif "a" <= c <= "z":
                lower = 26
            elif "A" <= c <= "Z":
                upper = 26
            else:
                other = 33 if c < "\x80" else max(other, 1000)
            yield "tried", start + i, i * math.log2(digit + lower + upper + other)

    def _words(self, piece: str, start: int):
        piece = piece[:self.longest]
        plain, folded = piece.lower(), piece.lower().translate(LEET)
        if len(plain) != len(piece):  # a letter whose lower case is two
            return
        for i in range(3, len(piece) + 1):
            for form in {plain[:i], folded[:i]}:
                bits = self.words.get(form)
                if bits is not None:
                    part = piece[:i]
                    capitals = sum(c.isupper() for c in part)
                    if capitals:
                        bits += 1.0 if part[1:].islower() or part.isupper() or not part[1:] else math.log2(math.comb(i, capitals)) + 1.0
                    bits += sum(a != b for a, b in zip(plain[:i], form))
                    yield "word", start + i, bits

    def _dates(self, piece: str, start: int):
        if not piece[0].isdigit():
            return
        if piece[:4].isascii() and piece[:4].isdigit() and len(piece) >= 4 and YEARS[0] <= int(piece[:4]) <= YEARS[1]:
            yield "date", start + 4, math.log2(YEARS[1] - YEARS[0] + 1)
        for end in range(4, min(10, len(piece)) + 1):
            if is_date(piece[:end]):
                yield "date", start + end, math.log2(366 * (YEARS[1] - YEARS[0] + 1)) + 2.0 * (not piece[:end].isdigit())

    def _walks(self, piece: str, start: int):
        keys = piece.lower().translate(SHIFTED)
        if len(keys) != len(piece):
            return
        shifted = sum(1 for a, b in zip(piece[:2], keys) if a != b)
        turns, step = 0, None
        for i in range(1, len(piece)):
            a, b = PLACE.get(keys[i - 1]), PLACE.get(keys[i])
            if a is None or b is None or a == b or abs(a[0] - b[0]) > 1 or abs(a[1] - b[1]) > 1:
                break
            now = (b[0] - a[0], b[1] - a[1])
            turns, step = turns + (now != step), now
            shifted += i > 1 and piece[i] != keys[i]
            if i >= 2:
                yield "walk", start + i + 1, STARTS + turns * STEPS + math.log2(i + 1) + shifted
        for i in range(1, len(piece)):
            if abs(ord(piece[i]) - ord(piece[i - 1])) != 1 or ord(piece[i]) - ord(piece[i - 1]) != ord(piece[1]) - ord(piece[0]):
                break
            if i >= 2:
                yield "walk", start + i + 1, math.log2(62) + 1.0 + math.log2(i + 1)

    def _repeats(self, piece: str, start: int):
        for unit in range(1, min(UNITS, len(piece) // 2) + 1):
            count = 1
            while piece[count * unit:(count + 1) * unit] == piece[:unit]:
                count += 1
                if count == 2:
                    own = self._least(piece[:unit], False)
                yield "repeat", start + count * unit, own + math.log2(count)


def is_date(text: str) -> bool:
    """Year, month, day or day, month, year or month, day, year, with one separator or none."""
    found = DATES.fullmatch(text) if text.isascii() else None
    if not found:
        return False
    if found[1]:
        orders = [(found[1], found[3], found[4])]
    else:
        year = found[8] if len(found[8]) == 4 else "20" + found[8]
        orders = [(year, found[5], found[7]), (year, found[7], found[5])]
    for year, month, day in orders:
        if YEARS[0] <= int(year) <= YEARS[1] and 1 <= int(month) <= 12 and 1 <= int(day) <= 31:
            try:
                date(int(year), int(month), int(day))
                return True
            except ValueError:
                pass
    return False


def scan(text: str | None, guesser: Guesser, least_bits: float = LEAST_BITS) -> list[dict]:
    """All spans of a text, by start and then by kind; starts and ends are code points, ends are exclusive.

    Base spans are never changed. A value in a credential's context that no base span touches is added as ``guess`` if its
    cost reaches ``least_bits``. ``bits`` is the cost of the value of an ``assign`` or ``guess``, null for the others.
    """
    if not text:
        return []
    found = [("assign", m.start(), m.end(), guesser.bits(m[2])) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [("access", m.start(), m.end(), None) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [("hex", m.start(), m.end(), None) for m in HEX_LONG.finditer(text)]
    base = sorted((start, end) for _, start, end, _ in found)
    at = 0
    reach = 0
    for m in CONTEXT.finditer(text):
        start, end = m.span(1)
        end = start + len(m[1].rstrip(".!?:"))
        while at < len(base) and base[at][0] < end:
            reach = max(reach, base[at][1])
            at += 1
        if reach <= start and end > start:
            bits = guesser.bits(text[start:end])
            if bits >= least_bits:
                found.append(("guess", start, end, bits))
    found.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    return [{"kind": k, "start": s, "end": e, "bits": b} for k, s, e, b in found]


SECRETS_TYPE = "array<struct<kind: string, start: long, end: long, bits: double>>"


def with_secrets(docs: DataFrame, words: dict[str, float], text_col: str = "text", out_col: str = "secrets", least_bits: float = LEAST_BITS) -> DataFrame:
    """``docs`` with the spans of each text (see ``scan``) in ``out_col``, which replaces a column of that name.

    ``words`` comes from ``word_bits``. Every row has its own result: null and empty texts give an empty array, whole texts
    are read however long, repeated rows repeat their result, an empty table stays empty.
    """
    def run(texts: pd.Series) -> pd.Series:
        guesser = Guesser(words)
        return pd.Series([scan(text, guesser, least_bits) for text in texts], dtype=object)

    return docs.withColumn(out_col, F.pandas_udf(run, SECRETS_TYPE)(F.col(text_col).cast("string")))


def listed(secrets: Column | str, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of some kinds, joined by commas."""
    spans = F.filter(secrets, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
