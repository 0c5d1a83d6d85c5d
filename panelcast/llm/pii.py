"""Personal data: keyed surrogates of the same type, format, script and gender, distinct where the originals are."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelcast.llm.staging import fresh, staged

ROUNDS = 50

# Given names by script and gender, and the honorifics that go before a surname.
GIVEN = {
    ("latin", "f"): "Mary Anna Emma Julia Laura Sarah Sophie Marie Claire Camille Chloé Elena Carmen Lucía María Paula Greta Ursula Ingrid "
                    "Katharina Elizabeth Jennifer Linda Patricia Susan Margaret Hannah Charlotte Alice Isabella".split(),
    ("latin", "m"): "John James Robert Michael William David Thomas Peter Paul Hans Jürgen Klaus Stefan Wolfgang Pierre Jean Luc François "
                    "Antoine José Carlos Juan Miguel Pedro Diego Richard Charles Daniel Matthew George".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Юлия".split(),
    ("cyrillic", "m"): "Иван Алексей Дмитрий Сергей Андрей Михаил Николай Владимир Павел Юрий".split(),
    ("greek", "f"): "Μαρία Ελένη Αικατερίνη Σοφία Άννα Δήμητρα Ιωάννα Ειρήνη".split(),
    ("greek", "m"): "Γιώργος Ιωάννης Κωνσταντίνος Δημήτρης Νικόλαος Παναγιώτης Βασίλης Χρήστος".split(),
}
HONORIFICS = {"Mr", "Mr.", "Mrs", "Mrs.", "Ms", "Ms.", "Dr.", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Señor", "Señora", "Sr.", "Sra."}
SYLLABLES = {
    "latin": ["bar", "ben", "cor", "dal", "den", "fer", "gar", "hal", "ken", "lan", "lor", "mar", "mel", "nor", "pel", "ren", "ros", "sal", "ter", "win"],
    "cyrillic": ["бар", "вал", "гор", "дан", "жук", "зор", "кал", "лен", "мор", "нов", "пет", "род", "сав", "тим", "фед", "хар"],
    "greek": ["βασ", "γερ", "δημ", "θεο", "καλ", "λαμ", "μαρ", "νικ", "παπ", "ραφ", "στα", "τσι", "φωτ", "χατ"],
}
GENDER_OF = {name.casefold(): (script, gender) for (script, gender), names in GIVEN.items() for name in names}

#: Earlier patterns win where two overlap. A group named ``v`` is the part to replace.
PATTERNS = [
    ("SECRET", re.compile(r"(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?(?P<v>[^\s\"',;]{6,})")),
    ("EMAIL", re.compile(r"(?<![\w.+-])[\w.+-]++@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,}")),
    ("KEY", re.compile(r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b")),
    ("IBAN", re.compile(r"\b[A-Z]{2}\d{2}[A-Z0-9]{11,30}\b")),
    ("HEX", re.compile(r"\b(?=[0-9a-fA-F]*\d)[0-9a-fA-F]{32,}\b")),
    ("IP", re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)")),
    ("CARD", re.compile(r"(?<![\d.-])(?:\d{4}[ -]){3}\d{1,7}(?![\d-])|(?<!\d)\d{13,19}(?!\d)")),
    ("SSN", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("PHONE", re.compile(r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\w.-])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?!\d)")),
]
SIGNS = re.compile(r"[0-9@]|(?i:passw|pwd|secret|token|api.?key)")
CAPITAL = re.compile(r"[^\W\d_][\w'’-]*\.?")
BY_DIGITS = {"CARD", "SSN", "PHONE"}


class _Taken:
    """Spans without overlaps, in order."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def add(self, start: int, end: int) -> bool:
        """Take a span if it is free."""
        at = bisect_left(self.starts, end)  # spans before this one start ahead of the end
        if at and self.ends[at - 1] > start:
            return False
        self.starts.insert(at, start)
        self.ends.insert(at, end)
        return True


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical value) of the personal data in a text, in order and without overlaps.

    Mentions of one thing share a value: numbers by their digits (telephones without the +1 of their country), all others
    without regard to case; a secret that has the form of another type is of that type. A run of 13 to 19 digits is a card
    only with a right check digit. People are a known given name before a capitalised word, or an honorific before one; their
    names count wherever they recur.
    """
    found: list[tuple[int, int, str, str]] = []
    taken = _Taken()
    if SIGNS.search(text):
        for kind, pattern in PATTERNS:
            for match in pattern.finditer(text):
                start, end = match.span("v") if "v" in pattern.groupindex else match.span()
                mention = text[start:end]
                if kind == "CARD" and mention.isdigit() and not _luhn(mention):
                    continue
                if taken.add(start, end):
                    true_kind = _form(mention) or kind if kind == "SECRET" else kind
                    found.append((start, end, true_kind, canonical(true_kind, mention)))
    found += [x for x in _people(text) if taken.add(x[0], x[1])]
    return sorted(found)


def _form(mention: str) -> str | None:
    """The type whose form a mention has as a whole, secrets apart."""
    for kind, pattern in PATTERNS[1:]:
        if pattern.fullmatch(mention) and not (kind == "CARD" and mention.isdigit() and not _luhn(mention)):
            return kind
    return None


def canonical(kind: str, mention: str) -> str:
    if kind not in BY_DIGITS:
        return mention.casefold()
    digits = "".join(c for c in mention if c.isdigit())
    return digits[1:] if kind == "PHONE" and len(digits) == 11 and digits[0] == "1" else digits


def _people(text: str) -> list[tuple[int, int, str, str]]:
    words = set(text.split())
    if words.isdisjoint(HONORIFICS) and not any(w.casefold() in GENDER_OF for w in words if w[:1].isupper()):
        return []
    tokens = [(m.start(), m.group()) for m in CAPITAL.finditer(text)]
    surnames, given = set(), set()
    for (at, word), (after, name) in zip(tokens, tokens[1:]):
        plain = name.rstrip(".")
        if text[at + len(word):after] == " " and plain[:1].isupper() and plain[1:].islower() and len(plain) > 2:
            if word.casefold() in GENDER_OF and word[:1].isupper():
                given.add(word.casefold())
                surnames.add(plain.casefold())
            elif word in HONORIFICS and plain.casefold() not in GENDER_OF:
                surnames.add(plain.casefold())
    out = []
    for at, word in tokens:
        plain = word.rstrip(".")
        key = plain.casefold()
        if plain[:1].isupper() and key in given:
            out.append((at, at + len(plain), "GIVEN_" + "_".join(GENDER_OF[key]).upper(), key))
        elif plain[:1].isupper() and key in surnames:
            out.append((at, at + len(plain), "SURNAME_" + _script(key).upper(), key))
    return out


def _script(word: str) -> str:
    first = word[:1]
    return "cyrillic" if "Ѐ" <= first <= "ӿ" else "greek" if "Ͱ" <= first <= "Ͽ" or "ἀ" <= first <= "῿" else "latin"


class _Stream:
    """Keyed choices for one value; another attempt gives others."""

    def __init__(self, key: str, kind: str, value: str, attempt: int):
        self.seed = hashlib.blake2b(f"{kind}\0{attempt}\0{value}".encode("utf-8", "surrogatepass"), key=hashlib.sha256(key.encode()).digest()).digest()
        self.block, self.left = 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 8:
            self.left = hashlib.blake2b(self.seed + self.block.to_bytes(8, "little")).digest()
            self.block += 1
        number, self.left = int.from_bytes(self.left[:8], "little"), self.left[8:]
        return number % n

    def of(self, choices):
        return choices[self.below(len(choices))]

    def alike(self, text: str, letters: str = "abcdefghijklmnopqrstuvwxyz") -> str:
        """Letters for letters and digits for digits; the rest stays."""
        return "".join(self.of("0123456789") if c.isdigit() else self.of(letters) if c.isalpha() else c for c in text)


def surrogate(key: str, kind: str, value: str, attempt: int) -> str:
    """A canonical replacement for a canonical value."""
    draw = _Stream(key, kind, value, attempt)
    if kind.startswith("GIVEN_"):
        script, gender = kind.lower().split("_")[1:]
        names = [n.casefold() for n in GIVEN[script, gender] if n.casefold() != value]
        return draw.of(names) if attempt < 12 else f"{draw.of(names)}-{draw.of(names)}"
    if kind.startswith("SURNAME_"):
        parts = SYLLABLES[kind.lower().split("_")[1]]
        return "".join(draw.of(parts) for _ in range(3 + attempt // 3))
    if kind == "EMAIL":
        name, _, domain = value.rpartition("@")
        labels = domain.split(".")
        fixed = 2 if labels[-2:-1] == ["example"] else 1  # a domain kept for examples stays one
        return f"{draw.alike(name)}@{'.'.join([*map(draw.alike, labels[:-fixed]), *labels[-fixed:]])}"
    if kind == "IP":
        octets = value.split(".")
        fixed = 1 if octets[0] in ("10", "127") else 2 if octets[:2] == ["192", "168"] or octets[0] == "172" and 16 <= int(octets[1]) < 32 else 0
        return ".".join([*octets[:fixed], *(str(1 + draw.below(223 if i == 0 else 254)) for i in range(fixed, 4))])
    if kind == "KEY":
        return value[:4] + draw.alike(value[4:])
    if kind == "HEX" or kind == "SECRET" and re.fullmatch("[0-9a-f]+", value):
        return "".join(draw.of("0123456789abcdef") for _ in value)
    if kind == "IBAN":
        rest = draw.alike(value[4:])
        return f"{value[:2]}{98 - _mod97(rest + value[:2] + '00'):02d}{rest}"
    if kind == "CARD":
        digits = value[0] + draw.alike(value[1:])
        return digits[:-1] + str(next(d for d in range(10) if _luhn(digits[:-1] + str(d)))) if _luhn(value) else digits
    if kind in BY_DIGITS:
        return value[:1] + draw.alike(value[1:])
    return draw.alike(value)


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def rendered(kind: str, mention: str, replacement: str) -> str:
    """The replacement in the mention's format: its punctuation and country for numbers, its use of capitals for all others."""
    if kind in BY_DIGITS:
        digits, country = iter(replacement), sum(map(str.isdigit, mention)) - len(replacement)
        out = []
        for c in mention:
            country -= c.isdigit()
            out.append(next(digits) if c.isdigit() and country < 0 else c)
        return "".join(out)
    if len(mention) == len(replacement):
        return "".join(r.upper() if m.isupper() else r for m, r in zip(mention, replacement))
    if mention.isupper() and len(mention) > 1:
        return replacement.upper()
    return replacement.title() if mention[:1].isupper() else replacement


def replaced(text: str, key: str, later: dict[tuple[str, str], str]) -> tuple[str, int]:
    """The text with surrogates, and how many; ``later`` has those that are not a value's first choice."""
    found, out, at = entities(text), [], 0
    for start, end, kind, value in found:
        new = later.get((kind, value)) or surrogate(key, kind, value, 0)
        out += [text[at:start], rendered(kind, text[start:end], new)]
        at = end
    return "".join([*out, text[at:]]) if found else text, len(found)


def assigned(values: DataFrame, key: str) -> DataFrame:
    """``kind``, ``value``, ``surrogate`` and ``attempt`` for distinct values.

    All values draw; a surrogate that several drew goes to the smallest value, one that was given out before or that is
    itself a value of its kind (names excepted, there are few) to none; those left over draw again.
    """
    @F.pandas_udf("string")
    def draw(kind: pd.Series, value: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, k, v, a) for k, v, a in zip(kind, value, attempt)], dtype=object)

    pending, settled = values, None
    for attempt in range(ROUNDS):
        drawn = staged(pending.withColumn("attempt", F.lit(attempt)).withColumn("surrogate", draw("kind", "value", "attempt")), "drawn")
        first = drawn.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        originals = values.where("kind not like 'GIVEN%'").select("kind", F.col("value").alias("surrogate"))
        free = first.join(originals, ["kind", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled, ["kind", "surrogate"], "left_anti")
        won = free.select("kind", "value", "surrogate", F.lit(attempt).alias("attempt"))
        settled = staged(won if settled is None else settled.union(won), "settled")
        pending = staged(drawn.select("kind", "value").join(settled, ["kind", "value"], "left_anti"), "pending")
        if pending.isEmpty():
            return settled
    raise RuntimeError(f"values are left without a surrogate after {ROUNDS} rounds")


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with personal data replaced in whole texts; a column ``count_col`` has the number of mentions.

    ``key`` is the caller's secret: without it nobody can tell which value a surrogate stands for. A first pass finds the
    distinct values of all texts, which are then given surrogates with checks for collisions. A second pass replaces. Nearly
    every value has its first choice, which needs no table; the others reach their texts by a join on a hash of the text,
    broadcast by Spark if their table is small by its measured size. Texts that share a hash get each other's entries, which
    changes nothing, as an entry holds for all documents. The same value has the same surrogate in all documents, and
    different values of a type have different ones.

    Texts without personal data, empty and null texts stay as they are, with a count of 0. Very long texts are read whole, in
    time that grows with their length. Ids play no part, so rows without one or with one that repeats are like any others.
    All other columns stay; an empty table gives none.
    """
    if not key:
        raise ValueError("surrogates need a secret key")
    at, value, entries = fresh(docs, "at", "value", "entries")
    text = F.col(text_col).cast("string")
    source = docs.select(F.xxhash64(text).alias("at"), text.alias("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, kind, value) for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if text
                    for kind, value in {(kind, value) for _, _, kind, value in entities(text)}]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string()))],
                                             names=["at", "kind", "value"])

    mentions = staged(source.mapInArrow(find, "at long, kind string, value string"), "mentions")
    given = assigned(mentions.select("kind", "value").distinct(), key)
    later = staged(
        mentions.join(given.where("attempt > 0"), ["kind", "value"]).distinct().groupBy(F.col("at").alias(at))
        .agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias(entries)), "later")

    @F.pandas_udf("text string, mentions int")
    def replace(texts: pd.Series, rest: pd.Series) -> pd.DataFrame:
        out = []
        for text, entries in zip(texts, rest):
            if text is None or text is pd.NA or text != text:
                out.append((None, 0))
            else:
                out.append(replaced(text, key, {} if entries is None else {(e["kind"], e["value"]): e["surrogate"] for e in entries}))
        return pd.DataFrame(out, columns=["text", "mentions"])

    joined = docs.withColumn(at, F.xxhash64(text)).join(later, at, "left")
    result = joined.withColumn(value, replace(text, F.col(entries)))
    columns = [F.col(value)["text"].alias(c) if c == text_col else F.col(c) for c in docs.columns if c != count_col]
    return result.select(*columns, *([F.col(value)["mentions"].alias(count_col)] if count_col else []))
