"""Spelling variants: words one edit apart, by pairs of trie nodes, and each word's most frequent form."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelcast.llm.staging import staged

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMAGE = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
#: Nodes up to this depth are numbered by their code points (21 bits each), so that no join has them as hot keys.
DIRECT_DEPTH = 2
BATCH_ROWS = 20_000
PLACES = pa.schema([("word_id", pa.int64()), ("n", pa.int64()), ("skips", pa.bool_()), ("first", pa.bool_()),
                    ("p", pa.int64()), ("prefix", pa.binary()), ("s", pa.int64()), ("suffix", pa.binary())])
PLACES_DDL = "word_id long, n long, skips boolean, first boolean, p long, prefix binary, s long, suffix binary"


def lowered(run: Column) -> Column:
    """A-Z in lower case and nothing else; the slow translation only where ``lower`` would do more."""
    return F.when(run.rlike("[^A-Za-z]"), F.translate(run, UPPER, LOWER)).otherwise(F.lower(run))


def counted_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pattern: str = RUN, damage: int = DAMAGE,
                  least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word`` and its occurrences ``n`` in whole texts, after every ``damage``-th run by hash has lost a code point.

    Null texts hold no runs; a null id is an empty string in the hash. Repeated rows count as often as they come.
    """
    runs = (docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                        F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"({pattern})"), F.lit(1))).alias("run"))
            .where(F.length("run") >= least_length).select("id", lowered(F.col("run")).alias("run"))
            .withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))))
    place = F.pmod(F.col("h"), F.length("run").cast("long")).cast("int")
    shorter = F.concat(F.expr("substring(run, 1, int(pmod(h, length(run))))"), F.col("run").substr(place + 2, F.length("run")))
    word = F.when(F.col("h") % damage == 0, shorter).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).where(F.length("word") >= least_length)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count))


def _nodes(word: str) -> tuple[list[int | None], list[bytes | None]]:
    """For each depth the node its letters lead to: a number below zero if shallow, else a digest of the whole path."""
    numbers, paths, path, number = [-1], [None], hashlib.blake2b(digest_size=16), 0
    for depth, letter in enumerate(word, 1):
        path.update(letter.encode("utf-8", "surrogatepass"))
        number = (number << 21) + ord(letter) + 1 if depth <= DIRECT_DEPTH else None
        numbers.append(None if number is None else -1 - number)
        paths.append(path.copy().digest() if number is None else None)
    return numbers, paths


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each pair of nodes of each word, in time and space linear in its length."""
    def part(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(PLACES), PLACES)], schema=PLACES)

    rows: list[tuple] = []
    for batch in batches:
        for word_id, n, word in zip(*(batch.column(i).to_pylist() for i in range(3))):
            down, up = _nodes(word), _nodes(word[::-1])
            size = len(word)
            for i in range(size + 1):
                rows.append((word_id, n, False, True, down[0][i], down[1][i], up[0][size - i], up[1][size - i]))
                if i < size:
                    rows.append((word_id, n, True, i == 0 or word[i] != word[i - 1], down[0][i], down[1][i], up[0][size - i - 1], up[1][size - i - 1]))
                if len(rows) >= BATCH_ROWS:
                    yield part(rows)
                    rows = []
    yield part(rows)


def _numbered(places: DataFrame, number: str, path: str) -> DataFrame:
    """``places`` with the numbers of the deep nodes, too: each is listed once and numbered from zero.

    The list is written before it is joined, so that a task that runs again finds the same numbers.
    """
    listed = staged(places.where(F.col(path).isNotNull()).select(F.col(path).alias("at")).distinct()
                    .withColumn("listed", F.monotonically_increasing_id()), "nodes")
    deep = places.where(F.col(path).isNotNull()).join(listed, F.col(path) == F.col("at")).withColumn(number, F.col("listed"))
    return places.where(F.col(path).isNull()).drop(path).unionByName(deep.drop("at", "listed", path))


def near_words(words: DataFrame) -> DataFrame:
    """Per ``word_id`` that has any: ``n_near``, its words at one edit, and ``best``, the most frequent as (-n, word_id).

    A word of length m has, for each i, the pair (node of its first i letters, node of its letters after i + 1 in the
    reversed trie), which skips letter i, and the pair of nodes that skips none. Words of one length that share a skipping
    pair differ in that letter; a skipping pair that equals a closed pair of another word is an inserted letter.
    In a run of equal letters only the first skip meets closed pairs, so each neighbour is met exactly once. A pair of
    nodes has at most one closed word and one skipping word for each letter of the alphabet, so a group never grows
    with the data, and its members are counted and ranked, never paired.
    """
    places = staged(words.select("word_id", "n", "word").mapInArrow(_places, PLACES_DDL), "places")
    pairs = _numbered(_numbered(places, "p", "prefix"), "s", "suffix")
    member = F.struct((-F.col("n")).alias("rank"), "word_id", "skips", "first")
    groups = (pairs.groupBy("p", "s").agg(F.sort_array(F.collect_list(member)).alias("members"))
              .where("size(members) > 1 and exists(members, x -> x.skips)"))
    meets = "x.word_id <> m.word_id and (x.skips and m.skips or x.skips and x.first or m.skips and m.first)"
    met = groups.select("members", F.explode("members").alias("m")).select(
        "m.word_id", F.expr(f"filter(members, x -> {meets})").alias("others")).where("size(others) > 0")
    first = F.element_at("others", 1)
    return met.groupBy("word_id").agg(F.sum(F.size("others")).cast("long").alias("n_near"),
                                      F.min(F.struct(first["rank"].alias("rank"), first["word_id"].alias("word_id"))).alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """The last word that following ``form_id`` from each ``word_id`` leads to, by doubling the steps.

    Every step multiplies the count by ``RATIO`` at least, so a chain is as long as a logarithm of the largest count.
    """
    reached = staged(links.select("word_id", F.col("form_id").alias("root_id")), "roots")
    while True:
        on = reached.select(F.col("word_id").alias("at"), F.col("root_id").alias("next"))
        longer = staged(reached.join(on, F.col("root_id") == F.col("at"), "left")
                        .select("word_id", F.coalesce("next", "root_id").alias("root_id"), F.col("next").isNotNull().alias("moved")), "roots")
        reached = longer.drop("moved")
        if longer.where("moved").isEmpty():
            return reached


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO, **counting) -> DataFrame:
    """Every frequent word with its form: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words are near if one inserted, deleted or replaced code point makes them equal. The form is the near word with the
    largest count (ties: the smallest in code-point order) if that is ``ratio`` times the word's own, else null; the root
    is where following forms ends, the word itself if it has none. The remaining parameters are those of ``counted_words``.

    Null and empty texts, and texts without runs, add nothing; very long texts are read whole; repeated rows and
    repeated or null ids count like any row; an empty table gives no rows. Other columns are not read, whatever their
    names. Words are numbered in sorted order, so integers carry the order of ties through all shuffles.
    """
    counts = staged(counted_words(docs, id_col, text_col, **counting), "counts")
    words = staged(counts.orderBy("word").withColumn("word_id", F.monotonically_increasing_id()), "words")
    best = staged(near_words(words), "near")
    is_form = -F.col("best.rank") >= ratio * F.col("n")
    formed = staged(words.join(best, "word_id", "left").select(
        "word_id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best.word_id")).alias("form_id"), F.when(is_form, -F.col("best.rank")).alias("form_n")), "formed")
    ends = roots(formed.where("form_id is not null").select("word_id", "form_id"))
    named = lambda number, name: words.select(F.col("word_id").alias(number), F.col("word").alias(name))
    linked = (formed.where("form_id is not null").join(ends, "word_id")
              .join(named("form_id", "form"), "form_id").join(named("root_id", "root"), "root_id"))
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    alone = formed.where("form_id is null").select(
        "word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    return linked.select(*columns).unionByName(alone.select(*columns))
