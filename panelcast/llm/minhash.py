"""Near-duplicate documents: minima of universal hashes, banding, two verifications, and connected components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from panelcast.llm.components import connected_components
from panelcast.llm.staging import Temporary, fresh, staged

SHINGLE = 5
PERCENT = 75
BANDS = 32
ROWS = 4
#: Minima that must agree before full sets are compared; at the least similarity 0.75 this many of 128 are all but certain.
LEAST_AGREEING = 0.55
SEED = 8
TILE_ROWS = 512
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
SHIFT = np.uint64(33)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    for factor in MIX:
        x = (x ^ (x >> SHIFT)) * factor
    return x ^ (x >> SHIFT)


def random_factors(count: int, seed: int) -> np.ndarray:
    """Odd 64-bit numbers."""
    return np.random.default_rng(seed).integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct shingles of words; a shorter text is one shingle, of its own length."""
    tokens = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not tokens:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    hashed = np.fromiter(map(digest, tokens), np.uint64, len(tokens))
    length = min(size, len(tokens))
    total = np.full(len(tokens) - length + 1, length, np.uint64)
    for i, factor in enumerate(random_factors(length, SEED)):
        total += hashed[i:i + len(total)] * factor
    return np.unique(_mixed(total))


def signature(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray, block: int = 512) -> np.ndarray:
    """The smallest value of every hash function ``(factor * x + shift) mod 2^64``, its upper half."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), block):
        values = np.multiply.outer(shingles[at:at + block], factors)
        values += shifts
        np.minimum(least, values.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


class NearDuplicates:
    """Links documents whose shingle sets have a Jaccard similarity of ``percent`` or more.

    1. Every text becomes its shingle set, a print of that set, and ``bands * rows`` minima. Texts with equal
       sets are one class from here on, represented by a number.
    2. The minima of a band are a bucket's key. In each bucket the classes are paired with its smallest one only.
       Pairs whose sizes or signatures rule the similarity out go; the rest is confirmed on full sets.
    3. Connected components of those links. Buckets whose members are all in one component are finished, however
       large. The others are cut into blocks of about ``tile_rows``; every pair of blocks is a tile. Its open pairs are of
       different components, alike by signature, and meet in no earlier band. The members that have any are compared on
       full sets inside the tile, the most alike first, and a pair that others have connected by then is left out. A
       tile gives the links that connect its members, never its pairs. Then the components are joined.

    So no link that the bands find is lost, and no group is expanded into all its pairs. With the defaults a pair at
    similarity 0.75 misses all bands five times in a million.

    A text without words (empty, null) has no set and links with nothing. Classes are numbered, so those whose rows have
    only null ids are compared like any other; a component of null ids alone is null. Rows that repeat an id are one
    document: the classes of its texts are in one component. Very long texts are read whole. Other columns are not read.
    """

    def __init__(self, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
                 bands: int = BANDS, rows: int = ROWS, seed: int = SEED, tile_rows: int = TILE_ROWS):
        self.id_col, self.text_col, self.shingle, self.percent = id_col, text_col, shingle, percent
        self.bands, self.rows, self.seed, self.tile_rows = bands, rows, seed, tile_rows
        self.least = int(LEAST_AGREEING * percent / PERCENT * bands * rows)

    def classify(self, docs: DataFrame) -> DataFrame:
        """Per row ``doc_id``, ``n_shingles``, ``component_id``, ``kept``; an empty table gives no rows."""
        source = docs.select(F.col(self.id_col).cast("long").alias("doc_id"), F.col(self.text_col).cast("string").alias("text"))
        prints = staged(self._prints(source), "prints")
        of_class = self._components(prints, source)
        return (prints.select("doc_id", "n", "print").join(of_class, "print", "left")
                .select("doc_id", F.col("n").alias("n_shingles"),
                        F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id"))
                .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))

    def _components(self, prints: DataFrame, source: DataFrame) -> DataFrame:
        """``print``, ``component`` (a number) and ``smallest``, the smallest id in it, of every class."""
        with Temporary(prints.sparkSession) as own:
            nodes = staged(prints.where("n > 0").groupBy("print").agg(
                F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("signature").alias("signature"))
                .withColumn("rep", F.monotonically_increasing_id()), "classes")
            buckets = staged(self._buckets(nodes), "buckets")

            near = lambda a, b: F.least(a, b) * 100 >= F.greatest(a, b) * self.percent
            pairs = buckets.where("rep <> pivot").where(near("n", "pivot_n")).select(F.col("rep").alias("x"), F.col("pivot").alias("y")).distinct()
            links = staged(self._confirmed(pairs, nodes, source).union(_same_id(prints, nodes)), "links")
            found = staged(connected_components(links, "x", "y"), "components")

            unsettled = staged(self._open_members(buckets, nodes, found), "open")
            if not unsettled.isEmpty():
                more = self._connecting_links(unsettled, nodes, source)
                found = connected_components(found.select(F.col("node").alias("x"), F.col("component").alias("y")).union(more), "x", "y")
            placed = own.keep(staged(nodes.select("print", "rep", "doc_id").join(found, F.col("rep") == F.col("node"), "left")
                            .select("print", "doc_id", F.coalesce("component", "rep").alias("component")), "placed"))
        return placed.join(placed.groupBy("component").agg(F.min("doc_id").alias("smallest")), "component").select("print", "component", "smallest")

    def _prints(self, source: DataFrame) -> DataFrame:
        shingle, count, seed = self.shingle, self.bands * self.rows, self.seed
        factors, shifts = random_factors(count, seed + 1), random_factors(count, seed + 2)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes, prints, signatures = [], [], []
                for text in batch.column(1):
                    members = shingle_set(text.as_py(), shingle)
                    sizes.append(len(members))
                    prints.append(hashlib.blake2b(members.tobytes(), digest_size=16).digest())
                    signatures.append(signature(members, factors, shifts).tobytes() if len(members) else None)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                                                  pa.array(signatures, pa.binary())], names=["doc_id", "n", "print", "signature"])

        return source.mapInArrow(run, "doc_id long, n long, print binary, signature binary")

    def _buckets(self, nodes: DataFrame) -> DataFrame:
        """Members of buckets with more than one, with the bucket's smallest member."""
        bands, rows, seed = self.bands, self.rows, self.seed

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            factors, salts = random_factors(rows, seed + 3), random_factors(bands, seed + 4)
            for batch in batches:
                minima = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(-1, bands, rows).astype(np.uint64)
                keys = _mixed((minima * factors).sum(axis=2, dtype=np.uint64) ^ salts).view(np.int64)
                each = np.repeat(np.arange(batch.num_rows), bands)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(each)), batch.column(1).take(pa.array(each)),
                                                  pa.array(np.tile(np.arange(bands, dtype=np.int32), batch.num_rows)), pa.array(keys.ravel())], names=["rep", "n", "band", "key"])

        keyed = nodes.select("rep", "n", "signature").mapInArrow(run, "rep long, n long, band int, key long")
        pivots = (keyed.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("p"), F.count("*").alias("members")).where("members > 1")
                  .select("key", "members", F.col("p.rep").alias("pivot"), F.col("p.n").alias("pivot_n")))
        return keyed.join(pivots, "key")

    def _confirmed(self, pairs: DataFrame, nodes: DataFrame, source: DataFrame) -> DataFrame:
        """The pairs alike by signature, and then by full sets."""
        least, percent = self.least, self.percent

        def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for i in (2, 3))
                yield batch.select([0, 1]).filter(pa.array((a == b).sum(axis=1) >= least))

        def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = [_similar(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64), percent)
                        for a, b in zip(batch.column(2), batch.column(3))]
                yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

        def sided(df: DataFrame, value: str) -> DataFrame:
            of = lambda end: df.select(F.col("rep").alias(end), F.col(value).alias(f"{value}_{end}"))
            return lambda rows: rows.join(of("x"), "x").join(of("y"), "y").select("x", "y", f"{value}_x", f"{value}_y")

        likely = staged(sided(nodes, "signature")(pairs).mapInArrow(alike, "x long, y long"), "likely")
        ends = likely.select(F.col("x").alias("rep")).union(likely.select("y")).distinct()
        return sided(self._sets(ends, nodes, source), "members")(likely).mapInArrow(confirm, "x long, y long")

    def _sets(self, reps: DataFrame, nodes: DataFrame, source: DataFrame) -> DataFrame:
        """The full shingle sets of some classes. Their ids are written first, so that Spark knows their size and sends
        them to the texts while it is small, and not the texts to them."""
        shingle = self.shingle

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                members = [shingle_set(text.as_py(), shingle) for text in batch.column(1)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array([hashlib.blake2b(m.tobytes(), digest_size=16).digest() for m in members], pa.binary()),
                    pa.array([m.tobytes() for m in members], pa.binary())], names=["id", "print", "members"])

        needed = staged(reps.join(nodes.select("rep", "print", F.col("doc_id").alias("id")), "rep"), "ids")
        ids = needed.where("id is not null").select("id").distinct()
        texts = source.join(ids, F.col("doc_id") == F.col("id"), "left_semi")
        if not needed.where("id is null").isEmpty():
            texts = texts.union(source.where("doc_id is null"))
        full = (texts.select("doc_id", "text").mapInArrow(sets, "id long, print binary, members binary").drop("id")
                .join(needed.select("rep", "print"), "print").groupBy("rep", "print").agg(F.first("members").alias("members")))
        return staged(full, "sets")

    def _open_members(self, buckets: DataFrame, nodes: DataFrame, found: DataFrame) -> DataFrame:
        """The members of a tile that have open pairs in it, once for each tile."""
        least, percent, bands = self.least, self.percent, self.bands
        placed = (buckets.where("members > 2").join(found, F.col("rep") == F.col("node"), "left")
                  .select("key", "band", "rep", "n", "pivot", "members", F.coalesce("component", "rep").alias("component")))
        mixed = placed.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("key")
        tiled = (placed.where("rep <> pivot").join(mixed, "key").withColumn("blocks", F.ceil(F.col("members") / self.tile_rows).cast("int"))
                 .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .select("key", "band", "rep", "n", "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                         (F.col("block") > F.col("other")).alias("second"))
                 .join(nodes.select("rep", "print", "signature"), "rep"))
        member = F.struct("rep", "n", "component", "second", "print", "signature")
        tiles = tiled.groupBy("key", "band", "i", "j").agg(F.collect_list(member).alias("members"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parts = []
                for t in range(batch.num_rows):
                    rows = batch.column("members")[t].values
                    x, y, _ = _candidates(rows, batch.column("i")[t].as_py() != batch.column("j")[t].as_py(), batch.column("band")[t].as_py(), bands, least, percent)
                    ends = pa.array(np.union1d(x, y))
                    where = [pa.array([batch.column(c)[t].as_py()] * len(ends), batch.schema.field(c).type) for c in ("key", "band", "i", "j")]
                    parts.append(pa.RecordBatch.from_arrays([*where, rows.take(ends)], names=["key", "band", "i", "j", "member"]))
                yield from parts

        return (tiles.mapInArrow(run, "key long, band int, i int, j int, member struct<rep: long, n: long, component: long, second: boolean, "
                                      "print: binary, signature: binary>").select("key", "band", "i", "j", "member.*"))

    def _connecting_links(self, unsettled: DataFrame, nodes: DataFrame, source: DataFrame) -> DataFrame:
        """Links among the members of each tile, enough to connect all that are."""
        least, percent, bands = self.least, self.percent, self.bands
        full = self._sets(unsettled.select("rep").distinct(), nodes, source)
        member = F.struct("rep", "n", "component", "second", "signature", "members")
        tiles = unsettled.join(full, ["rep", "print"]).groupBy("key", "band", "i", "j").agg(F.collect_list(member).alias("members"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: list[tuple[int, int]] = []
                for t in range(batch.num_rows):
                    rows = batch.column("members")[t].values
                    x, y, alike = _candidates(rows, batch.column("i")[t].as_py() != batch.column("j")[t].as_py(), batch.column("band")[t].as_py(), bands, least, percent)
                    sets = [np.frombuffer(m.as_buffer(), np.uint64) for m in rows.field("members")]
                    rep, group = rows.field("rep").to_numpy(), rows.field("component").to_numpy().copy()
                    for k in np.argsort(-alike, kind="stable"):
                        a, b = x[k], y[k]
                        if group[a] != group[b] and _similar(sets[a], sets[b], percent):
                            out.append((int(rep[a]), int(rep[b])))
                            group[group == group[b]] = group[a]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in (0, 1)], names=["x", "y"])

        return tiles.mapInArrow(run, "x long, y long")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    together = np.concatenate([a, b])
    together.sort()
    common = int((together[1:] == together[:-1]).sum())
    return 100 * common >= percent * (len(together) - common)


def _candidates(rows: pa.StructArray, crossed: bool, band: int, bands: int, least: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Open pairs of a tile, as two arrays of places, and how many minima they share."""
    n, component = rows.field("n").to_numpy(), rows.field("component").to_numpy()
    second = rows.field("second").to_numpy(zero_copy_only=False)
    minima = np.frombuffer(b"".join(rows.field("signature").to_pylist()), np.uint32).reshape(len(n), bands, -1)
    a, b = (np.flatnonzero(~second), np.flatnonzero(second)) if crossed else (np.arange(len(n)),) * 2
    found: list[list] = [[], [], []]
    for i in a:
        there = b if crossed else b[b > i]
        there = there[(component[there] != component[i]) & (np.minimum(n[there], n[i]) * 100 >= np.maximum(n[there], n[i]) * percent)]
        equal = minima[there] == minima[i]
        alike = equal.sum(axis=(1, 2))
        open_here = (alike >= least) & ~equal[:, :band].all(axis=2).any(axis=1)
        found[0].append(np.full(int(open_here.sum()), i))
        found[1].append(there[open_here])
        found[2].append(alike[open_here])
    return tuple(np.concatenate([np.zeros(0, np.int64), *part]).astype(np.int64) for part in found)


def _same_id(prints: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links between the classes of one id, each to the id's first class."""
    known = prints.where("n > 0 and doc_id is not null").select("doc_id", "print")
    several = known.groupBy("doc_id").agg(F.min("print").alias("a"), F.max("print").alias("b")).where("a <> b").select("doc_id")
    shared = (known.join(several, "doc_id", "left_semi").distinct().join(nodes.select("print", "rep"), "print")).select("doc_id", "rep")
    first = shared.groupBy("doc_id").agg(F.min("rep").alias("first"))
    return shared.join(first, "doc_id").where("rep <> first").select(F.col("rep").alias("x"), F.col("first").alias("y"))


def keep_one(docs: DataFrame, near: NearDuplicates) -> DataFrame:
    """The rows of one document of every group of near-duplicates, once each; all columns stay.

    It is the document with the smallest id, of an id's texts the one whose print is least; in a group without ids that
    print decides alone. A text without words is in no group: it stays, once for each id, and always if the id is null.
    An empty table stays empty.
    """
    source = docs.select(F.col(near.id_col).cast("long").alias("doc_id"), F.col(near.text_col).cast("string").alias("text"))
    prints = staged(near._prints(source), "prints")
    rows = staged(prints.select("doc_id", "n", "print").join(near._components(prints, source), "print", "left"), "groups")
    times = rows.groupBy("doc_id").agg(F.count("*").alias("times"))
    odd_ids = staged(times.where("doc_id is null or times > 1").select("doc_id"), "odd_ids")
    # those that go are fewer than those that stay, and their table's size is known
    gone = staged(rows.where("n > 0 and doc_id <> smallest").select("doc_id").union(odd_ids.where("doc_id is not null")).distinct(), "gone")
    known = docs[near.id_col].cast("long")
    kept = docs.where(known.isNotNull()).join(gone, known == gone["doc_id"], "left_anti")
    if odd_ids.isEmpty():
        return kept
    chosen = (rows.where("n > 0").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "print")).alias("least"))
              .select("least.doc_id", "least.print"))
    wanted = staged(chosen.union(rows.where("n = 0").select("doc_id", "print").distinct()), "chosen")

    @F.pandas_udf("struct<n: int, print: binary>")
    def printed(texts: pd.Series) -> pd.DataFrame:
        sets = [shingle_set(t, near.shingle) for t in texts]
        return pd.DataFrame({"n": [len(s) for s in sets], "print": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]})

    (mark,) = fresh(docs, "mark")
    odd = (docs.join(odd_ids, known.eqNullSafe(odd_ids["doc_id"]), "left_semi")
           .withColumn(mark, printed(F.col(near.text_col).cast("string"))))
    odd = odd.join(wanted, odd[near.id_col].cast("long").eqNullSafe(wanted["doc_id"]) & (odd[f"{mark}.print"] == wanted["print"]), "left_semi")
    empty = F.col(near.id_col).isNull() & (F.col(f"{mark}.n") == 0)
    (key,) = fresh(odd, "key")
    odd = staged(odd.withColumn(key, F.when(empty, F.monotonically_increasing_id())), "odd")
    single = odd.where(F.col(key).isNull()).withColumn(f"{key}p", F.col(f"{mark}.print")).dropDuplicates([near.id_col, f"{key}p"]).drop(f"{key}p")
    return kept.union(single.drop(mark, key)).union(odd.where(F.col(key).isNotNull()).drop(mark, key))
