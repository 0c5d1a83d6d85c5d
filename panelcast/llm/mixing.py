"""Mixing sources to target weights, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelcast.llm.staging import fresh, staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BLOCK_ROWS = 8_192
SEED = "mix"


def words(text: Column | str) -> Column:
    """Number of runs without space, tab, line feed, vertical tab, form feed and carriage return; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source its rows, size, cap, weight and target.

    Sources in code point order, null last, weigh ``weights`` again and again. All sizes together are shared by
    weight; a target stops at ``max_epochs`` times its source's size and the excess goes to the others by weight.
    That level is found by raising it from below: each round is one aggregate over the sources.
    """
    sources = sized.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    ordered = _ranked(sources, F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    sources = staged(
        ordered.withColumn("weight", F.element_at(cycle, (F.pmod("rank", F.lit(len(weights))) + 1).cast("int")).cast("double"))
        .withColumn("cap", F.col("source_size") * max_epochs).drop("rank"), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    capped = F.lit(False)
    level, before = F.lit(0.0), None
    while True:
        row = sources.agg(F.sum(F.when(capped, F.col("cap")).otherwise(0)).alias("fixed"),
                          F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("free")).first()
        if not row["free"] or row["free"] == before:
            break
        before = row["free"]
        level = F.lit(float(total - row["fixed"]) / row["free"])
        capped = F.col("cap").cast("double") <= level * F.col("weight")
    target = F.when(capped, F.col("cap").cast("double")).otherwise(level * F.col("weight"))
    return sources.withColumn("target", target).select("source", "rows", "source_size", "target")


def _ranked(df: DataFrame, order: Column) -> DataFrame:
    """Rank from 0 in a total order: ranges, their sizes' prefix sums, and ranks inside each range."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(df.repartitionByRange(parts, order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_range").count().withColumn("_start", F.coalesce(F.sum("count").over(before), F.lit(0)))
    inside = Window.partitionBy("_range").orderBy(order)
    return (ranged.join(starts.select("_range", "_start"), "_range")
            .withColumn("rank", F.row_number().over(inside) - 1 + F.col("_start")).drop("_range", "_start"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED,
        block_rows: int = BLOCK_ROWS) -> DataFrame:
    """How many words of each document the mix takes, so that each source gives its target to the word.

    A document's key is a hash of its id. The keys of a source are cut into ranges of about ``block_rows`` rows;
    sizes are summed per range, then over the ranges, then inside each range, so a source that holds a third of
    all rows is many small windows. A source gives all its words once for each whole epoch in its target, and its
    first documents in key order for the rest; the document at the cut gives part of its words.

    Null texts and texts without words have size 0 and give nothing. A null source is a source, the last one. Null
    ids share one key and are ordered by size; rows that repeat an id are documents of their own, and equal ones
    may change places. An empty table gives no rows. The three named columns are read, no others.
    """
    sized = staged(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                               words(text_col).alias("size")), "sizes")
    targets = source_targets(sized, weights, max_epochs)
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    share = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(1 << 32)
    keyed = (sized.withColumn("key", key).alias("d")
             .join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
             .select("doc_id", "d.source", "size", "key", "source_size", "target",
                     F.floor(share * F.ceil(F.col("rows") / block_rows)).alias("block")))
    keyed = staged(keyed, "keyed")
    earlier = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (keyed.groupBy("source", "block").agg(F.sum("size").alias("words"))
              .withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0))).alias("b"))
    inside = Window.partitionBy("k.source", "k.block").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    k = keyed.alias("k")
    placed = (k.join(blocks, F.col("k.source").eqNullSafe(F.col("b.source")) & (F.col("k.block") == F.col("b.block")))
              .withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))))
    budget = F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = F.greatest(F.lit(0), budget - epochs * F.col("source_size") - F.col("before"))
    taken = epochs * F.col("size") + F.least(F.col("size"), rest)
    return placed.select("doc_id", F.col("k.source").alias("source"), "size", "source_size", "target", taken.cast("long").alias("taken"))


def repeated(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", length_col: str = "n_chars") -> DataFrame:
    """Documents as often as the mix takes them: one row per whole copy, and one with the first words for a cut copy.

    Documents that the mix takes nothing from, those without words among them, are left out. Rows of one id, one
    source and one size, null ids among them, share what they give: all the same, and the words that are over one more each. Very long
    texts are cut like others, an empty table gives no rows, and all columns stay, whatever their names.
    """
    key, size, origin, share, over, take, place = fresh(docs, "mix_id", "mix_size", "mix_source", "mix_share", "mix_over", "mix_take", "mix_place")
    groups = staged(mixed.groupBy(F.col("doc_id").alias(key), F.col("size").alias(size), F.col("source").alias(origin))
                    .agg(F.sum("taken").alias("words"), F.count("*").alias("rows")).where("words > 0")
                    .select(key, size, origin, F.floor(F.col("words") / F.col("rows")).alias(share), F.pmod("words", "rows").alias(over)), "shares")
    joined = docs.join(groups, docs[id_col].eqNullSafe(F.col(key)) & (words(F.col(text_col)) == F.col(size))
                       & docs[source_col].cast("string").eqNullSafe(F.col(origin)))
    if groups.where(F.col(over) > 0).isEmpty():
        given = joined.withColumn(take, F.col(share))
    else:
        given = _places(joined, (key, size, origin), place).withColumn(take, F.col(share) + (F.col(place) < F.col(over)).cast("long"))
    copies, rest = F.floor(F.col(take) / F.col(size)).cast("int"), F.pmod(take, size)
    whole = F.array_repeat(F.lit(-1).cast("long"), copies)
    each = given.withColumn(take, F.explode(F.when(rest > 0, F.array_append(whole, rest)).otherwise(whole)))
    runs = F.regexp_extract_all(text_col, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.when(F.col(take) < 0, F.col(text_col)).otherwise(F.array_join(F.slice(runs, F.lit(1), F.col(take).cast("int")), ""))
    out = each.withColumn(text_col, cut)
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.when(F.col(take) < 0, F.col(length_col)).otherwise(F.length(text_col)).cast(docs.schema[length_col].dataType))
    return out.select(*docs.columns)


def _places(rows: DataFrame, group: tuple[str, ...], place: str, parts: int = 64) -> DataFrame:
    """``rows`` with each one's place in its group: counted inside salted parts of it, after those before."""
    part, start = f"{place}_part", f"{place}_start"
    kept = staged(rows.withColumn(part, F.pmod(F.monotonically_increasing_id(), F.lit(parts)).cast("int")), "places")
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = kept.groupBy(*group, part).agg(F.count("*").alias("n")).withColumn(start, F.coalesce(F.sum("n").over(before), F.lit(0)))
    starts = starts.select(*[F.col(c).alias(f"{c}_of") for c in (*group, part)], start)
    same = F.lit(True)
    for c in (*group, part):
        same = same & kept[c].eqNullSafe(starts[f"{c}_of"])
    inside = Window.partitionBy(*group, part).orderBy(part)
    return (kept.join(starts, same).withColumn(place, F.row_number().over(inside) - 1 + F.col(start))
            .drop(*[f"{c}_of" for c in (*group, part)], part, start))
