"""Table statistics: per-column summaries, histograms and correlations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, functions as F


def describe_columns(df: DataFrame, columns, exact_distinct: bool = False) -> DataFrame:
    """One row per column: count, nulls, min, max, mean, std and distinct values, from one aggregate.

    Distinct values are counted by sketch unless ``exact_distinct`` is set. Columns must be numeric.
    """
    distinct = F.countDistinct if exact_distinct else F.approx_count_distinct
    measures = {
        "count": F.count, "nulls": lambda c: F.count_if(F.col(c).isNull()),
        "min": lambda c: F.min(F.col(c).cast("double")), "max": lambda c: F.max(F.col(c).cast("double")),
        "mean": F.avg, "std": F.stddev_samp, "distinct": distinct,
    }
    wide = df.agg(*[make(c).alias(f"{c}__{m}") for c in columns for m, make in measures.items()])
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{m}").alias(m) for m in measures]) for c in columns
    ]
    return wide.select(F.inline(F.array(*rows)))


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts of equal-width bins between the column's minimum and maximum."""
    bounds = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    lo, hi = bounds.getField("lo"), bounds.getField("hi")
    width = F.greatest(hi - lo, F.lit(5e-324))
    index = F.least(F.floor((F.col(column) - lo) * bins / width), F.lit(bins - 1)).cast("int")
    return (
        df.filter(F.col(column).isNotNull()).select(index.alias("bin"))
        .groupBy("bin").agg(F.count(F.lit(1)).alias("rows"))
    )


def correlations(df: DataFrame, columns) -> DataFrame:
    """Pearson correlation of every pair of columns, from one aggregate."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    rows = [
        F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.col(f"_{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ]
    return wide.select(F.inline(F.array(*rows)))


# --- states that merge ------------------------------------------------------------------------

def column_states(df: DataFrame, columns, by=()) -> DataFrame:
    """One row per group of ``by`` and column: counts, bounds, moments, and sketches of distinct values and quantiles.

    The rows of different parts of a table merge (``merged_states``) into what the whole table would have given: counts and
    bounds exactly, moments up to rounding, sketches within their error.
    """
    value = lambda c: F.col(c).cast("double")
    measures = {
        "count": lambda c: F.count(c), "nulls": lambda c: F.count_if(F.col(c).isNull()), "min": lambda c: F.min(value(c)),
        "max": lambda c: F.max(value(c)), "mean": lambda c: F.avg(value(c)), "m2": lambda c: F.var_pop(value(c)) * F.count(c),
        "distinct": lambda c: F.hll_sketch_agg(F.col(c).cast("string")), "quantiles": lambda c: F.kll_sketch_agg_double(value(c)),
    }
    wide = df.groupBy(*by).agg(*[make(c).alias(f"{c}__{m}") for c in columns for m, make in measures.items()])
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{m}").alias(m) for m in measures]) for c in columns]
    return wide.select(*by, F.inline(F.array(*rows)))


def merged_states(states: DataFrame, by=()) -> DataFrame:
    n, mean = F.sum("count"), F.sum(F.col("mean") * F.col("count")) / F.sum("count")
    between = F.sum(F.col("count") * F.col("mean") * F.col("mean")) - n * mean * mean
    return states.groupBy(*by, "column").agg(
        n.alias("count"), F.sum("nulls").alias("nulls"), F.min("min").alias("min"), F.max("max").alias("max"), mean.alias("mean"),
        (F.sum("m2") + F.greatest(between, F.lit(0.0))).alias("m2"), F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )


def summarised(states: DataFrame, quantiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """Readable statistics from merged states; ``distinct`` and quantiles are estimates."""
    named = [F.when(F.col("count") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(q))).alias(f"p{round(100 * q)}") for q in quantiles]
    return states.select(
        "column", "count", "nulls", "min", "max", "mean", F.when(F.col("count") > 1, F.sqrt(F.col("m2") / (F.col("count") - 1))).alias("std"),
        F.hll_sketch_estimate("distinct").alias("distinct"), *named)


def estimated_histogram(states: DataFrame, bins: int = 20) -> DataFrame:
    """Bins of every column that hold equally many rows, within the sketch's error: their bounds and rows."""
    inner = [F.kll_sketch_get_quantile_double("quantiles", F.lit(i / bins)) for i in range(1, bins)]
    edges = [F.col("min"), *inner, F.col("max")]
    each = [F.struct(F.lit(i).alias("bin"), edges[i].alias("lo"), edges[i + 1].alias("hi"), (F.col("count") / bins).alias("rows")) for i in range(bins)]
    return states.filter(F.col("count") > 0).select("column", F.inline(F.array(*each)))


def pair_states(df: DataFrame, columns, by=()) -> DataFrame:
    """Per pair of columns the counts, means and sums of products about the means of rows that have both."""
    pairs = list(combinations(columns, 2))
    made = []
    for i, (a, b) in enumerate(pairs):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y, n = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double")), F.count_if(both)
        made += [n.alias(f"_n{i}"), F.avg(x).alias(f"_mx{i}"), F.avg(y).alias(f"_my{i}"), (F.var_pop(x) * n).alias(f"_xx{i}"),
                 (F.var_pop(y) * n).alias(f"_yy{i}"), (F.covar_pop(x, y) * n).alias(f"_xy{i}")]
    wide = df.groupBy(*by).agg(*made)
    rows = [F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), *[F.col(f"_{m}{i}").alias(m) for m in ("n", "mx", "my", "xx", "yy", "xy")])
            for i, (a, b) in enumerate(pairs)]
    return wide.select(*by, F.inline(F.array(*rows)))


def merged_correlations(states: DataFrame) -> DataFrame:
    """Pearson correlations of the whole from the states of its parts."""
    n, mx, my = F.sum("n"), F.sum(F.col("mx") * F.col("n")) / F.sum("n"), F.sum(F.col("my") * F.col("n")) / F.sum("n")
    total = lambda own, a, b, ma, mb: F.sum(own) + F.sum(F.col("n") * F.col(a) * F.col(b)) - n * ma * mb
    sums = states.filter(F.col("n") > 0).groupBy("first", "second").agg(
        total("xx", "mx", "mx", mx, mx).alias("xx"), total("yy", "my", "my", my, my).alias("yy"), total("xy", "mx", "my", mx, my).alias("xy"))
    return sums.select("first", "second", F.when((F.col("xx") > 0) & (F.col("yy") > 0), F.col("xy") / F.sqrt(F.col("xx") * F.col("yy"))).alias("corr"))
