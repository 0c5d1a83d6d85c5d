"""Versioned feature tables: keyed upsert by day, documented columns, views and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from panelcast.operators.windows import between_hours
from panelcast.schemas import COLUMN_DOCS, KEYS, PANEL, ROW_KEYS, TIME
from panelcast.sources.commits import claim, commit, head, new_folder, retain
from panelcast.sources.paths import _path, remove, versions

DAY = "day"
ROWS = "rows"


def table_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v={version}"


def latest_by_key(df: DataFrame, on=ROW_KEYS, order: str | None = None) -> DataFrame:
    """One row per key: the one that landed last by ``order``.

    Without an order, or with equal ones, rows of a key must be equal: which of two different values
    is the correction cannot be told, and the job fails rather than choose.
    """
    rest = [c for c in df.columns if c not in on and c != order]
    row = F.struct(*rest)
    if order is None:
        low, high = F.min(row), F.max(row)
    else:
        numeric = isinstance(df.schema[order].dataType, T.NumericType)
        at = F.coalesce((F.col(order) if numeric else F.col(order).cast("timestamp")).cast("double"), F.lit(float("-inf")))
        low = F.min(F.struct((-at).alias("o"), row.alias("r")))["r"]
        high = F.max(F.struct(at.alias("o"), row.alias("r")))["r"]
    text = F.concat(F.lit("different rows for one key landed together: "), *[F.concat(F.col(c).cast("string"), F.lit(" ")) for c in on])
    chosen = df.groupBy(*on).agg(low.alias("_low"), high.alias("_row")).withColumn(
        "_row", F.when(F.col("_low").eqNullSafe(F.col("_row")), F.col("_row")).otherwise(F.raise_error(text).cast(df.select(*rest).schema))
    )
    columns = [c for c in df.columns if c != order]
    return chosen.select(*[F.col(c) if c in on else F.col(f"_row.{c}").alias(c) for c in columns])


def _by_day(df: DataFrame) -> DataFrame:
    """One shuffle to day order; the rebalance splits large days and merges small ones."""
    return df.hint("rebalance", DAY)


def _write_days(spark: SparkSession, df: DataFrame, path: str) -> dict[str, str]:
    """Write rows by day to a new folder, in files sorted for row-group skipping; the folder of each day."""
    folder = new_folder(path, "days")
    df.sortWithinPartitions(DAY, *KEYS, TIME).write.partitionBy(DAY).parquet(folder)
    jvm_path, fs = _path(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(jvm_path) if s.isDirectory()]
    return {n.removeprefix(f"{DAY}="): f"{folder}/{n}" for n in names if n.startswith(f"{DAY}=")}


def merge_rows(stored: DataFrame, incoming: DataFrame, on=ROW_KEYS) -> DataFrame:
    """Incoming rows replace stored rows of the same key; all other rows stay."""
    kept = stored.join(incoming.select(*on), list(on), "left_anti")
    return kept.unionByName(incoming)


def upsert(
    spark: SparkSession, path: str, incoming: DataFrame, schema: T.StructType = PANEL, order: str | None = None, merge: bool = True,
) -> None:
    """Insert or replace rows by series and hour; ``order`` is the column that says which row of a key landed last.

    Only the days present in the batch are read and written, once, to a new folder; a commit then puts them in the place of
    the old ones. A run that stops before its commit changes nothing, and a second writer of the same days is refused.
    With ``merge=False`` the batch is added as a layer on its days, without reading them: cheap for few late rows, merged
    by readers until ``compact``.
    """
    rows = incoming.select(*schema.names, *([order] if order else []))
    batch = latest_by_key(rows, order=order).withColumn(DAY, F.to_date(TIME))
    base = head(spark, path)
    if not merge or not base.of(ROWS):
        written = _write_days(spark, _by_day(batch), path)
    else:
        batch = batch.persist()
        try:
            days = {str(r[0]) for r in batch.select(DAY).distinct().collect()}
            stored = layers_of(spark, {d: f for d, f in base.of(ROWS).items() if d in days}, schema)
            merged = batch if stored is None else merge_rows(stored.withColumn(DAY, F.to_date(TIME)), batch)
            written = _write_days(spark, _by_day(merged), path)
        finally:
            batch.unpersist()
    if written or not base.number:
        below = {} if merge else base.of(ROWS)
        commit(spark, path, base, {ROWS: {day: [*below.get(day, []), folder] for day, folder in written.items()}})


def compact(spark: SparkSession, path: str, schema: T.StructType = PANEL) -> list[str]:
    """Merge the layers of every day that has several; returns those days."""
    base = head(spark, path)
    layered = {day: folders for day, folders in base.of(ROWS).items() if len(folders) > 1}
    if layered:
        rows = layers_of(spark, layered, schema).withColumn(DAY, F.to_date(TIME))
        written = _write_days(spark, _by_day(rows), path)
        commit(spark, path, base, {ROWS: {day: [written[day]] for day in layered}})
    return sorted(layered)


def layers_of(spark: SparkSession, days: dict[str, list[str]], schema: T.StructType) -> DataFrame | None:
    """The rows of some days; where a day has layers, the row of a key in the newest of them."""
    read = lambda paths: spark.read.schema(schema).parquet(*sorted(paths))
    single = [f[0] for f in days.values() if len(f) == 1]
    parts = [read(single)] if single else []
    depth = max(map(len, days.values()), default=0)
    if depth > 1:
        layers = [read([f[k] for f in days.values() if len(f) > max(k, 1)]).withColumn("_layer", F.lit(k)) for k in range(depth)]
        stacked = layers[0]
        for layer in layers[1:]:
            stacked = stacked.unionByName(layer)
        rest = [c for c in schema.names if c not in ROW_KEYS]
        newest = stacked.groupBy(*ROW_KEYS).agg(F.max_by(F.struct(*rest), "_layer").alias("_row"))
        parts.append(newest.select(*[F.col(c) if c in ROW_KEYS else F.col(f"_row.{c}").alias(c) for c in schema.names]))
    if len(parts) == 2:
        return parts[0].unionByName(parts[1])
    return parts[0] if parts else None


def _stored(spark: SparkSession, path: str, schema: T.StructType, first: str = "", last: str = "9999-12-31") -> DataFrame:
    """The rows of the newest commit's days from ``first`` to ``last``; days outside are not even listed."""
    state = head(spark, path)
    if not state.number:
        raise FileNotFoundError(f"no feature table at {path}")
    rows = layers_of(spark, {d: f for d, f in state.of(ROWS).items() if first <= d <= last}, schema)
    return spark.createDataFrame([], schema) if rows is None else rows


def read_table(spark: SparkSession, path: str, schema: T.StructType = PANEL) -> DataFrame:
    """The whole feature table in contract column order, with documented columns."""
    return describe(_stored(spark, path, schema).select(*schema.names))


def read_range(
    spark: SparkSession, path: str, start, end, closed: str = "left", schema: T.StructType = PANEL,
) -> DataFrame:
    """Event-time range of the table: the commit names the folders of its days, row groups are skipped by hour.

    Bounds that are columns are not known before the query runs; they filter rows of all days.
    """
    known = [str(x)[:10] for x in (start, end) if not isinstance(x, Column)]
    table = _stored(spark, path, schema, *known) if len(known) == 2 else _stored(spark, path, schema)
    return between_hours(table, start, end, closed=closed).select(*schema.names)


def describe(df: DataFrame, docs: dict = COLUMN_DOCS) -> DataFrame:
    """Attach column descriptions as schema metadata."""
    for column, text in docs.items():
        if column in df.columns:
            df = df.withMetadata(column, {"comment": text})
    return df


def descriptions(df: DataFrame) -> DataFrame:
    """(name, description, non_null) of every column: the text from the schema, the count from the rows."""
    counted = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(f.name).alias("name"), F.lit(f.metadata.get("comment")).cast("string").alias("description"),
            F.col(f.name).alias("non_null"),
        )
        for f in df.schema.fields
    ]
    return counted.select(F.inline(F.array(*rows)))


MANIFEST = T.StructType([
    T.StructField("view", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("source", T.StringType()),
])


def _manifest(root: str) -> str:
    return f"{root.rstrip('/')}/manifest"


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """All registered views, from the newest commit of the manifest."""
    state = head(spark, _manifest(root))
    return spark.createDataFrame([(v, int(n), sources[0]) for v, parts in state.parts.items() for n, sources in parts.items()], MANIFEST)


def create_view(spark: SparkSession, root: str, name: str, source: str) -> int:
    """Save a select-all view of a feature table under the next version and register it by name."""
    version = claim(spark, _manifest(root), name, lambda _: [source])
    open_view(spark, root, name, version)
    return version


def open_view(spark: SparkSession, root: str, name: str, version: int) -> DataFrame:
    """The saved view as a DataFrame, also usable in SQL as ``name_vN``."""
    saved = head(spark, _manifest(root)).of(name).get(str(version))
    if saved is None:
        raise LookupError(f"no view {name} version {version}")
    df = read_table(spark, saved[0])
    df.createOrReplaceTempView(f"{name}_v{version}")
    return df


def mark_expired(listing: DataFrame, keep: int, name: str = "name", version: str = "version") -> DataFrame:
    """Versions beyond the newest ``keep`` of each name are marked expired."""
    rank = F.row_number().over(Window.partitionBy(name).orderBy(F.col(version).desc()))
    return listing.withColumn("expired", rank > keep)


def drop_old_versions(spark: SparkSession, root: str, keep: int, prefix: str = "v") -> list[int]:
    """Remove all but the newest ``keep`` version folders; returns the removed versions.

    The ``prefix=N`` folders are ``v=N`` for tables and models and ``td_version=N`` for snapshots.
    """
    found = versions(spark, root, prefix)
    expired = found[:-keep] if keep else found
    for version in expired:
        remove(spark, f"{root.rstrip('/')}/{prefix}={version}")
    return expired


def drop_old_views(spark: SparkSession, root: str, keep: int) -> int:
    """Take all but the newest ``keep`` versions of every view off the manifest, in one commit; returns how many."""
    return sum(map(len, retain(spark, _manifest(root), keep).values()))
