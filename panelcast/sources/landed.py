"""Scans of landed records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from panelcast.schemas import PAYLOAD, RAW
from panelcast.sources.paths import has_data


def read_delimited(spark: SparkSession, path: str, schema: StructType = RAW, separator: str = ";") -> DataFrame:
    """Delimited files with a header; a malformed record fails the job."""
    return (
        spark.read.schema(schema).option("sep", separator).option("header", True)
        .option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    )


def require_rows(df: DataFrame, source: str) -> DataFrame:
    """The same table, or an error when it is empty."""
    if df.isEmpty():
        raise ValueError(f"no records in {source}")
    return df


def read_payloads(
    spark: SparkSession, path: str, schema: StructType = PAYLOAD, multi_line: bool = False,
    sort_by: str | None = None,
) -> DataFrame:
    """Records of ``{"records": [...]}`` payloads.

    One payload per line is splittable; set ``multi_line`` for payloads that span lines. A payload
    that cannot be parsed fails the job.
    """
    records = (
        spark.read.schema(schema).option("mode", "FAILFAST").json(path, multiLine=multi_line)
        .select(F.inline("records"))
    )
    return records.orderBy(sort_by) if sort_by else records


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The dataset, or an empty table of the same schema when it is not there yet."""
    if not has_data(spark, path):
        return spark.createDataFrame([], schema)
    return read_parquet(spark, path, schema)
