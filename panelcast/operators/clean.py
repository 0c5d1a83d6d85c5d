"""Projections and filters that turn landed records into a panel."""

from __future__ import annotations

import re

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from panelcast.functions.codes import encode
from panelcast.functions.hours import parse_time, to_hour
from panelcast.schemas import AREA_CODES, KEYS, RAW_TIME_FORMAT, TIME, VALUE

# Landed column -> panel column.
COLUMN_NAMES = {
    "HourUTC": "datetime_utc",
    "PriceArea": "area",
    "ConsumerType_DE35": "consumer_type",
    "TotalCon": "energy_consumption",
}


def drop_unused(df: DataFrame, columns=("HourDK",)) -> DataFrame:
    return df.drop(*columns)


def rename(df: DataFrame, names: dict = COLUMN_NAMES) -> DataFrame:
    return df.withColumnsRenamed(names)


def cast_types(df: DataFrame, time_format: str = RAW_TIME_FORMAT) -> DataFrame:
    """Panel types; a value that does not convert fails the job (ANSI mode)."""
    return df.select(
        parse_time("datetime_utc", time_format).alias("datetime_utc"),
        F.col("area").cast("string"),
        F.col("consumer_type").cast("int"),
        F.nanvl(F.col("energy_consumption").cast("double"), F.lit(None).cast("double"))
        .alias("energy_consumption"),
    )


def try_cast_types(df: DataFrame, time_format: str = RAW_TIME_FORMAT) -> tuple[DataFrame, DataFrame]:
    """(converted rows, rejected rows as landed) for sources that cannot be trusted."""
    converted = df.withColumns({
        "_time": F.try_to_timestamp(F.col("datetime_utc"), F.lit(time_format)).cast("timestamp_ntz"),
        "_type": F.col("consumer_type").try_cast("int"),
        "_value": F.col("energy_consumption").try_cast("double"),
    })
    broken = (
        (F.col("_time").isNull() & F.col("datetime_utc").isNotNull())
        | (F.col("_type").isNull() & F.col("consumer_type").isNotNull())
        | (F.col("_value").isNull() & F.col("energy_consumption").isNotNull())
    )
    good = converted.filter(~broken).select(
        F.col("_time").alias("datetime_utc"), F.col("area").cast("string"),
        F.col("_type").alias("consumer_type"), F.col("_value").alias("energy_consumption"),
    )
    return good, converted.filter(broken).drop("_time", "_type", "_value")


def encode_area(df: DataFrame, codes: dict = AREA_CODES) -> DataFrame:
    return df.withColumn("area", encode("area", codes))


def clean(df: DataFrame, time_format: str = RAW_TIME_FORMAT) -> DataFrame:
    """Landed records to panel rows; Catalyst fuses the four steps into one projection."""
    return (
        df.transform(drop_unused).transform(rename)
        .transform(cast_types, time_format).transform(encode_area)
    )


def strip_suffix(df: DataFrame, suffix: str, keep=()) -> DataFrame:
    """The ``keep`` columns and those that end in ``suffix``, the latter without it."""
    matching = [c for c in df.columns if re.fullmatch(f".*{re.escape(suffix)}", c)]
    return df.select(*keep, *[F.col(c).alias(c.removesuffix(suffix)) for c in matching])


def key_rows(df: DataFrame, keys=KEYS, time: str = TIME) -> DataFrame:
    """Canonical row keys: the hour is truncated, the keys lead, other columns follow."""
    rest = [c for c in df.columns if c not in (*keys, time)]
    return df.withColumn(time, to_hour(time)).select(*keys, time, *rest)


def sort_rows(df: DataFrame, keys=KEYS, time: str = TIME) -> DataFrame:
    """Total order by series and hour (range partitioned, so it scales out)."""
    return df.orderBy(*keys, time)


def split_target(df: DataFrame, target: str = VALUE, keys=KEYS, time: str = TIME) -> tuple[DataFrame, DataFrame]:
    """(X, y): the row keys with everything but the target, and the row keys with the target."""
    return df.drop(target), df.select(*keys, time, target)


def drop_missing(df: DataFrame, columns=(VALUE,)) -> DataFrame:
    return df.na.drop(subset=list(columns))


def with_empty(df: DataFrame, column: str, data_type: str = "double") -> DataFrame:
    return df.withColumn(column, F.lit(None).cast(data_type))


def one_series(df: DataFrame, area: int, consumer_type: int) -> DataFrame:
    """Rows of one series; both predicates reach the Parquet scan."""
    return df.filter(
        (F.col("area") == F.lit(area).cast("tinyint")) & (F.col("consumer_type") == F.lit(consumer_type))
    )


def found(requests: DataFrame, df: DataFrame, keys=KEYS) -> DataFrame:
    """Each requested series with whether the data holds it; many lookups cost one job."""
    present = df.select(*keys).distinct().withColumn("_present", F.lit(True))
    return requests.join(present, list(keys), "left").select(
        *requests.columns, F.coalesce("_present", F.lit(False)).alias("found")
    )


def require_found(df: DataFrame, what: str) -> DataFrame:
    """The same table, or an error when it holds nothing for ``what``."""
    if df.isEmpty():
        raise LookupError(f"no data found for {what}")
    return df


class AttachKeys(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Copies the series keys into feature columns; ``inverse`` removes them again."""

    suffix = "_exog"

    @keyword_only
    def __init__(self):
        super().__init__()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({f"{k}{self.suffix}": F.col(k) for k in KEYS})

    def inverse(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*[f"{k}{self.suffix}" for k in KEYS])
