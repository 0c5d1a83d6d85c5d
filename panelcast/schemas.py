"""Table contracts: schemas, key columns and fixed values."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import types as T

KEYS = ("area", "consumer_type")
TIME = "datetime_utc"
VALUE = "energy_consumption"
# In a gap-filled panel: whether the hour had a row.
OBSERVED = "observed"
ROW_KEYS = (*KEYS, TIME)

# Fixed values -----------------------------------------------------------------------------
AREA_CODES = {"DK": 0, "DK1": 1, "DK2": 2}
CONSUMER_TYPES = (
    111, 112, 119, 121, 122, 123, 130, 211, 212, 215, 220, 310, 320, 330, 340, 350, 360, 370,
    381, 382, 390, 410, 421, 422, 431, 432, 433, 441, 442, 443, 444, 445, 446, 447, 450, 461,
    462, 999,
)
RAW_TIME_FORMAT = "yyyy-MM-dd HH:mm"
REQUEST_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"
PAYLOAD_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DATASET_START = datetime(2020, 6, 30, 22)
DATASET_END = datetime(2023, 6, 30, 21)
DAYS_DELAY = 15
DAYS_EXPORT = 30
HORIZON = 24
DISPLAY_HOURS = 168
# Machine epsilon of a double: floor of the denominator in percentage errors.
EPSILON = 2.220446049250313e-16
# ------------------------------------------------------------------------------------------

RAW = T.StructType([
    T.StructField("HourUTC", T.StringType()),
    T.StructField("HourDK", T.StringType()),
    T.StructField("PriceArea", T.StringType()),
    T.StructField("ConsumerType_DE35", T.IntegerType()),
    T.StructField("TotalCon", T.DoubleType()),
])

PAYLOAD = T.StructType([T.StructField("records", T.ArrayType(RAW))])

PANEL = T.StructType([
    T.StructField("datetime_utc", T.TimestampNTZType()),
    T.StructField("area", T.ByteType()),
    T.StructField("consumer_type", T.IntegerType()),
    T.StructField("energy_consumption", T.DoubleType()),
])

FORECAST = T.StructType([
    T.StructField("area", T.ByteType()),
    T.StructField("consumer_type", T.IntegerType()),
    T.StructField("datetime_utc", T.TimestampNTZType()),
    T.StructField("energy_consumption", T.DoubleType()),
])

METRICS = T.StructType([
    T.StructField("datetime_utc", T.TimestampNTZType()),
    T.StructField("MAPE", T.DoubleType()),
])

COLUMN_DOCS = {
    "datetime_utc": "Hour of the observation in UTC; minutes and seconds are always zero.",
    "area": "Price area code: 0 = whole country, 1 = west of the Belt, 2 = east of the Belt.",
    "consumer_type": "Industry code (DE35) of the consumers in the series.",
    "energy_consumption": "Electricity used in the hour, in kWh; never negative.",
}
