"""Hourly tables as CSV: the exchange format of the original data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from seriesloom.functions.scalars import nan_to_null

# Columns of the hourly input tables. Test tables lack the last three.
HOURLY_COLUMNS = (
    "datetime timestamp_ntz, season int, holiday int, workingday int, weather int, "
    "temp double, atemp double, humidity int, windspeed double"
)
COUNT_COLUMNS = "casual int, registered int, count int"

# Microseconds are kept: the default CSV format would drop them.
CSV_STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_csv(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType, stamp: str = CSV_STAMP
) -> DataFrame:
    """CSV with a header and a declared schema: no inference pass over the data.

    NaN in floating columns becomes NULL here, once, so that averages downstream
    skip it.
    """
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("timestampNTZFormat", stamp)
        .csv(path)
    )
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(c) for c in floating})


def read_hourly_csv(spark: SparkSession, path: str, with_counts: bool = True) -> DataFrame:
    """Raw hourly input, keyed by ``datetime``."""
    schema = f"{HOURLY_COLUMNS}, {COUNT_COLUMNS}" if with_counts else HOURLY_COLUMNS
    return read_csv(spark, path, schema, "yyyy-MM-dd HH:mm:ss")


def write_csv(df: DataFrame, path: str, overwrite: bool = True) -> None:
    """Whole table; with ``overwrite=False`` an existing one is left alone."""
    (
        df.write.mode("overwrite" if overwrite else "ignore")
        .option("header", True)
        .option("timestampNTZFormat", CSV_STAMP)
        .csv(path)
    )
