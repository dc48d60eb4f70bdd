"""Zone dimension source (S7): ``LocationID int -> (longitude double, latitude double)``.

The reference hard-codes its table; here the caller supplies it as a CSV or Parquet table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ZONE_SCHEMA = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
])


def read_zones(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Read the zone table by column name and type it as ``ZONE_SCHEMA``; rows without a key or a
    coordinate (or with text that is not a number) are dropped. Other columns are ignored."""
    if fmt == "csv":
        df = spark.read.option("header", True).csv(path)    # columns by header name, as strings
    elif fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    typed = df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in ZONE_SCHEMA.fields])
    return typed.na.drop(subset=["LocationID", "longitude", "latitude"])
