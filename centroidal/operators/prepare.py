"""Preparation: coordinate cleaning (P1-P3), padding and layout (P8, P9), zone lookup (J1), the
preparation profile (A7), accepted-row limits (T2), repartitioning (X7) and duplicate folding.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

X, Y = "pickup_longitude", "pickup_latitude"

# The inclusive NYC bounding box of the reference (longitude, latitude).
LON_RANGE = (-75.0, -73.0)
LAT_RANGE = (40.0, 41.5)
PAD_COLUMNS = 5


def select_coordinates(df: DataFrame, x: str = X, y: str = Y, keep: Iterable[str] = ()) -> DataFrame:
    """Project the two coordinates as doubles under the canonical names (P1); bad text becomes NULL."""
    return df.select(*keep, F.col(x).try_cast("double").alias(X), F.col(y).try_cast("double").alias(Y))


def in_box(x: str = X, y: str = Y, lon: Sequence[float] = LON_RANGE, lat: Sequence[float] = LAT_RANGE) -> Column:
    """Inclusive box predicate (V1). NaN compares false, so NaN rows fail it (V2)."""
    return F.col(x).between(F.lit(float(lon[0])), F.lit(float(lon[1]))) & \
        F.col(y).between(F.lit(float(lat[0])), F.lit(float(lat[1])))


def bbox_filter(df: DataFrame, x: str = X, y: str = Y, lon: Sequence[float] = LON_RANGE,
                lat: Sequence[float] = LAT_RANGE) -> DataFrame:
    """Keep rows inside the inclusive box (P2); on a Parquet scan this becomes pushed-down filters."""
    return df.filter(in_box(x, y, lon, lat))


def drop_missing(df: DataFrame, cols: Sequence[str] = (X, Y)) -> DataFrame:
    """Drop rows with a NULL or NaN coordinate."""
    return df.na.drop(subset=list(cols))


def clean_points(df: DataFrame, x: str = X, y: str = Y, keep: Iterable[str] = (),
                 lon: Sequence[float] = LON_RANGE, lat: Sequence[float] = LAT_RANGE) -> DataFrame:
    """P1 + P2 + P3: typed canonical coordinates inside the box, no missing values."""
    pts = select_coordinates(df, x, y, keep)
    return drop_missing(bbox_filter(pts, X, Y, lon, lat))


def limit_points(df: DataFrame, max_rows: int, order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep at most ``max_rows`` accepted rows (T2, V11); ``max_rows <= 0`` means no limit.

    Apply after the filters, as the reference counts accepted rows. With ``order_by`` the rows with
    the least keys are kept (deterministic), otherwise any rows. This is Spark's own limit, a feature
    for small row counts: up to n rows of each partition meet in one task.
    """
    if max_rows is None or max_rows <= 0:
        return df
    return df.orderBy(*order_by).limit(max_rows) if order_by else df.limit(max_rows)


def pad_columns(df: DataFrame, n: int = PAD_COLUMNS, x: str = X, y: str = Y) -> DataFrame:
    """Prepared-file layout: ``col_0..col_{n-1} = 0`` then the two coordinates, in that order."""
    pads = [F.lit(0).alias(f"col_{i}") for i in range(n)]
    return df.select(*pads, F.col(x).alias(X), F.col(y).alias(Y))


def one_row_per_zone(zones: DataFrame, key: str = "LocationID") -> DataFrame:
    """The zone table with one row per id: of repeated ids the row with the least values stands; rows
    without an id go."""
    others = [c for c in zones.columns if c != key]
    if not others:
        return zones.filter(F.col(key).isNotNull()).distinct()
    # Grouped by a second form of the key too: the join then shuffles the result itself, and only a join
    # right above its shuffles lets AQE split a hot zone.
    return (zones.filter(F.col(key).isNotNull()).withColumn("_text", F.col(key).cast("string")).groupBy(key, "_text")
            .agg(F.min(F.struct(*others)).alias("_zone")).select(key, *[F.col(f"_zone.{c}").alias(c) for c in others]))


def _zone_key(trips: DataFrame, zones: DataFrame, key: str) -> DataFrame:
    """Trips with the key in the zone table's type; text that is no such id becomes NULL."""
    kind = zones.schema[key].dataType
    return trips if trips.schema[key].dataType == kind else trips.withColumn(key, F.col(key).try_cast(kind))


def zone_lookup(trips: DataFrame, zones: DataFrame, key: str = "LocationID", how: str = "inner") -> DataFrame:
    """Trip zone id -> zone coordinates (J1). Unknown zones are dropped (``inner``) or kept (``left``).

    A trip meets one zone row at most, as in a keyed lookup. The strategy is Spark's: a zone side under
    the broadcast threshold is broadcast at run time, otherwise a shuffle join whose hot zones AQE's
    skew handling splits.
    """
    return _zone_key(trips, zones, key).join(one_row_per_zone(zones, key), on=key, how=how)


def zone_unmatched(trips: DataFrame, zones: DataFrame, key: str = "LocationID") -> DataFrame:
    """Trips whose zone id has no coordinates (``left_anti``): the rows the lookup drops."""
    return _zone_key(trips, zones, key).join(zones.select(key), on=key, how="left_anti")


def prep_profile(df: DataFrame, tag_col: str, valid: Column) -> DataFrame:
    """Raw and valid rows per input file plus the grand total (A7): ``is_total`` tells the total from a
    file without a tag. One aggregation; the total adds up the per-file rows."""
    per_tag = df.groupBy(tag_col).agg(F.count(F.lit(1)).alias("raw_rows"), F.count_if(valid).alias("valid_rows"))
    tag_type = df.schema[tag_col].dataType
    total = per_tag.agg(F.coalesce(F.sum("raw_rows"), F.lit(0)).alias("raw_rows"),
                        F.coalesce(F.sum("valid_rows"), F.lit(0)).alias("valid_rows"))
    return per_tag.withColumn("is_total", F.lit(False)).unionByName(
        total.withColumn(tag_col, F.lit(None).cast(tag_type)).withColumn("is_total", F.lit(True)))


def repartition_points(df: DataFrame, n_parts: int | None) -> DataFrame:
    """Round-robin repartition on request (X7); ``None`` keeps the input layout."""
    return df.repartition(n_parts) if n_parts else df


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per partition (X7): ``partition_id int, rows bigint``."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("rows"))


def fold_duplicates(df: DataFrame, x: str = X, y: str = Y, weight: str = "weight") -> DataFrame:
    """One row per distinct location with its multiplicity (exact for weighted Lloyd).

    Partial aggregation collapses a hot location inside each map task, so even a location holding a
    third of all rows ships one row per task.
    """
    return df.groupBy(x, y).agg(F.count(F.lit(1)).alias(weight))
