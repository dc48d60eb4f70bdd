"""Prediction over a Structured Streaming source (X6 + K1 on arriving files).

The reference has no streaming. Its final stage - clean the points, assign each to the nearest fitted
centre, write the assignments as Parquet - is stateless and row-local, so the same operators run
unchanged on a streaming DataFrame: no state store, no watermark, exactly-once through the file
sink's checkpoint in the shared checkpoint folder.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from centroidal.functions.geometry import Centre
from centroidal.operators.assign import X, Y, assign_nearest
from centroidal.operators.prepare import clean_points
from centroidal.session import ensure_checkpoint_dir

POINT_STREAM_SCHEMA = T.StructType([T.StructField(X, T.DoubleType()), T.StructField(Y, T.DoubleType())])


def read_point_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                      schema: T.StructType = POINT_STREAM_SCHEMA, max_files_per_trigger: int | None = None) -> DataFrame:
    """Files arriving in ``path`` as a stream of points (explicit schema, as streams require).

    Parquet columns are matched by name; for CSV Spark applies the schema by position, so pass one
    that lists the file's columns in order.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def assign_stream(stream: DataFrame, centres: Sequence[Centre], x: str = X, y: str = Y,
                  method: str = "arrow") -> DataFrame:
    """Clean and assign a streaming DataFrame: ``pickup_longitude, pickup_latitude, cluster_id``."""
    pts = clean_points(stream, x, y)
    return assign_nearest(pts, centres, method=method).select(X, Y, "cluster_id")


def write_assignment_stream(assigned: DataFrame, path: str, checkpoint: str | None = None,
                            available_now: bool = False) -> StreamingQuery:
    """Start the Parquet sink of the assignments (K1). The checkpoint defaults to a folder under the
    session's ``spark.checkpoint.dir``."""
    spark = assigned.sparkSession
    if checkpoint is None:
        base = ensure_checkpoint_dir(spark)
        # one checkpoint per sink path: a hash of the whole path, as sinks may share their last folder name
        name = hashlib.sha256(path.rstrip("/").encode()).hexdigest()[:16]
        checkpoint = os.path.join(base, f"assign-stream-{name}")
    w = assigned.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start(path)
