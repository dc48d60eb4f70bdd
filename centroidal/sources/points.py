"""Point sources: Parquet / CSV by name (S1, S2, S4, S5, S6), positional CSV and raw lines (S3, P4, P5),
coordinate discovery by column name (P6, P7) and union of differently named inputs (U1).

Schemas are explicit (no ``inferSchema`` pass). Numbers are parsed with ``try_cast`` so a bad value
becomes NULL and the row is dropped instead of failing the job (Spark 4 runs with ANSI casts on).
"""

from __future__ import annotations

import io
import re
import sys
from collections.abc import Iterable, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Shipped by value, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

X, Y = "pickup_longitude", "pickup_latitude"
POINT_SCHEMA = T.StructType([T.StructField(X, T.DoubleType()), T.StructField(Y, T.DoubleType())])

# The positional layout of the prepared CSV (five padding columns, then x and y), and the
# words that name a coordinate column of older trip files.
DEFAULT_COL_X = 5
DEFAULT_COL_Y = 6
AXIS_WORDS = {"lon": X, "lat": Y}


def read_points(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet",
                schema: T.StructType | None = None, header: bool = True) -> DataFrame:
    """Read a point table in ``parquet`` or ``csv`` (S1, S2, S4); any Hadoop URI works.

    A directory or a list of files is read as one table (S6, U1); ``_metadata.file_name`` gives the
    per-file tag when needed. CSV columns are found by their header names, as string columns (only
    the header line is read up front, no type-inference pass); ``select_coordinates`` /
    ``clean_points`` then ``try_cast`` the named columns. A ``schema``, when given, is applied by
    position, as Spark's CSV reader does.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if fmt == "parquet":
        return spark.read.parquet(*paths)
    if fmt == "csv":
        reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
        if schema is not None:
            reader = reader.schema(schema)
        return reader.csv(paths)
    raise ValueError(f"unknown format {fmt!r}; use 'parquet' or 'csv'")


def tag_files(df: DataFrame, col: str = "file_tag") -> DataFrame:
    """Add the source of every row, its folder and file name (S6: the per-file tag of the preparation profile)."""
    return df.withColumn(col, F.substring_index(F.col("_metadata.file_path"), "/", -2))


def csv_fields(line: Column | str, width: int) -> Column:
    """The first ``width`` fields of a comma line as columns ``_f0, _f1, ...`` (a generator, so that a filter on a field
    stays above it and a line is parsed once); fields that are missing or empty are NULL, quotes are ordinary characters."""
    schema = ", ".join(f"_f{i} string" for i in range(width))
    return F.inline(F.array(F.from_csv(line if isinstance(line, Column) else F.col(line), schema, {"quote": "\u0000", "mode": "PERMISSIVE"})))


def parse_point_lines(lines: DataFrame, line_col: str = "value", col_x: int = DEFAULT_COL_X,
                      col_y: int = DEFAULT_COL_Y, keep: Iterable[str] = ()) -> DataFrame:
    """Parse comma lines without quoting rules (P5): fields ``col_x`` and ``col_y`` as doubles.

    Lines with too few fields or a value that is not a number give NULL coordinates (P4); clean the
    result with ``operators.prepare.clean_points``. Unlike ``std::stod`` a numeric prefix such as
    ``-73.9abc`` is not accepted.
    """
    fields = csv_fields(line_col, max(col_x, col_y) + 1)
    return lines.select(*keep, fields).select(
        *keep, F.col(f"_f{col_x}").try_cast("double").alias(X), F.col(f"_f{col_y}").try_cast("double").alias(Y))


def read_positional_csv(spark: SparkSession, path: str | Sequence[str], col_x: int = DEFAULT_COL_X,
                        col_y: int = DEFAULT_COL_Y) -> DataFrame:
    """Positional CSV (S3): skip each file's first line, take fields ``col_x`` and ``col_y`` by index.

    Spark's CSV reader with ``header`` drops the first line of every file; quoting is switched off to
    match a plain comma split. All fields are read as strings (no inference pass); short lines give
    NULL and extra fields are ignored (PERMISSIVE), then ``try_cast`` turns bad numbers into NULL.
    """
    paths = [path] if isinstance(path, str) else list(path)
    width = max(col_x, col_y) + 1
    schema = T.StructType([T.StructField(f"f{i}", T.StringType()) for i in range(width)])
    raw = (spark.read.schema(schema).option("header", True).option("enforceSchema", True)
           .option("mode", "PERMISSIVE").option("quote", "\u0000").csv(paths))
    return raw.select(F.col(f"f{col_x}").try_cast("double").alias(X),
                      F.col(f"f{col_y}").try_cast("double").alias(Y))


def find_coordinate_columns(columns: Sequence[str]) -> tuple[str, str] | None:
    """The longitude and latitude columns by name (P6): a column belongs to the axis whose word its name
    contains, the first in the schema wins; None if an axis has no column."""
    axis_of: dict[str, str] = {}
    for name in columns:
        for word, axis in AXIS_WORDS.items():
            if word in name.lower():
                axis_of.setdefault(axis, name)
    return (axis_of[X], axis_of[Y]) if len(axis_of) == len(AXIS_WORDS) else None


def canonical_points(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame | None:
    """Rename discovered coordinate columns to the canonical names (P6, P7); None when not found."""
    found = find_coordinate_columns(df.columns)
    if found is None:
        return None
    lon, lat = found
    return df.select(*keep, F.col(lon).try_cast("double").alias(X), F.col(lat).try_cast("double").alias(Y))


def _schema_reader(fmt: str):
    """Reads schemas in a task: Parquet footers, or CSV header lines, of a batch of paths. A file in a store that Arrow
    does not know gives NULL."""
    def schema_of(path: str) -> str | None:
        uri = re.sub(r"^file:/+", "file:///", path)
        try:
            store, inner = pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
            return None
        if fmt == "parquet":
            with store.open_input_file(inner) as f:
                return "\n".join(f"{field.name}: {field.type}" for field in pq.read_schema(f))
        with store.open_input_stream(inner) as f:
            line = io.TextIOWrapper(f, "utf-8", errors="replace").readline()
        return line.rstrip("\r\n")

    def run(batches):
        for batch in batches:
            paths = batch.column("path").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array([schema_of(p) for p in paths], pa.string())], names=["path", "schema"])
    return run


def file_schemas(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet") -> DataFrame:
    """``path, schema`` of every file (S6): Spark lists the files, tasks read their footers or header lines, so a
    directory of any size is one job."""
    paths = [path] if isinstance(path, str) else list(path)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{fmt}").option("recursiveFileLookup", True).load(paths).select("path")
    return listed.mapInArrow(_schema_reader(fmt), "path string, schema string")


def schema_groups(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet") -> list[DataFrame]:
    """One frame per file schema of a directory (S6): files of the same schema are read together. Every frame
    has ``file_tag``, the file's folder and name. The driver holds one path per file, as Spark's own file index does;
    only files in a store that tasks cannot open with Arrow have their schema read by Spark one by one."""
    found = file_schemas(spark, path, fmt).groupBy("schema").agg(F.sort_array(F.collect_list("path")).alias("files")).collect()
    groups = {r["schema"]: list(r["files"]) for r in found if r["schema"] is not None}
    for file in (f for r in found if r["schema"] is None for f in r["files"]):
        groups.setdefault(read_points(spark, file, fmt).schema.json(), []).append(file)
    return [tag_files(read_points(spark, files, fmt)) for _, files in sorted(groups.items())]


def read_point_directory(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet") -> tuple[DataFrame, list[str]]:
    """Points of a directory whose files differ in column names or types (S6, P6, P7, U1): the columns are
    found and cast per schema group. Returns ``file_tag`` and the canonical coordinates, and the
    names of files without recognisable coordinates, which are skipped."""
    parts, skipped = [], []
    for group in schema_groups(spark, path, fmt):
        canon = canonical_points(group, keep=["file_tag"])
        if canon is None:
            skipped += [r["file_tag"] for r in group.select("file_tag").distinct().collect()]
        else:
            parts.append(canon)
    if not parts:
        raise ValueError("no file has recognisable coordinate columns")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out, sorted(skipped)


def union_point_sources(sources: dict[str, DataFrame], tag_col: str = "source") -> tuple[DataFrame, list[str]]:
    """Union-all of inputs with differently named coordinate columns.

    Each input is canonicalised (P6, P7) and tagged; inputs without recognisable coordinates are
    skipped and returned by name, as the reference skips such files.
    """
    parts, skipped = [], []
    for name, df in sources.items():
        canon = canonical_points(df)
        if canon is None:
            skipped.append(name)
            continue
        parts.append(canon.select(F.lit(name).alias(tag_col), X, Y))
    if not parts:
        raise ValueError("no input has recognisable coordinate columns")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out, skipped
