"""Helpers shared by the operators: Arrow batch maps, scratch tables in the shared folder, names."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centroidal.session import materialize, release


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have in any case."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: Bytes of a batch that the operators work on at a time; a larger row makes a piece of its own.
PIECE_BYTES = 2_000_000


def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into pieces of about PIECE_BYTES, so that memory is bounded by bytes, not rows."""
    for batch in batches:
        n = -(-batch.num_rows * PIECE_BYTES // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, max(1, n)):
            yield batch.slice(start, max(1, n))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema) -> DataFrame:
    """Apply ``fn`` to every piece of the Arrow batches of ``df``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            yield fn(batch)
    return df.mapInArrow(run, schema)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors. ``dropped`` deletes it."""
    return materialize(df, "checkpoint", f"llm-{name}")


def dropped(*frames: DataFrame) -> None:
    """Delete tables that ``written`` made, when nothing reads them any more."""
    for frame in frames:
        release(frame, "checkpoint")


def crc_mod(column, mod: int):
    """``crc32(column as text) mod n`` (null for a null id)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % mod


#: Bytes of the words of the scans: A-Z lowered, all other ASCII outside 0-9 and a-z blank, bytes from 0x80 kept.
WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 32 if c < 0x30 or 0x3A <= c <= 0x60 or 0x7B <= c <= 0x7F else c
    for c in range(256))


def scan_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lowered (bytes of UTF-8)."""
    return text.translate(WORD_BYTES).split()


_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finalizer (splitmix64) over an array; ``seed`` gives independent permutations."""
    with np.errstate(over="ignore"):
        z = x + _MIX[0] * np.uint64(seed + 1)
        z = (z ^ (z >> np.uint64(30))) * _MIX[1]
        z = (z ^ (z >> np.uint64(27))) * _MIX[2]
        return z ^ (z >> np.uint64(31))
