"""Running sums in a given order and draws by them (W1), without a task that sees all rows.

Rows are range-sorted by the order columns; one small job sums each range; every range then adds the sum of the
ranges before it to its own running sum, inside its task. Sums are of integers (a weight in fixed units), exact and
therefore the same for any number of ranges. The order columns should be unique: rows that tie in all of them have
no defined order and cannot be told apart by the range sort either.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from centroidal.functions.geometry import micro_units
from centroidal.functions.hashing import uniform_value
from centroidal.session import ensure_checkpoint_dir

# Shipped by value, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Low bits of a running sum; the rest is kept apart, so that neither part overflows within a range.
LOW_BITS = 32
WEIGHT_SCALE = 9


@dataclass
class Ranges:
    """Rows in global order: ``frame`` has a range in each partition, ``before`` the sum of the earlier ranges."""
    frame: DataFrame
    order_by: list[str]
    before: dict[int, int]
    total: int

    def running(self, out: str, only: int | None = None) -> DataFrame:
        """The rows with ``out``, the sum of the units up to and including theirs; of one range if ``only`` is given."""
        frame = self.frame if only is None else self.frame.filter(F.col("_range") == only)
        high, low = f"{out}_high", f"{out}_low"
        before = self.before

        def scan(batches):
            total = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                units = batch.column("_units").to_numpy()
                if total is None:
                    total = before[batch.column("_range")[0].as_py()]
                highs = np.cumsum(units >> LOW_BITS) + (total >> LOW_BITS)
                lows = np.cumsum(units & ((1 << LOW_BITS) - 1)) + (total & ((1 << LOW_BITS) - 1))
                total = (int(highs[-1]) << LOW_BITS) + int(lows[-1])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(highs), pa.array(lows)], names=[*batch.schema.names, high, low])

        schema = T.StructType([*frame.schema, T.StructField(high, T.LongType()), T.StructField(low, T.LongType())])
        whole = F.col(high).cast("decimal(38,0)") * F.lit(1 << LOW_BITS).cast("decimal(38,0)") + F.col(low).cast("decimal(38,0)")
        return frame.mapInArrow(scan, schema).withColumn(out, whole.cast("decimal(38,0)")).drop("_range", "_units", high, low)


def ordered_ranges(df: DataFrame, units: Column | str, order_by: Sequence[str]) -> Ranges:
    """Sort ``df`` globally and sum ``units`` (integers; NULL counts as 0) by range. The sorted rows are checkpointed:
    the range sort samples its bounds, so it must not run twice."""
    ensure_checkpoint_dir(df.sparkSession)
    u = F.col(units) if isinstance(units, str) else units
    frame = (df.withColumn("_units", F.coalesce(u.cast("bigint"), F.lit(0).cast("bigint")))
             .repartitionByRange(*order_by).sortWithinPartitions(*order_by)
             .withColumn("_range", F.spark_partition_id()).checkpoint())
    # one row a range
    sums = frame.groupBy("_range").agg(F.sum(F.col("_units").cast("decimal(38,0)")).alias("s")).orderBy("_range").collect()
    before, total = {}, 0
    for r in sums:
        before[r["_range"]] = total
        total += int(r["s"])
    return Ranges(frame, list(order_by), before, total)


def running_sum(df: DataFrame, units: Column | str, order_by: Sequence[str], out: str = "running") -> DataFrame:
    """Every row with the exact sum of the integer ``units`` of all rows up to and including it (``decimal(38,0)``)."""
    return ordered_ranges(df, units, order_by).running(out)


def first_reaching(ranges: Ranges, target: int, out: str = "running") -> DataFrame:
    """The first row whose running sum is ``target`` or more; no row if the total is less. Units must not be negative.
    Only the range that holds the row is scanned."""
    reached = [r for r, before in ranges.before.items() if before < target]
    if not reached or target > ranges.total:
        return ranges.running(out, only=-1)
    rows = ranges.running(out, only=max(reached, key=lambda r: (ranges.before[r], r)))
    return rows.filter(F.col(out) >= F.lit(target)).orderBy(*ranges.order_by).limit(1)


def running_draw(df: DataFrame, weight: Column | str, order_by: Sequence[str], seed: int, stream: str = "running",
                 scale: int = WEIGHT_SCALE, out: str = "running") -> DataFrame:
    """One row drawn with probability proportional to ``weight``, by walking the running sum (W1): the first row whose
    running sum, in units of 10^-scale, reaches ``floor(u * total) + 1`` for a uniform ``u`` of the seed and stream. A row
    whose weight rounds to 0 is never drawn; no row when all do."""
    ranges = ordered_ranges(df, micro_units(weight, scale), order_by)
    return first_reaching(ranges, int(uniform_value("", seed, stream) * float(ranges.total)) + 1, out)
