"""Points packed into small boxes, so that a Lloyd pass measures few distances.

``pack_points`` turns each partition into rows of some 16,000 points: coordinates as binary columns in Z-order,
cut into blocks of 256 neighbouring points, each block with its bounding box, its exact coordinate sums
and its moments. A pass tests every box against the K centres: a centre whose least possible distance to the box
is above another centre's greatest is nearest to no point in it (the filtering rule of Kanungo et al., 2002). Where
one centre is left, for this pass and the one before, the block is added as a whole; elsewhere the points are
measured against the centres that are left. Packing is narrow: no shuffle, and a hot location is just many
equal points in blocks of their own.

The result equals a full scan to the bit: rounding is monotonic, so the distance computed for any point of a box lies
between those computed for its nearest and farthest places, and ties keep the lowest centre id because candidates are
kept on equality and visited in order.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from centroidal.functions.geometry import Centre
from centroidal.operators.assign import (
    BLOCK_POINTS, X, Y, _as_arrays, box_candidates, exact_weighted_sums, nearest_in_blocks, z_order,
)

# Shipped by value, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROW_POINTS, SORT_POINTS = 1 << 14, 1 << 18
PACKED_SCHEMA = "x binary, y binary, w binary, blocks binary"
PASS_SCHEMA = "cluster_id int, sx decimal(38,0), sy decimal(38,0), n bigint, sse double, moved bigint, pairs bigint"
#: Columns of ``blocks``: points, box, exact sums in 10^-scale units, mean, squared distances to the mean.
STATS = 10


def _units(values: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(values * float(10 ** scale) + 0.5)


def _statistics(x: np.ndarray, y: np.ndarray, scale: int) -> np.ndarray:
    starts = np.arange(0, len(x), BLOCK_POINTS)
    n = np.diff(np.append(starts, len(x)))
    out = np.empty((len(starts), STATS))
    out[:, 0] = n
    for column, v in ((1, x), (3, y)):
        out[:, column] = np.minimum.reduceat(v, starts)
        out[:, column + 1] = np.maximum.reduceat(v, starts)
    out[:, 5] = np.add.reduceat(_units(x, scale), starts)
    out[:, 6] = np.add.reduceat(_units(y, scale), starts)
    out[:, 7], out[:, 8] = np.add.reduceat(x, starts) / n, np.add.reduceat(y, starts) / n
    dx, dy = x - np.repeat(out[:, 7], n), y - np.repeat(out[:, 8], n)
    out[:, 9] = np.add.reduceat(dx * dx + dy * dy, starts)
    return out


def pack_points(points: DataFrame, x: str = X, y: str = Y, weight: str | None = None, scale: int = 6) -> DataFrame:
    """``points`` as packed rows; those with a NULL or NaN coordinate are left out. ``weight`` is an integer
    multiplicity; negative ones raise."""
    def pack(batches):
        held, size = [], 0

        def rows():
            xv, yv, wv = (np.concatenate(columns) for columns in zip(*held))
            order = np.argsort(z_order(xv, yv), kind="stable")
            for start in range(0, len(order), ROW_POINTS):
                at = order[start:start + ROW_POINTS]
                px, py = xv[at], yv[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([px.tobytes()], pa.binary()), pa.array([py.tobytes()], pa.binary()),
                     pa.array([wv[at].tobytes() if weight else None], pa.binary()),
                     pa.array([_statistics(px, py, scale).tobytes()], pa.binary())], names=["x", "y", "w", "blocks"])

        for batch in batches:
            xv, yv = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.float64, copy=False) for c in (x, y))
            wv = batch.column(weight).to_numpy(zero_copy_only=False).astype(np.int64) if weight else np.empty(len(xv), np.int64)
            ok = ~(np.isnan(xv) | np.isnan(yv))
            if weight and (wv[ok] < 0).any():
                raise ValueError("weights are multiplicities and cannot be negative")
            if ok.any():
                held.append((xv[ok], yv[ok], wv[ok]))
                size += int(ok.sum())
            if size >= SORT_POINTS:
                yield from rows()
                held, size = [], 0
        if held:
            yield from rows()

    return points.select(x, y, *([weight] if weight else [])).mapInArrow(pack, PACKED_SCHEMA)


class _Sums:
    """Exact per-cluster sums of a partition."""

    def __init__(self, k: int):
        self.k, self.sse, self.pairs = k, np.zeros(k), 0
        self.n, self.sx, self.sy, self.moved = (np.zeros(k, object) for _ in range(4))

    def exact(self, ids: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Sums of integer-valued doubles by cluster, as Python integers."""
        bound = float(np.abs(values).max(initial=0)) * max(1, len(values))
        if bound < 2.0 ** 53:
            return np.bincount(ids, weights=values, minlength=self.k).astype(np.int64).astype(object)
        if bound >= 2.0 ** 62 or float(np.abs(values).max()) >= 2.0 ** 53:
            raise OverflowError("coordinates are too large for exact sums; use a smaller scale")
        out = np.zeros(self.k, np.int64)
        np.add.at(out, ids, values.astype(np.int64))
        return out.astype(object)

    def add_blocks(self, stats: np.ndarray, ids: np.ndarray, moved: np.ndarray, cx: np.ndarray, cy: np.ndarray) -> None:
        n = stats[:, 0]
        self.n += self.exact(ids, n)
        self.sx += self.exact(ids, stats[:, 5])
        self.sy += self.exact(ids, stats[:, 6])
        self.moved += self.exact(ids, np.where(moved, n, 0.0))
        dx, dy = stats[:, 7] - cx[ids], stats[:, 8] - cy[ids]
        self.sse += np.bincount(ids, weights=stats[:, 9] + n * (dx * dx + dy * dy), minlength=self.k)

    def add_points(self, x: np.ndarray, y: np.ndarray, w: np.ndarray | None, ids: np.ndarray, d: np.ndarray, moved: np.ndarray, scale: int) -> None:
        ux, uy = _units(x, scale), _units(y, scale)
        if w is None:
            self.n += self.exact(ids, np.ones(len(ids)))
            self.sx += self.exact(ids, ux)
            self.sy += self.exact(ids, uy)
            self.moved += self.exact(ids, moved.astype(float))
            self.sse += np.bincount(ids, weights=d, minlength=self.k)
            return
        for name, values in (("n", np.ones(len(w), np.int64)), ("sx", ux.astype(np.int64)), ("sy", uy.astype(np.int64)), ("moved", moved.astype(np.int64))):
            setattr(self, name, getattr(self, name) + np.array(exact_weighted_sums(ids, values, w, self.k), object))
        self.sse += np.bincount(ids, weights=d * w, minlength=self.k)

    def batch(self) -> pa.RecordBatch | None:
        kept = np.flatnonzero(self.n > 0)
        if not len(kept):
            return None
        if max(self.n) >= 1 << 63:
            raise OverflowError("total weight of a cluster exceeds int64")
        whole = pa.decimal128(38, 0)
        pairs = [self.pairs] + [0] * (len(kept) - 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(kept, pa.int32()), *(pa.array([Decimal(int(v)) for v in s[kept]], whole) for s in (self.sx, self.sy)),
             pa.array([int(v) for v in self.n[kept]], pa.int64()), pa.array(self.sse[kept]),
             pa.array([int(v) for v in self.moved[kept]], pa.int64()), pa.array(pairs, pa.int64())],
            names=["cluster_id", "sx", "sy", "n", "sse", "moved", "pairs"])


def block_pass(packed: DataFrame, centres: Sequence[Centre], prev_centres: Sequence[Centre] | None = None, scale: int = 6) -> DataFrame:
    """Partial sums of one Lloyd pass over packed points: at most K rows a partition, ``PASS_SCHEMA``. ``pairs`` is the
    number of point-to-centre distances that were computed."""
    cx, cy = _as_arrays(centres)
    prev = _as_arrays(prev_centres) if prev_centres is not None else None

    def run(batches):
        sums = _Sums(len(cx))
        for batch in batches:
            for rx, ry, rw, rb in zip(*(batch.column(c) for c in ("x", "y", "w", "blocks"))):
                stats = np.frombuffer(rb.as_buffer(), np.float64).reshape(-1, STATS)
                now = box_candidates(stats[:, 1:5], cx, cy)
                before = now if prev is None else box_candidates(stats[:, 1:5], *prev)
                whole = (now.sum(axis=1) == 1) & (before.sum(axis=1) == 1) & (not rw.is_valid)
                ids, old = now.argmax(axis=1), before.argmax(axis=1)
                sums.add_blocks(stats[whole], ids[whole], np.full(whole.sum(), True) if prev is None else (ids != old)[whole], cx, cy)
                if whole.all():
                    continue
                sizes = stats[:, 0].astype(np.int64)
                rows = np.flatnonzero(np.repeat(~whole, sizes))
                x, y = (np.frombuffer(r.as_buffer(), np.float64)[rows] for r in (rx, ry))
                w = np.frombuffer(rw.as_buffer(), np.int64)[rows] if rw.is_valid else None
                near, d, pairs = nearest_in_blocks(x, y, sizes[~whole], now[~whole], cx, cy)
                sums.pairs += pairs
                moved = np.full(len(rows), True)
                if prev is not None:
                    was, _, pairs = nearest_in_blocks(x, y, sizes[~whole], before[~whole], *prev)
                    sums.pairs += pairs
                    moved = was != near
                sums.add_points(x, y, w, near, d, moved, scale)
        out = sums.batch()
        if out is not None:
            yield out

    return packed.mapInArrow(run, PASS_SCHEMA)
