"""Nearest-centre assignment (J2, T3; replaces the row-at-a-time UDFs D1-D4; predict X6).

Physical forms of the same operator, chosen with ``method``:

* ``"arrow"`` - a scalar ``pandas_udf``: each Arrow batch is scanned against the K centres with
  vectorised NumPy, keeping the first strict minimum (ties to the lowest id, V4). Up to 100 centres it is
  one pass per centre; for more, boxes of neighbouring points rule most centres out first
  (``nearest_filtered``), with the same results.
* ``"expr"``  - ``least`` + ``CASE`` over K distance columns, all built-in expressions inside
  whole-stage codegen (``with_nearest_expr``; ``functions.geometry.nearest_centre`` is the
  single-Column version for small K). New centres are new literals, so each iteration compiles
  new code. Measured on 7.7 M cached rows (local[8]) it is no faster than ``partials`` for K <= 16
  and about 10x slower from K = 24 (the generated methods grow too large to be JIT-compiled), so
  the fit loop defaults to ``partials``.
* ``"partials"`` (Lloyd steps, ``operators.lloyd``) - ``mapInArrow`` that assigns each Arrow batch
  of a partition and returns the partition's per-cluster partial sums, at most K rows. The fit loop packs its
  points into boxes instead (``operators.blocks``).

The centres are a handful of Python floats captured in the closure (K x 2 doubles), so nothing grows
with the data. Both forms give bit-identical distances (``dx*dx + dy*dy`` in IEEE doubles).
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centroidal.functions.geometry import Centre, sq_dist

# The UDF bodies below are shipped by value, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

X, Y = "pickup_longitude", "pickup_latitude"


def nearest_numpy(x: np.ndarray, y: np.ndarray, cx: np.ndarray, cy: np.ndarray):
    """Index and squared distance of the nearest centre per point; strict ``<`` keeps the first minimum."""
    best = np.full(x.shape[0], np.inf)
    idx = np.zeros(x.shape[0], dtype=np.int32)
    for k in range(cx.shape[0]):
        dx = x - cx[k]
        dy = y - cy[k]
        d = dx * dx + dy * dy
        closer = d < best
        np.copyto(best, d, where=closer)
        np.copyto(idx, k, where=closer)
    return idx, best


def box_candidates(boxes: np.ndarray, cx: np.ndarray, cy: np.ndarray) -> np.ndarray:
    """Boolean matrix (boxes x centres): the centres that can be nearest to some point of a box ``x0, x1, y0, y1``.

    A centre is out if its least distance to the box is above some centre's greatest. Both are computed with the
    operations of a point's distance, and rounding is monotonic, so no point's computed minimum is lost.
    """
    def sides(low: np.ndarray, high: np.ndarray, c: np.ndarray):
        a, b = low[:, None] - c[None, :], high[:, None] - c[None, :]
        near = np.maximum(np.maximum(a, -b), 0.0)  # 0 where the centre lies between both sides
        far = np.maximum(np.abs(a), np.abs(b))
        return near * near, far * far
    nx, fx = sides(boxes[:, 0], boxes[:, 1], cx)
    ny, fy = sides(boxes[:, 2], boxes[:, 3], cy)
    return nx + ny <= (fx + fy).min(axis=1, keepdims=True)


def z_order(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Interleaved bits of both coordinates, each in 2^16 steps of its range."""
    def spread(v: np.ndarray) -> np.ndarray:
        low, high = v.min(), v.max()
        step = np.zeros(len(v)) if high == low else (v - low) * (65535.0 / (high - low))
        bits = np.nan_to_num(step).astype(np.uint64) & np.uint64(0xFFFF)
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            bits = (bits | (bits << np.uint64(shift))) & np.uint64(mask)
        return bits
    with np.errstate(invalid="ignore", over="ignore"):
        return spread(x) | (spread(y) << np.uint64(1))


#: Up to so many centres a scan of all is as fast; points that share a box at first and in the end; pairs that are
#: measured at a time.
FEW_CENTRES, BLOCK_POINTS, LEAF_POINTS, PAIRS_AT_ONCE = 100, 256, 16, 1 << 20


def _ranges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``first[i] .. first[i] + counts[i] - 1`` for all i, one after another."""
    return np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def nearest_in_blocks(x: np.ndarray, y: np.ndarray, sizes: np.ndarray, candidates: np.ndarray, cx: np.ndarray, cy: np.ndarray):
    """Nearest centre of the points of consecutive blocks, each against its own candidates (a row of the boolean
    matrix): ids, squared distances and how many were computed.

    Blocks of neighbours are cut into four again and again, and each part keeps only the candidates that can be nearest
    to one of its points, until parts are small or have a single candidate; then points are measured.
    """
    ids, best, pairs = np.zeros(len(x), np.int32), np.full(len(x), np.inf), 0
    if not len(x):
        return ids, best, pairs
    start, size = np.cumsum(sizes) - sizes, np.asarray(sizes)
    _, centre = np.nonzero(candidates)
    count = candidates.sum(axis=1)
    while len(centre) > len(start) and (size.max() > LEAF_POINTS or size.max() > 4 and len(centre) > LEAF_POINTS * len(start)):
        quarter = -(-size // 4)
        cuts = -(-size // quarter)
        part = np.repeat(np.arange(len(start)), cuts)
        nth = _ranges(np.zeros(len(cuts), np.int64), cuts)
        centre = centre[_ranges((np.cumsum(count) - count)[part], count[part])]
        of = np.repeat(np.arange(len(part)), count[part])
        end, start = (start + size)[part], start[part] + nth * quarter[part]
        size = np.minimum(quarter[part], end - start)
        # the pairs of parts and centres that stay, by the rule of box_candidates
        near, far = np.zeros(len(of)), np.zeros(len(of))
        for v, c in ((x, cx), (y, cy)):
            low, high = np.minimum.reduceat(v, start)[of] - c[centre], np.maximum.reduceat(v, start)[of] - c[centre]
            side = np.maximum(np.maximum(low, -high), 0.0)
            near += side * side
            side = np.maximum(np.abs(low), np.abs(high))
            far += side * side
        first = np.cumsum(count[part]) - count[part]
        keep = near <= np.minimum.reduceat(far, first)[of]
        centre, count = centre[keep], np.add.reduceat(keep.astype(np.int64), first)
    at, todo = 0, size * count
    first = np.cumsum(count) - count
    while at < len(start):  # parts whose pairs fit, one part at least
        upto = max(at + 1, int(np.searchsorted(np.cumsum(todo[at:]), PAIRS_AT_ONCE, side="right")) + at)
        rows = _ranges(start[at:upto], size[at:upto])
        each = np.repeat(count[at:upto], size[at:upto])
        c = centre[_ranges(np.repeat(first[at:upto], size[at:upto]), each)]
        dx, dy = np.repeat(x[rows], each) - cx[c], np.repeat(y[rows], each) - cy[c]
        d = dx * dx + dy * dy
        begin = np.cumsum(each) - each
        least = np.minimum.reduceat(d, begin)
        hits = np.flatnonzero(d == np.repeat(least, each))
        ids[rows], best[rows] = c[hits[np.searchsorted(hits, begin)]], least  # the first; centres are in order
        pairs, at = pairs + len(d), upto
    return ids, best, pairs


def nearest_filtered(x: np.ndarray, y: np.ndarray, cx: np.ndarray, cy: np.ndarray):
    """``nearest_numpy`` for many centres, and the number of distances computed: the points go in Z-order, in blocks of
    neighbours, and boxes tell which centres to measure."""
    order = np.argsort(z_order(x, y), kind="stable")
    px, py = x[order], y[order]
    starts = np.arange(0, len(x), BLOCK_POINTS)
    boxes = np.stack([side.reduceat(v, starts) for v in (px, py) for side in (np.minimum, np.maximum)], axis=1)
    ids, d, pairs = nearest_in_blocks(px, py, np.diff(np.append(starts, len(x))), box_candidates(boxes, cx, cy), cx, cy)
    idx, best = np.empty_like(ids), np.empty_like(d)
    idx[order], best[order] = ids, d
    return idx, best, pairs


def nearest_any(x: np.ndarray, y: np.ndarray, cx: np.ndarray, cy: np.ndarray):
    """Index and squared distance of the nearest centre per point, the lowest id on ties, for any K; 0 and infinity
    where a coordinate is missing."""
    if len(cx) <= FEW_CENTRES or not len(x):
        return nearest_numpy(x, y, cx, cy)
    ok = ~(np.isnan(x) | np.isnan(y))
    idx, best = np.zeros(len(x), np.int32), np.full(len(x), np.inf)
    if ok.any():
        idx[ok], best[ok], _ = nearest_filtered(x[ok], y[ok], cx, cy)
    return idx, best


def _as_arrays(centres: Sequence[Centre]):
    if len(centres) == 0:
        raise ValueError("at least one centre is needed")
    arr = np.asarray(centres, dtype=np.float64).reshape(-1, 2)
    return arr[:, 0].copy(), arr[:, 1].copy()


def _ids(idx: np.ndarray, invalid: np.ndarray) -> pd.Series:
    out = pd.Series(idx, dtype="Int32")
    out[invalid] = pd.NA
    return out


def nearest_udf(centres: Sequence[Centre], prev_centres: Sequence[Centre] | None = None):
    """Arrow UDF over (x, y) returning ``struct<cluster_id, sq_dist[, prev_cluster]>``.

    With ``prev_centres`` the same pass also assigns against the previous centres, so a Lloyd step
    gets the moved count without caching the previous assignment (D3). Rows with a NULL or NaN
    coordinate get NULL ids.
    """
    cx, cy = _as_arrays(centres)
    if prev_centres is None:
        @F.pandas_udf("cluster_id int, sq_dist double")
        def nearest(x: pd.Series, y: pd.Series) -> pd.DataFrame:
            xv, yv = x.to_numpy(dtype=np.float64, na_value=np.nan), y.to_numpy(dtype=np.float64, na_value=np.nan)
            invalid = np.isnan(xv) | np.isnan(yv)
            idx, best = nearest_any(xv, yv, cx, cy)
            best[invalid] = np.nan
            return pd.DataFrame({"cluster_id": _ids(idx, invalid), "sq_dist": best})
        return nearest

    px, py = _as_arrays(prev_centres)

    @F.pandas_udf("cluster_id int, sq_dist double, prev_cluster int")
    def nearest_pair(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        xv, yv = x.to_numpy(dtype=np.float64, na_value=np.nan), y.to_numpy(dtype=np.float64, na_value=np.nan)
        invalid = np.isnan(xv) | np.isnan(yv)
        idx, best = nearest_any(xv, yv, cx, cy)
        pidx, _ = nearest_any(xv, yv, px, py)
        best[invalid] = np.nan
        return pd.DataFrame({"cluster_id": _ids(idx, invalid), "sq_dist": best,
                             "prev_cluster": _ids(pidx, invalid)})
    return nearest_pair


def with_nearest_expr(df: DataFrame, centres: Sequence[Centre], x=X, y=Y, prefix: str = "") -> DataFrame:
    """Add ``{prefix}cluster_id`` and ``{prefix}sq_dist`` with built-in expressions only (codegen form).

    Built as staged projections - the K distances, then their ``least``, then the first index equal
    to it - so the expression tree grows with K, not K^2 (Catalyst does not collapse projections
    that would duplicate non-trivial expressions).
    """
    if len(centres) == 0:
        raise ValueError("at least one centre is needed")
    xc = F.col(x) if isinstance(x, str) else x
    yc = F.col(y) if isinstance(y, str) else y
    tmp = [f"__{prefix}d{i}" for i in range(len(centres))]
    staged = df.withColumns({t: sq_dist(xc, yc, cx, cy) for t, (cx, cy) in zip(tmp, centres)})
    m = f"__{prefix}m"
    staged = staged.withColumn(m, F.least(*[F.col(t) for t in tmp]) if len(tmp) > 1 else F.col(tmp[0]))
    if len(tmp) == 1:
        arg = F.lit(0)
    else:
        arg = F.when(F.col(tmp[0]) == F.col(m), F.lit(0))
        for i, t in enumerate(tmp[1:-1], start=1):
            arg = arg.when(F.col(t) == F.col(m), F.lit(i))
        arg = arg.otherwise(F.lit(len(tmp) - 1))
    invalid = xc.isNull() | yc.isNull() | F.isnan(xc) | F.isnan(yc)
    staged = staged.withColumns({
        f"{prefix}cluster_id": F.when(~invalid, arg.cast("int")),
        f"{prefix}sq_dist": F.when(~invalid, F.col(m)),
    })
    return staged.drop(*tmp, m)


def nearest_struct(centres: Sequence[Centre], x=X, y=Y, prev_centres: Sequence[Centre] | None = None) -> Column:
    """Arrow-UDF column ``struct<cluster_id, sq_dist[, prev_cluster]>``."""
    xc = F.col(x) if isinstance(x, str) else x
    yc = F.col(y) if isinstance(y, str) else y
    return nearest_udf(centres, prev_centres)(xc, yc)


def assign_nearest(df: DataFrame, centres: Sequence[Centre], x=X, y=Y, out: str = "cluster_id",
                   dist_col: str | None = None, method: str = "arrow") -> DataFrame:
    """Add the id of the nearest centre (and optionally its squared distance) to every row.

    A narrow transformation: no shuffle, no join, works unchanged on streaming DataFrames.
    ``method``: ``"arrow"`` (vectorised UDF) or ``"expr"`` (built-in expressions).
    """
    if method == "expr":
        res = with_nearest_expr(df, centres, x, y, prefix="__n_")
        res = res.withColumn(out, F.col("__n_cluster_id"))
        if dist_col:
            res = res.withColumn(dist_col, F.col("__n_sq_dist"))
        return res.drop("__n_cluster_id", "__n_sq_dist")
    if method != "arrow":
        raise ValueError(f"unknown assignment method {method!r}; use 'arrow' or 'expr'")
    s = nearest_struct(centres, x, y)
    tmp = "__nearest"
    res = df.withColumn(tmp, s).withColumn(out, F.col(f"{tmp}.cluster_id"))
    if dist_col:
        res = res.withColumn(dist_col, F.col(f"{tmp}.sq_dist"))
    return res.drop(tmp)


PARTIALS_SCHEMA = "cluster_id int, sx decimal(38,0), sy decimal(38,0), n bigint, sse double, moved bigint"


def exact_weighted_sums(idx: np.ndarray, units: np.ndarray, weights: np.ndarray, k: int) -> list[int]:
    """Per-cluster sums of ``units x weights`` as Python integers: the weights are taken apart into limbs
    so small that no int64 sum over the batch can overflow."""
    top = int(np.abs(units).max(initial=0)).bit_length()
    bits = min(31, 62 - top - int(len(units)).bit_length())
    if bits < 1:
        raise OverflowError("coordinates are too large for exact sums; use a smaller scale")
    total = [0] * k
    for shift in range(0, 63, bits):
        limb = (weights >> shift) & ((1 << bits) - 1)
        if limb.any():
            sums = np.zeros(k, np.int64)
            np.add.at(sums, idx, units * limb)
            total = [t + (int(s) << shift) for t, s in zip(total, sums)]
    return total


def lloyd_partials_fn(centres: Sequence[Centre], prev_centres: Sequence[Centre] | None, x: str = X, y: str = Y,
                      weight: str | None = None, scale: int = 6):
    """``mapInArrow`` body of one Lloyd pass: per-cluster partial sums of one partition.

    For every Arrow batch: assign to ``centres`` (and ``prev_centres``), round coordinates to
    10^-scale units and add per-cluster sums, exactly: a batch's unweighted sums stay far below 2^53,
    where a ``bincount`` of integers is exact, weighted ones go through ``exact_weighted_sums``, and
    batches add up in Python integers. Negative weights and a total weight beyond int64 raise. After the last batch the partition yields at
    most K rows ``cluster_id, sx, sy, n, sse, moved``; Spark merges them by cluster. Rows with a
    missing coordinate are skipped.
    """
    cx, cy = _as_arrays(centres)
    pc = _as_arrays(prev_centres) if prev_centres is not None else None
    k = cx.shape[0]
    unit = float(10 ** scale)

    def partials(batches):
        n, sx, sy, mv = ([0] * k for _ in range(4))

        def add(total, values):
            return [t + int(v) if v else t for t, v in zip(total, values)]

        sse = np.zeros(k, np.float64)
        for batch in batches:
            # Arrow batches straight to NumPy (NULL -> NaN), no pandas conversion.
            xv = batch.column(x).to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
            yv = batch.column(y).to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
            ok = ~(np.isnan(xv) | np.isnan(yv))
            if not ok.all():
                xv, yv = xv[ok], yv[ok]
            if xv.shape[0] == 0:
                continue
            idx, d = nearest_any(xv, yv, cx, cy)
            moved = None if pc is None else nearest_any(xv, yv, pc[0], pc[1])[0] != idx
            # Integer-valued doubles (|units| < 2^53), so unweighted bincount sums below are exact.
            ux = np.floor(xv * unit + 0.5)
            uy = np.floor(yv * unit + 0.5)
            if weight is None:
                cnt = np.bincount(idx, minlength=k).astype(np.int64)
                n = add(n, cnt)
                sx = add(sx, np.bincount(idx, weights=ux, minlength=k))
                sy = add(sy, np.bincount(idx, weights=uy, minlength=k))
                sse += np.bincount(idx, weights=d, minlength=k)
                mv = add(mv, cnt if moved is None else np.bincount(idx, weights=moved, minlength=k))
            else:
                w = batch.column(weight).to_numpy(zero_copy_only=False).astype(np.int64)
                if not ok.all():
                    w = w[ok]
                if (w < 0).any():
                    raise ValueError("weights are multiplicities and cannot be negative")
                ones = np.ones(len(w), np.int64)
                n = add(n, exact_weighted_sums(idx, ones, w, k))
                sx = add(sx, exact_weighted_sums(idx, ux.astype(np.int64), w, k))
                sy = add(sy, exact_weighted_sums(idx, uy.astype(np.int64), w, k))
                mv = add(mv, exact_weighted_sums(idx, ones if moved is None else moved.astype(np.int64), w, k))
                sse += np.bincount(idx, weights=d * w, minlength=k)
        kept = [i for i in range(k) if n[i] > 0]
        if kept:
            if max(n) >= 1 << 63:
                raise OverflowError("total weight of a cluster exceeds int64")
            whole = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept, pa.int32()), pa.array([Decimal(sx[i]) for i in kept], whole),
                 pa.array([Decimal(sy[i]) for i in kept], whole), pa.array([n[i] for i in kept], pa.int64()),
                 pa.array(sse[kept]), pa.array([mv[i] for i in kept], pa.int64())],
                names=["cluster_id", "sx", "sy", "n", "sse", "moved"])
    return partials


def register_nearest_centre(spark, centres: Sequence[Centre], name: str = "nearest_centre") -> str:
    """Register ``name(x, y) -> int`` for SQL: the id of the nearest of ``centres`` (Arrow UDF).

    Example: ``SELECT nearest_centre(pickup_longitude, pickup_latitude) AS cluster_id FROM points``.
    The centres are bound at registration (K pairs of floats in the UDF closure).
    """
    cx, cy = _as_arrays(centres)

    @F.pandas_udf("int")
    def nearest_id(x: pd.Series, y: pd.Series) -> pd.Series:
        xv, yv = x.to_numpy(dtype=np.float64, na_value=np.nan), y.to_numpy(dtype=np.float64, na_value=np.nan)
        idx, _ = nearest_any(xv, yv, cx, cy)
        return _ids(idx, np.isnan(xv) | np.isnan(yv))

    spark.udf.register(name, nearest_id)
    return name
