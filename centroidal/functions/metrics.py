"""Run-analysis column expressions: text tests (F4), speedup (F6), efficiency (F7), Amdahl (F8),
thread ordering (T4) and throughput (A11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_digits(c) -> Column:
    """True when the text is a non-empty run of ASCII digits (Python ``str.isdigit`` on these inputs)."""
    return _col(c).rlike("^[0-9]+$")


def threads_numeric(c) -> Column:
    """Thread count as an int; text that is not a number (e.g. ``GPU``) counts as 0 (T4)."""
    return F.when(is_digits(c), _col(c).try_cast("int")).otherwise(F.lit(0))


def speedup(baseline_ms, elapsed_ms) -> Column:
    """``baseline / time``; 0 when the time is not positive."""
    t = _col(elapsed_ms)
    return F.when(t > 0, _col(baseline_ms) / t).otherwise(F.lit(0.0))


def parallel_efficiency(speedup_col, threads_col) -> Column:
    """``speedup / threads * 100`` for numeric thread counts (NULL for 0 threads), else 0."""
    t = _col(threads_col)
    return F.when(is_digits(t), F.try_divide(_col(speedup_col), t.try_cast("int")) * F.lit(100.0)).otherwise(F.lit(0.0))


def weak_efficiency(baseline_ms, elapsed_ms) -> Column:
    """``baseline / time * 100`` (F7, weak scaling); NULL for a zero time."""
    return F.try_divide(_col(baseline_ms), _col(elapsed_ms)) * F.lit(100.0)


def amdahl_parallel_fraction(max_speedup, max_threads) -> Column:
    """``p = (1 - 1/S) / (1 - 1/n)``, 0 when ``n <= 1`` (F8)."""
    s, n = _col(max_speedup), _col(max_threads)
    return F.when(n > 1, (F.lit(1.0) - F.try_divide(F.lit(1.0), s)) / (F.lit(1.0) - F.lit(1.0) / n)).otherwise(F.lit(0.0))


def amdahl_limit(p) -> Column:
    """Upper bound of the speedup, ``1 / (1 - p)``, NULL unless ``p < 1`` (F8)."""
    pc = _col(p)
    return F.when(pc < 1, F.lit(1.0) / (F.lit(1.0) - pc))


def throughput(n_points, iterations, elapsed_ms) -> Column:
    """Points per second: ``N * iterations / (ms / 1000)``; NULL for a zero time."""
    return F.try_divide(_col(n_points).cast("double") * _col(iterations), _col(elapsed_ms) / F.lit(1000.0))
