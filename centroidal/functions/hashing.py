"""Keyed uniform numbers for sampling and weighted draws.

``df.sample`` and ``rand(seed)`` depend on how the rows are partitioned. The draws here are a pure
function of (seed, stream, row key), so a rerun, a lost executor or another partitioning gives the
same sample and the same seeds, and any engine with ``md5`` can reproduce them.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The uniform is (first 13 hex digits of md5 as an integer + 1) / (2^52 + 1).
HEX_DIGITS = 13
DENOMINATOR = float(2 ** 52 + 1)


def hash_uniform(key, seed: int, stream: str) -> Column:
    """Uniform number in (0, 1) from md5('<seed>:<stream>:<key>'); never exactly 0 or 1."""
    key_col = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.lit(f"{seed}:{stream}:"), key_col.cast("string"))
    top = F.conv(F.substring(F.md5(text), 1, HEX_DIGITS), 16, 10).cast("double")
    return (top + F.lit(1.0)) / F.lit(DENOMINATOR)


def hash_uniform_sql(key_sql: str, seed: int, stream: str) -> str:
    """The same uniform as a DuckDB expression (used by the oracles)."""
    return (f"((('0x' || substr(md5('{seed}:{stream}:' || CAST({key_sql} AS VARCHAR)), 1, {HEX_DIGITS}))"
            f"::BIGINT)::DOUBLE + 1.0::DOUBLE) / {DENOMINATOR!r}::DOUBLE")


def uniform_value(key, seed: int, stream: str) -> float:
    """``hash_uniform`` of one key, on the driver."""
    top = int(hashlib.md5(f"{seed}:{stream}:{key}".encode()).hexdigest()[:HEX_DIGITS], 16)
    return (float(top) + 1.0) / DENOMINATOR


def exponential_value(key, weight: float, seed: int, stream: str) -> float | None:
    """``exponential_key`` of one key, on the driver."""
    return -math.log(uniform_value(key, seed, stream)) / weight if weight > 0 else None


def exponential_key(key, weight, seed: int, stream: str) -> Column:
    """``-ln(u) / w``: the row with the least key is a draw with probability proportional to ``w``.

    (Efraimidis and Spirakis, 2006.) Rows with ``w <= 0`` get NULL and are never drawn.
    """
    w = F.col(weight) if isinstance(weight, str) else weight
    u = hash_uniform(key, seed, stream)
    return F.when(w > 0, -F.ln(u) / w)
