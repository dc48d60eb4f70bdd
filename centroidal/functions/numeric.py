"""Engine-independent rounding and order-independent sums of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c, digits: int = 6) -> Column:
    """``floor(c * 10^digits + 0.5) / 10^digits`` as a double.

    Written out (one multiply, one add, floor, one divide) so any engine that evaluates the same
    expression on the same double gets the same bits; built-in ``round`` differs between engines on
    near-ties.
    """
    col = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    return (F.floor(col * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale))


def round_half_up_sql(expr: str, digits: int = 6) -> str:
    scale = float(10 ** digits)
    return f"(floor(({expr}) * {scale!r}::DOUBLE + 0.5::DOUBLE)::DOUBLE / {scale!r}::DOUBLE)"


#: A double is summed as its whole part and LIMBS parts of LIMB_BITS fractional bits, all integers; what lies below the
#: last limb (2^-120) is dropped row by row.
LIMB_BITS, LIMBS = 24, 5


def _limbs(c: Column) -> list[Column]:
    """The whole part and the fractional limbs of a double: floor, scaling by 2^24 and the differences are exact."""
    parts, rest = [F.floor(c)], c - F.floor(c)
    for _ in range(LIMBS):
        scaled = rest * F.lit(float(1 << LIMB_BITS))
        parts.append(F.floor(scaled))
        rest = scaled - F.floor(scaled)
    return parts


def exact_double_sum(c) -> Column:
    """Sum of doubles that does not depend on the order or the partitioning (aggregate).

    Integer limbs are summed as bigint and put together once: carries go up, then whole part and fraction are added
    as doubles. Exact to the last bits of a double for up to 5 * 10^11 rows of magnitude below 2^53; NULL rows are
    skipped, and NULL is the sum of none.
    """
    col = F.col(c) if isinstance(c, str) else c
    sums = [F.sum(p) for p in _limbs(col)]
    digits, carry = [], F.lit(0).cast("bigint")
    for s in reversed(sums[1:]):
        s = s + carry
        digits.append(s.bitwiseAND(F.lit((1 << LIMB_BITS) - 1).cast("bigint")))
        carry = F.shiftright(s, LIMB_BITS)
    d5, d4, d3, d2, d1 = digits
    upper = (d1 * F.lit(1 << LIMB_BITS) + d2).cast("double") / F.lit(float(1 << 2 * LIMB_BITS))
    lower = (d3 * F.lit(1 << LIMB_BITS) + d4).cast("double") / F.lit(2.0 ** (4 * LIMB_BITS))
    return (sums[0] + carry).cast("double") + (upper + lower)


def exact_double_sum_sql(expr: str) -> str:
    """``exact_double_sum`` as a DuckDB expression over an aggregate's rows."""
    unit = f"{float(1 << LIMB_BITS)!r}::DOUBLE"
    limbs, rest = [f"floor({expr})"], f"(({expr}) - floor({expr}))"
    for _ in range(LIMBS):
        limbs.append(f"floor({rest} * {unit})")
        rest = f"({rest} * {unit} - floor({rest} * {unit}))"
    sums = [f"sum(({limb})::BIGINT)::BIGINT" for limb in limbs]
    fields = ", ".join(f"'s{i}': {s}" for i, s in enumerate(sums))
    value = f"[{{{fields}}}]"
    carries = {LIMBS + 1: "0"}
    for i in range(LIMBS, 0, -1):
        carries[i] = f"((s.s{i} + {carries[i + 1]}) >> {LIMB_BITS})"
    digit = {i: f"((s.s{i} + {carries[i + 1]}) & {(1 << LIMB_BITS) - 1})" for i in range(1, LIMBS + 1)}
    upper = f"({digit[1]} * {1 << LIMB_BITS} + {digit[2]})::DOUBLE / {float(1 << 2 * LIMB_BITS)!r}::DOUBLE"
    lower = f"({digit[3]} * {1 << LIMB_BITS} + {digit[4]})::DOUBLE / {2.0 ** (4 * LIMB_BITS)!r}::DOUBLE"
    return f"list_transform({value}, lambda s: (s.s0 + {carries[1]})::DOUBLE + ({upper} + {lower}))[1]"
