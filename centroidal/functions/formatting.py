"""Number formatting for text sinks and reports (F5). Applied at the sink only; queries keep doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed(c, decimals: int) -> Column:
    """Fixed-point text with ``decimals`` digits and no grouping, e.g. ``-73.981234``."""
    return F.format_string(f"%.{decimals}f", _col(c))


def scientific(c, decimals: int = 4) -> Column:
    """Scientific text such as ``1.3130e+03``."""
    return F.format_string(f"%.{decimals}e", _col(c))


def thousands(c, decimals: int = 0) -> Column:
    """Grouped text such as ``36,830,903``."""
    return F.format_number(_col(c), decimals)


def times(c, decimals: int = 2) -> Column:
    """Speedup text such as ``2.65x``."""
    return F.concat(fixed(c, decimals), F.lit("x"))


def percent(c, decimals: int = 1) -> Column:
    """Percentage text such as ``33.2%``."""
    return F.concat(fixed(c, decimals), F.lit("%"))
