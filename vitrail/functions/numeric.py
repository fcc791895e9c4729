"""Numeric column helpers shared by operators and the registered queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_sig(col: Column | str, digits: int = 10) -> Column:
    """Round a double to ``digits`` significant digits (NULL, NaN and 0 unchanged).

    Sums of doubles depend on partition order; comparing results across engines needs
    a rounding that scales with the magnitude, which a fixed number of decimals cannot.
    """
    x = _c(col).cast("double")
    safe = F.when(x == 0, F.lit(1.0)).otherwise(F.abs(x))
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(safe)))
    return (F.when(x.isNull() | F.isnan(x) | (x == 0), x)
             .otherwise(F.round(x * scale) / scale))


def round_to(col: Column | str, decimals: int) -> Column:
    """Fixed-decimal rounding for bounded values (shares, probabilities, metrics)."""
    return F.round(_c(col).cast("double"), decimals)
