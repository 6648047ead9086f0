"""Rounding of doubles by their exact binary value.

``F.round`` decides ties on the shortest decimal spelling of a double, so 2.675 becomes 2.68
although the stored number lies below the tie. Figures here are rounded by the stored number, exact
ties going to the even neighbour.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Splits a double into two halves whose products with a small integer are exact.
SPLITTER = float((1 << 27) + 1)
# Above this the doubled, scaled value has no room for a fraction.
EXACT_LIMIT = float(1 << 52)


def round_exact(value: Column, decimals: int = 4) -> Column:
    """`value` rounded to `decimals` places; plain arithmetic, no decimal strings."""
    scale = 10.0**decimals
    x = value.cast("double")
    doubled = F.rint(x * (2 * scale))
    high = x * SPLITTER - (x * SPLITTER - x)
    # The exact distance from the doubled value to the nearest integer, up to its sign.
    beyond = (high * (2 * scale) - doubled) + (x - high) * (2 * scale)
    below, above = (doubled - 1) / 2, (doubled + 1) / 2
    nearest = (
        F.when(doubled % 2 == 0, doubled / 2)
        .when(beyond > 0, above)
        .when(beyond < 0, below)
        .when(below % 2 == 0, below)
        .otherwise(above)
    )
    return F.when(F.abs(x) * (2 * scale) < EXACT_LIMIT, nearest / scale).otherwise(x)
