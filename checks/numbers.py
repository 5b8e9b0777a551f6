"""Rounding that every SQL engine does alike."""

from pyspark.sql import Column
from pyspark.sql import functions as F


# Sums of doubles depend on their order in the last bits, so a value halfway between two
# results may fall on either side of it. The bias puts all of them above.
HALF = 0.5001


def fixed(col, digits=2) -> Column:
    """Half-up rounding through floor; round(double) breaks ties differently per engine."""
    col = F.col(col) if isinstance(col, str) else col
    scale = float(10**digits)
    return (F.floor(col * scale + HALF) / scale).cast("double")
