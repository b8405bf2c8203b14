"""Service level to normal quantile."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Service level and its standard-normal quantile.
SERVICE_LEVELS = [
    (0.80, 0.8416),
    (0.90, 1.2816),
    (0.95, 1.6449),
    (0.975, 1.9600),
    (0.99, 2.3263),
]
DEFAULT_SERVICE_LEVEL = 0.95
P90_Z = 1.2816


def z_from_service_level(level: Column) -> Column:
    """Quantile of the nearest listed level; a tie goes to the earlier entry.

    NULL and 0 mean the default level.
    """
    target = F.coalesce(F.nullif(level, F.lit(0.0)), F.lit(DEFAULT_SERVICE_LEVEL))
    entries = [
        F.struct(
            F.abs(F.lit(p) - target).alias("distance"),
            F.lit(order).alias("order"),
            F.lit(z).alias("z"),
        )
        for order, (p, z) in enumerate(SERVICE_LEVELS)
    ]
    return F.array_min(F.array(*entries)).getField("z")
