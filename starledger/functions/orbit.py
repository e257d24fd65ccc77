"""Orbit regime from mean motion (revolutions per day) and eccentricity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starledger.functions.text import column

# Regime limits.
LEO_MIN_MEAN_MOTION = 11.25
MEO_MIN_MEAN_MOTION = 1.5
MEO_MAX_ECCENTRICITY = 0.25
GEO_MEAN_MOTION = (0.97, 1.03)
GEO_MAX_ECCENTRICITY = 0.05
HEO_MIN_ECCENTRICITY = 0.25
REGIMES = ("LEO", "MEO", "GEO", "HEO", "unknown")


def orbit_regime(mean_motion: Column | str, eccentricity: Column | str) -> Column:
    """LEO, MEO, GEO, HEO or unknown, first rule wins; null when an input is null."""
    motion, ecc = column(mean_motion), column(eccentricity)
    return (
        F.when(motion.isNull() | ecc.isNull(), F.lit(None).cast("string"))
        .when(motion > LEO_MIN_MEAN_MOTION, "LEO")
        .when((motion > MEO_MIN_MEAN_MOTION) & (ecc < MEO_MAX_ECCENTRICITY), "MEO")
        .when(motion.between(*GEO_MEAN_MOTION) & (ecc < GEO_MAX_ECCENTRICITY), "GEO")
        .when(ecc >= HEO_MIN_ECCENTRICITY, "HEO")
        .otherwise("unknown")
    )
