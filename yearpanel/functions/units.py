"""Unit normalisation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a figure is divided by to reach the scale of the target unit.
# MW is a power and not an energy; the divisor is kept because the figures depend on it.
GWH_DIVISORS = {
    "GWh": 1.0,
    "MW": 1000.0,
}


def normalised(unit: Column, value: Column, divisors: Mapping[str, float] = GWH_DIVISORS) -> Column:
    """``value`` divided by its unit's divisor; a unit not listed leaves it unchanged."""
    divisor = F.lit(1.0)
    for name, number in divisors.items():
        if number != 1.0:
            divisor = F.when(unit == name, F.lit(number)).otherwise(divisor)
    return value / divisor
