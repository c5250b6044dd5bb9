"""Elevations in metres and their 16-bit codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The elevation of code 0 and the metres of a step.
ORIGIN, STEP = -16384.0, 0.5


def synthetic(lat: Column, lon: Column, amplitude: int) -> Column:
    """Analytic test terrain: amplitude * (0.55 z + 0.25 x y + 0.20 (x^2 - y^2)) of the unit vector (x, y, z)."""
    x, y, z = F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)
    return F.lit(float(amplitude)) * (F.lit(0.55) * z + F.lit(0.25) * x * y + F.lit(0.20) * (x * x - y * y))


def quantize(metres: Column) -> Column:
    """Code of an elevation, ties to even; null if it is not finite or its code, before rounding, not in 0 to 65535."""
    scaled = (metres - ORIGIN) / STEP
    return F.when(~F.isnan(scaled) & scaled.between(0.0, 65535.0), F.rint(scaled).cast("int"))


def dequantize(code: Column) -> Column:
    return (F.lit(ORIGIN) + code * F.lit(STEP)).cast("float")


def millimetres(metres: Column) -> Column:
    """Whole millimetres, half away from zero; null if not finite or beyond 32 unsigned bits."""
    mm = F.floor(F.abs(metres) * 1000.0 + 0.5) * F.signum(metres)
    return F.when(~F.isnan(metres) & (F.abs(metres) < 4294967.5) & mm.between(0.0, 4294967295.0), mm.cast("long"))


def to_elevation(value: Column, flags: Column, radius: float = 1737400.0) -> Column:
    """Elevation of a source's value: a radius, if bit 0 of its flags says so, less the reference radius."""
    return F.when(flags.bitwiseAND(F.lit(1)) == 1, value - radius).otherwise(value)
