"""Quadrilateralized spherical cube: geodetic coordinates to a face's (u, v) and back.

Steps are columns of their own, so that none is computed twice; they are dropped at the end.
"""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetlake.functions import keys

#: Tolerances of the face choice and of the middle of a face.
EDGE, CENTRE = 32 * 2.0**-52, 1e-10
HALF, QUARTER = pi / 2, pi / 4
ROOT = 2.0**0.5 / 2


def _d(x: float) -> Column:
    return F.lit(float(x))


def _clamp(x: Column) -> Column:
    return F.greatest(_d(-1), F.least(_d(1), x))


def normal_longitude(lon: Column) -> Column:
    """Longitude in [-pi, pi); 0 without a sign."""
    out = F.pmod(lon + _d(pi), _d(2 * pi)) - _d(pi)
    return F.when(out == 0, _d(0)).otherwise(out)


def lattice(tile: Column, sample: Column, level: Column) -> Column:
    """Coordinate in [-1, 1] of a sample, 0 to 256, of a tile; null out of range."""
    span = keys.left(F.lit(256).cast("long"), level)
    upper = 2 * (tile.cast("long") * 256 + sample.cast("long")) - span
    good = level.between(0, 28) & sample.between(0, 256) & (tile >= 0) & (tile.cast("long") * 256 < span)
    return F.when(good, upper.cast("double") / span.cast("double"))


def _with_face(df: DataFrame, x: str, y: str, z: str) -> DataFrame:
    """df with face, of the strongest axis; one must beat the best before it by EDGE, so ties go to the lower face.

    Each step is a column, so that what it compares is not written out again in the next.
    """
    out, best, face = df, F.col(x), F.lit(0)
    for k, s in enumerate((F.col(y), -F.col(x), -F.col(y), F.col(z), -F.col(z)), 1):
        wins = s > best + _d(EDGE)
        out = out.withColumns({f"_best{k}": F.when(wins, s).otherwise(best), f"_face{k}": F.when(wins, k).otherwise(face)})
        best, face = F.col(f"_best{k}"), F.col(f"_face{k}")
    return out.withColumn("face", face).drop(*[f"_{n}{k}" for n in ("best", "face") for k in range(1, 6)])


def forward(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """df with face, u and v; null for a latitude beyond the poles and for null or non-finite input."""
    c = F.col
    good = c(lat).between(-HALF, HALF) & (F.abs(c(lon)) < float("inf")) & ~F.isnan(lat) & ~F.isnan(lon)
    out = df.withColumn("_lon", F.when(good, normal_longitude(c(lon)))).withColumn("_lat", F.when(good, c(lat)))
    out = out.withColumns({"_x": F.cos("_lat") * F.cos("_lon"), "_y": F.cos("_lat") * F.sin("_lon"), "_z": F.sin("_lat")})
    out = _with_face(out, "_x", "_y", "_z")
    out = out.withColumn("face", F.when(c("_lat") == HALF, 4).when(c("_lat") == -HALF, 5).when(c("_lat").isNotNull(), c("face")))
    normal = F.when(c("face") == 0, c("_x")).when(c("face") == 1, c("_y")).when(c("face") == 2, -c("_x")).otherwise(-c("_y"))
    side = F.when(c("face") == 0, c("_y")).when(c("face") == 1, -c("_x")).when(c("face") == 2, -c("_y")).otherwise(c("_x"))
    out = out.withColumn("_phi", F.when(c("face") == 4, _d(HALF) - c("_lat")).when(c("face") == 5, _d(HALF) + c("_lat")).otherwise(F.acos(_clamp(normal))))
    # The angle about the face's middle from its first axis: on the polar faces the longitude, turned by a quarter, and seen from the face.
    out = out.withColumn("_a", F.when(c("face") == 4, c("_lon") - HALF).when(c("face") == 5, _d(HALF) - c("_lon")).when(c("_phi") < CENTRE, _d(0)).otherwise(F.atan2(c("_z"), side)))
    out = out.withColumn("_t", F.when(c("_a") > pi, c("_a") - 2 * pi).when(c("_a") <= -pi, c("_a") + 2 * pi).otherwise(c("_a")))
    t, wide = c("_t"), HALF + QUARTER
    out = out.withColumn("_area", F.when(F.abs(t) <= QUARTER, 0).when((t > QUARTER) & (t <= wide), 1).when((t > wide) | (t <= -wide), 2).otherwise(3))
    a = c("_area")
    out = out.withColumn("_theta", F.when(a == 0, t).when(a == 1, t - HALF).when(a == 3, t + HALF).when(t >= 0, t - pi).otherwise(t + pi))
    th = c("_theta")
    out = out.withColumn("_mu", F.atan(_d(12 / pi) * (th + F.acos(F.sin(th) * _d(ROOT)) - _d(HALF))))
    out = out.withColumn("_den", F.cos("_mu") * F.cos("_mu") * (1 - F.cos(F.atan(1 / F.cos(th)))))
    out = out.withColumn("_r", F.sqrt(F.greatest(_d(0), (1 - F.cos("_phi")) / c("_den")))).withColumn("_mu", c("_mu") + a * _d(HALF))
    pole = F.abs(c("_lat")) == HALF
    for name, f in (("u", F.cos), ("v", F.sin)):
        out = out.withColumn(name, F.when(pole, _d(0)).when(c("face").isNotNull(), _clamp(c("_r") * f("_mu"))))
    return out.drop("_lon", "_lat", "_x", "_y", "_z", "_phi", "_a", "_t", "_area", "_theta", "_mu", "_den", "_r")


def inverse(df: DataFrame, face: str = "face", u: str = "u", v: str = "v") -> DataFrame:
    """df with lat and lon; null for a face beyond 0 to 5, coordinates beyond [-1, 1] and null or NaN input."""
    c = F.col
    good = c(face).between(0, 5) & c(u).between(-1, 1) & c(v).between(-1, 1) & ~F.isnan(u) & ~F.isnan(v)
    out = df.withColumns({"_u": F.when(good, c(u)), "_v": F.when(good, c(v))})
    U, V = c("_u"), c("_v")
    area = F.when((U >= 0) & (U >= F.abs(V)), 0).when((V >= 0) & (V >= F.abs(U)), 1).when((U < 0) & (-U >= F.abs(V)), 2).otherwise(3)
    out = out.withColumns({"_area": area, "_m": F.atan2(V, U)})
    m, a = c("_m"), c("_area")
    out = out.withColumn("_mu", F.when(a == 0, m).when(a == 1, m - HALF).when(a == 2, F.when(m < 0, m + pi).otherwise(m - pi)).otherwise(m + HALF))
    out = out.withColumn("_t", _d(pi / 12) * F.tan("_mu"))
    out = out.withColumn("_theta", F.atan(F.sin("_t") / (F.cos("_t") - _d(ROOT))))
    th = c("_theta")
    out = out.withColumn("_nu", F.tan(F.atan(F.hypot(U, V))))
    out = out.withColumn("_q", _clamp(1 - F.cos("_mu") * F.cos("_mu") * c("_nu") * c("_nu") * (1 - F.cos(F.atan(1 / F.cos(th))))))
    q = c("_q")
    out = out.withColumn("_s", F.when(q * q >= 1, _d(0)).otherwise(F.sqrt(F.greatest(_d(0), 1 - q * q)) * F.sin(th)))
    out = out.withColumn("_p", q * q + c("_s") * c("_s"))
    out = out.withColumn("_r", F.when(c("_p") >= 1, _d(0)).otherwise(F.sqrt(F.greatest(_d(0), 1 - c("_p")))))
    r, s = c("_r"), c("_s")
    # Turn by the quarter of the face, then by the face about the axis.
    out = out.withColumns({"_r2": F.when(a == 0, r).when(a == 1, -s).when(a == 2, -r).otherwise(s), "_s2": F.when(a == 0, s).when(a == 1, r).when(a == 2, -s).otherwise(-r)})
    r, f = c("_r2"), c(face)
    out = out.withColumns({"_x": F.when(f == 0, q).when(f == 1, -r).when(f == 2, -q).otherwise(r), "_y": F.when(f == 0, r).when(f == 1, q).when(f == 2, -r).otherwise(-q)})
    lat = F.when(f == 4, _d(HALF) - F.acos(q)).when(f == 5, F.acos(q) - _d(HALF)).otherwise(F.acos(_clamp(-c("_s2"))) - _d(HALF))
    lon = (
        F.when(f == 4, F.when(a == 0, th + HALF).when(a == 1, F.when(th < 0, th + pi).otherwise(th - pi)).when(a == 2, th - HALF).otherwise(th))
        .when(f == 5, F.when(a == 0, -th + HALF).when(a == 1, -th).when(a == 2, -th - HALF).otherwise(F.when(th < 0, -th - pi).otherwise(-th + pi)))
        .otherwise(F.atan2("_y", "_x"))
    )
    out = out.withColumns({"_lat": lat, "_lon": lon})
    pole = F.abs(F.abs(c("_lat")) - HALF) <= EDGE
    out = out.withColumns({"lat": F.when(U.isNotNull(), F.when(pole, F.signum("_lat") * HALF).otherwise(c("_lat"))), "lon": F.when(U.isNotNull(), F.when(pole, _d(0)).otherwise(normal_longitude(c("_lon"))))})
    return out.drop("_u", "_v", "_area", "_m", "_mu", "_t", "_theta", "_nu", "_q", "_s", "_p", "_r", "_r2", "_s2", "_x", "_y", "_lat", "_lon")


def cartesian(lat: Column, lon: Column, height: Column, radius: float = 1737400.0) -> tuple[Column, Column, Column]:
    """Coordinates about the body's centre, in metres."""
    d = _d(radius) + height
    return d * F.cos(lat) * F.cos(lon), d * F.cos(lat) * F.sin(lon), d * F.sin(lat)
