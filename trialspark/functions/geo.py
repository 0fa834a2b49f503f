"""Great-circle geometry on a sphere of mean Earth radius.

Distances on the spheroid differ from these by at most about 0.5 %.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088
KM_PER_MILE = 1.609344


def _c(value) -> Column:
    if isinstance(value, str):
        return F.col(value)
    return value if isinstance(value, Column) else F.lit(float(value))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    lat1, lon1, lat2, lon2 = (F.radians(_c(v)) for v in (lat1, lon1, lat2, lon2))
    half_lat, half_lon = F.sin((lat2 - lat1) / 2), F.sin((lon2 - lon1) / 2)
    inner = half_lat * half_lat + F.cos(lat1) * F.cos(lat2) * half_lon * half_lon
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(inner, F.lit(1.0))))


def bounding_box(lat: float, lon: float, radius_km: float, lat_col: str, lon_col: str) -> Column:
    """Range filter that every point within the radius passes; it reaches the Parquet scan."""
    reach = math.degrees(radius_km / EARTH_RADIUS_KM) * (1 + 1e-9)
    south, north = lat - reach, lat + reach
    box = F.col(lat_col).between(max(south, -90.0), min(north, 90.0))
    if south <= -90 or north >= 90:
        return box
    ratio = math.sin(math.radians(reach)) / math.cos(math.radians(lat))
    if ratio >= 1:
        return box
    spread = math.degrees(math.asin(ratio)) * (1 + 1e-9)
    west, east = lon - spread, lon + spread
    if west < -180:
        return box & ((F.col(lon_col) >= west + 360) | (F.col(lon_col) <= east))
    if east > 180:
        return box & ((F.col(lon_col) >= west) | (F.col(lon_col) <= east - 360))
    return box & F.col(lon_col).between(west, east)


def earth_xyz(lat: str, lon: str) -> Column:
    """Earth-centred coordinates in km."""
    phi, lam = F.radians(_c(lat)), F.radians(_c(lon))
    axis = lambda v: v * EARTH_RADIUS_KM
    return F.struct(
        axis(F.cos(phi) * F.cos(lam)).alias("x"),
        axis(F.cos(phi) * F.sin(lam)).alias("y"),
        axis(F.sin(phi)).alias("z"),
    )


def _cell_key(x: Column, y: Column, z: Column, edge_km: float) -> Column:
    span = 2 * math.ceil(EARTH_RADIUS_KM / edge_km) + 8
    return (x * span + y) * span + z


def cube_cell(point: Column, edge_km: float) -> Column:
    """Number of the grid cube that holds an Earth-centred point."""
    return _cell_key(*[F.floor(point[a] / edge_km) for a in "xyz"], edge_km)


def cells_in_reach(df: DataFrame, point: str, edge_km: float, alias: str = "cell", reach_km: float | None = None) -> DataFrame:
    """One row per cube that can hold a point within ``reach_km`` (an edge, if not given) of ``point``.

    A chord is never longer than its arc, so such points lie in cubes that the chord reaches;
    poles and the date line need no special case. Of these cubes only those stay that come within
    reach and that the sphere passes through.
    """
    slack = 1e-6
    gap = near = far = F.lit(0.0)
    wide = F.lit(float(edge_km if reach_km is None else reach_km))
    for a in "xyz":
        p, index = F.col(f"{point}.{a}"), F.col(f"_{a}")
        reach = F.sequence(F.floor((p - wide) / edge_km), F.floor((p + wide) / edge_km))
        df = df.withColumn(f"_{a}", F.explode(reach))
        low, high = index * edge_km, (index + 1) * edge_km
        outside = F.greatest(low - p, p - high, F.lit(0.0))
        closest = F.greatest(low, -high, F.lit(0.0))
        farthest = F.greatest(F.abs(low), F.abs(high))
        gap, near, far = gap + outside * outside, near + closest * closest, far + farthest * farthest
    reachable = gap <= (wide + slack) * (wide + slack)
    on_sphere = (near <= (EARTH_RADIUS_KM + slack) ** 2) & (far >= (EARTH_RADIUS_KM - slack) ** 2)
    key = _cell_key(F.col("_x"), F.col("_y"), F.col("_z"), edge_km)
    return df.filter(reachable & on_sphere).withColumn(alias, key).drop("_x", "_y", "_z")


def chord_km(radius_km: float) -> float:
    """The straight line between two points that far apart along the surface."""
    return 2 * EARTH_RADIUS_KM * math.sin(min(radius_km / EARTH_RADIUS_KM, math.pi) / 2)


def distance_decay(km: Column, func: str, scale_km: float, offset_km: float = 0.0, decay: float = 0.5) -> Column:
    """Factor in [0, 1]: 1 up to the offset, ``decay`` at offset + scale."""
    beyond = F.greatest(km - offset_km, F.lit(0.0))
    if func == "exp":
        return F.exp(F.lit(math.log(decay) / scale_km) * beyond)
    if func == "gauss":
        return F.exp(F.lit(math.log(decay) / scale_km**2) * beyond * beyond)
    if func == "linear":
        reach = scale_km / (1.0 - decay)
        return F.greatest((F.lit(reach) - beyond) / reach, F.lit(0.0))
    raise ValueError(f"unknown decay function: {func}")
