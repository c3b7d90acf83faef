"""Geographic column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataflow.functions.expr import col

EARTH_KM, MERCATOR_M, MAX_LATITUDE = 6371.0, 6378137.0, 85.0511
#: GRS 80 first eccentricity.
_E = math.sqrt(2 / 298.257222101 - 1 / 298.257222101**2)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """B22."""
    a, b, c, d = [F.radians(col(x)) for x in (lat1, lon1, lat2, lon2)]
    h = F.pow(F.sin((c - a) / 2), 2) + F.cos(a) * F.cos(c) * F.pow(F.sin((d - b) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def mercator(lon, lat) -> Column:
    """B31. struct<x, y> in metres."""
    held = F.radians(F.least(F.greatest(col(lat), F.lit(-MAX_LATITUDE)), F.lit(MAX_LATITUDE)))
    return F.struct((F.radians(col(lon)) * MERCATOR_M).alias("x"), (F.log(F.tan(F.lit(math.pi / 4) + held / 2)) * MERCATOR_M).alias("y"))


def _t(lat: Column) -> Column:
    s = F.sin(lat) * _E
    return F.tan(F.lit(math.pi / 4) - lat / 2) / F.pow((1 - s) / (1 + s), F.lit(_E / 2))


def _m(lat: Column) -> Column:
    return F.cos(lat) / F.sqrt(1 - F.pow(F.sin(lat) * _E, 2))


def _cone(lat1, lat2, lat0):
    a, b, o = [F.radians(col(x)) for x in (lat1, lat2, lat0)]
    n = F.when(F.abs(a - b) < 1e-12, F.sin(a)).otherwise((F.log(_m(a)) - F.log(_m(b))) / (F.log(_t(a)) - F.log(_t(b))))
    f = _m(a) / (n * F.pow(_t(a), n))
    return n, f, MERCATOR_M * f * F.pow(_t(o), n)


def lcc_forward(lon, lat, lat1, lat2, lat0, lon0) -> Column:
    """B31. struct<x, y> in metres on the ellipsoid (Snyder 1987, equations 15-1 to 15-11)."""
    n, f, rho0 = _cone(lat1, lat2, lat0)
    rho = MERCATOR_M * f * F.pow(_t(F.radians(col(lat))), n)
    angle = n * F.radians(col(lon) - col(lon0))
    return F.struct((rho * F.sin(angle)).alias("x"), (rho0 - rho * F.cos(angle)).alias("y"))


def lcc_inverse(x, y, lat1, lat2, lat0, lon0) -> Column:
    """B31. struct<lon, lat>; the latitude's series is iterated six times."""
    n, f, rho0 = _cone(lat1, lat2, lat0)
    x, y = col(x), col(y)
    rho = F.signum(n) * F.sqrt(x * x + F.pow(rho0 - y, 2))
    t = F.pow(rho / (MERCATOR_M * f), 1 / n)
    lat = F.lit(math.pi / 2) - 2 * F.atan(t)
    for _ in range(6):
        s = F.sin(lat) * _E
        lat = F.lit(math.pi / 2) - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(_E / 2)))
    angle = F.atan2(F.signum(n) * x, F.signum(n) * (rho0 - y))
    return F.struct((F.degrees(angle / n) + col(lon0)).alias("lon"), F.degrees(lat).alias("lat"))


def windows(west, east) -> Column:
    """B32. array<struct<west, east>>: one window, or two on either side of the antimeridian if the span is over 180 degrees."""
    w, e = col(west).cast("double"), col(east).cast("double")
    win = lambda a, b: F.struct(a.alias("west"), b.alias("east"))
    return F.when(e - w > 180, F.array(win(F.lit(-180.0), w), win(e, F.lit(180.0)))).otherwise(F.array(win(w, e)))


def split_ring(ring) -> Column:
    """B32. array of rings (arrays of struct<lon, lat>, closed): a closed ring as it is, or, where its longitudes span over 180 degrees, the parts of it on either side of the antimeridian, west of it first.

    Such a ring is read the short way round: western longitudes count as beyond 180. Each part is what one side of that meridian leaves of the ring (corners on it belong to both), closed again; the eastern
    one's longitudes are those from -180 on. A part without area is left out; null has no rings.
    """
    r = col(ring)
    lons = F.transform(r, lambda p: p["lon"])
    point = lambda lon, lat: F.struct(lon.alias("lon"), lat.alias("lat"))
    around = F.transform(r, lambda p: point(F.when(p["lon"] < 0, p["lon"] + 360).otherwise(p["lon"]), p["lat"]))
    none = F.expr("cast(array() as array<struct<lon:double,lat:double>>)")

    def side(inside, lower: float) -> Column:
        def step(a: Column, b: Column) -> Column:
            # a corner that is inside, then the place where the edge after it crosses
            share = (180.0 - a["lon"]) / (b["lon"] - a["lon"])
            cross = point(F.lit(180.0 - lower), a["lat"] + share * (b["lat"] - a["lat"]))
            crossed = (a["lon"] < 180) & (b["lon"] > 180) | (a["lon"] > 180) & (b["lon"] < 180)
            return F.concat(F.when(inside(a), F.array(point(a["lon"] - lower, a["lat"]))).otherwise(none), F.when(crossed, F.array(cross)).otherwise(none))

        kept = F.flatten(F.zip_with(F.slice(around, 1, F.size(around) - 1), F.slice(around, 2, F.size(around) - 1), step))
        return F.transform(F.array(kept), lambda k: F.when(F.size(k) > 0, F.concat(k, F.slice(k, 1, 1))))[0]

    both = F.array(side(lambda p: p["lon"] <= 180, 0.0), side(lambda p: p["lon"] >= 180, 360.0))
    parts = F.filter(both, lambda k: k.isNotNull() & (F.size(F.array_distinct(k)) > 2))
    return F.when(F.array_max(lons) - F.array_min(lons) > 180, parts).when(r.isNotNull(), F.array(F.transform(r, lambda p: point(p["lon"], p["lat"])))).otherwise(F.expr("cast(array() as array<array<struct<lon:double,lat:double>>>)"))


def too_wide(west, east, most: float = 90.0) -> Column:
    """B32. Envelopes that matching leaves out."""
    return col(east) - col(west) > most


def world_wide(min_x, max_x, most: float = 35_000_000.0) -> Column:
    """B33."""
    return col(max_x) - col(min_x) >= most


def disjoint_reason(a: str, b: str) -> Column:
    """B34. Why two envelope structs (west, south, east, north) can't meet, else null."""
    g = lambda s, f: F.col(f"{s}.{f}")
    apart = (g(a, "east") < g(b, "west")) | (g(b, "east") < g(a, "west")) | (g(a, "north") < g(b, "south")) | (g(b, "north") < g(a, "south"))
    return F.when(apart, F.format_string("bounds %.4f %.4f %.4f %.4f lie apart from %.4f %.4f %.4f %.4f", *[g(s, f) for s in (a, b) for f in ("west", "south", "east", "north")]))
