"""Map projection and distances as column expressions.

The projection is the transverse Mercator series of order six in the third
flattening (Karney, "Transverse Mercator with an accuracy of a few
nanometers", 2011). It stays exact far from the central meridian, where the
short textbook series is off by hundreds of metres.
"""

from __future__ import annotations

from math import radians, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# WGS84 ellipsoid, mean earth radius and the UTM grid (metres).
SEMI_MAJOR_AXIS = 6378137.0
FLATTENING = 1 / 298.257223563
EARTH_RADIUS = 6371008.8
SCALE_ON_MERIDIAN = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0

# Series coefficients, one row per harmonic, powers of the third
# flattening ascending from the row's own order.
GEODETIC_TO_GRID = [
    [1 / 2, -2 / 3, 5 / 16, 41 / 180, -127 / 288, 7891 / 37800],
    [13 / 48, -3 / 5, 557 / 1440, 281 / 630, -1983433 / 1935360],
    [61 / 240, -103 / 140, 15061 / 26880, 167603 / 181440],
    [49561 / 161280, -179 / 168, 6601661 / 7257600],
    [34729 / 80640, -3418889 / 1995840],
    [212378941 / 319334400],
]
GRID_TO_GEODETIC = [
    [1 / 2, -2 / 3, 37 / 96, -1 / 360, -81 / 512, 96199 / 604800],
    [1 / 48, 1 / 15, -437 / 1440, 46 / 105, -1118711 / 3870720],
    [17 / 480, -37 / 840, -209 / 4480, 5569 / 90720],
    [4397 / 161280, -11 / 504, -830251 / 7257600],
    [4583 / 161280, -108847 / 3991680],
    [20648693 / 638668800],
]
CONFORMAL_TO_LATITUDE = [
    [2, -2 / 3, -2, 116 / 45, 26 / 45, -2854 / 675],
    [7 / 3, -8 / 5, -227 / 45, 2704 / 315, 2323 / 945],
    [56 / 15, -136 / 35, -1262 / 105, 73814 / 2835],
    [4279 / 630, -332 / 35, -399572 / 14175],
    [4174 / 315, -144838 / 6237],
    [601676 / 22275],
]

_N = FLATTENING / (2 - FLATTENING)
_ECCENTRICITY = 2 * sqrt(_N) / (1 + _N)
_RECTIFYING_RADIUS = SEMI_MAJOR_AXIS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)


def series(rows: list[list[float]]) -> list[float]:
    """The numeric coefficient of each harmonic."""
    return [sum(c * _N ** (order + power) for power, c in enumerate(row))
            for order, row in enumerate(rows, start=1)]


def central_meridian(zone: int) -> float:
    return 6.0 * zone - 183.0


def _harmonics(rows: list[list[float]], term: str) -> str:
    """SQL text of the sum of coefficient * term, `{k}` being 2, 4, 6, ..."""
    return " + ".join(f"{coefficient!r}D * {term.format(k=2 * order)}"
                      for order, coefficient in enumerate(series(rows), start=1))


def _add(df: DataFrame, steps: list[dict[str, str]], keep: list[str]) -> DataFrame:
    """Add columns in steps, each one projection, so that shared terms are computed once."""
    columns = [f"`{c}`" for c in df.columns if c not in keep]
    for step in steps:
        df = df.withColumns({name: F.expr(text) for name, text in step.items()})
    return df.select(*columns, *keep)


def with_latlon(df: DataFrame, x: str = "x", y: str = "y", lat: str = "lat", lon: str = "lon",
                zone: int = 19, south: bool = True) -> DataFrame:
    """Add WGS84 latitude and longitude of UTM coordinates (default: zone 19 south)."""
    grid = SCALE_ON_MERIDIAN * _RECTIFYING_RADIUS
    return _add(df, [
        {"_xi": f"(`{y}` - {FALSE_NORTHING_SOUTH if south else 0.0}D) / {grid!r}D",
         "_eta": f"(`{x}` - {FALSE_EASTING}D) / {grid!r}D"},
        {"_xi0": f"_xi - ({_harmonics(GRID_TO_GEODETIC, 'sin({k} * _xi) * cosh({k} * _eta)')})",
         "_eta0": f"_eta - ({_harmonics(GRID_TO_GEODETIC, 'cos({k} * _xi) * sinh({k} * _eta)')})"},
        {"_chi": "asin(sin(_xi0) / cosh(_eta0))",
         lon: f"{central_meridian(zone)}D + degrees(atan2(sinh(_eta0), cos(_xi0)))"},
        {lat: f"degrees(_chi + {_harmonics(CONFORMAL_TO_LATITUDE, 'sin({k} * _chi)')})"},
    ], [lat, lon])


def with_grid(df: DataFrame, lat: str = "lat", lon: str = "lon", x: str = "x", y: str = "y",
              zone: int = 19, south: bool = True) -> DataFrame:
    """Add UTM coordinates of WGS84 latitude and longitude (inverse of `with_latlon`)."""
    grid = SCALE_ON_MERIDIAN * _RECTIFYING_RADIUS
    return _add(df, [
        {"_phi": f"radians(`{lat}`)", "_east": f"radians(`{lon}` - {central_meridian(zone)}D)"},
        {"_tau": f"sinh(atanh(sin(_phi))"
                 f" - {_ECCENTRICITY!r}D * atanh({_ECCENTRICITY!r}D * sin(_phi)))"},
        {"_xi": "atan2(_tau, cos(_east))",
         "_eta": "asinh(sin(_east) / sqrt(_tau * _tau + cos(_east) * cos(_east)))"},
        {x: f"{FALSE_EASTING}D + {grid!r}D * (_eta"
            f" + {_harmonics(GEODETIC_TO_GRID, 'cos({k} * _xi) * sinh({k} * _eta)')})",
         y: f"{FALSE_NORTHING_SOUTH if south else 0.0}D + {grid!r}D * (_xi"
            f" + {_harmonics(GEODETIC_TO_GRID, 'sin({k} * _xi) * cosh({k} * _eta)')})"},
    ], [x, y])


def great_circle(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Haversine distance in metres between two places given by column names."""
    return F.expr(f"""
        2 * {EARTH_RADIUS}D * asin(sqrt(least(1D,
          pow(sin(radians({lat2} - {lat1}) / 2), 2)
          + cos(radians({lat1})) * cos(radians({lat2}))
            * pow(sin(radians({lon2} - {lon1}) / 2), 2))))
    """)


def degrees_of_latitude(metres: float) -> float:
    return metres / (EARTH_RADIUS * radians(1.0))
