"""The British National Grid, in column expressions: WGS84 degrees to metres east and north.

A seven-parameter Helmert shift to the Airy ellipsoid, then the transverse Mercator series, as the Ordnance Survey's public
guide to coordinate systems gives them. The steps are SQL text, so that any SQL engine computes the same values.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: ellipsoids (semi-axes in metres), Helmert shift (metres, seconds of arc, parts per million), projection
WGS84 = (6378137.0, 6356752.314245)
AIRY = (6377563.396, 6356256.909)
SHIFT = (-446.448, 125.157, -542.060)
ROTATION = (-0.1502, -0.2470, -0.8421)
SCALE_PPM = 20.4894
CENTRAL_SCALE, ORIGIN_LAT, ORIGIN_LON, FALSE_EAST, FALSE_NORTH = 0.9996012717, 49.0, -2.0, 400000.0, -100000.0


def _n(x: float) -> str:
    return f"({x!r}e0)" if "e" not in repr(x) else f"({x!r})"


def steps(lat: str, lon: str) -> list[dict[str, str]]:
    """Columns to add, step by step; each step uses those before it. The last one gives x and y."""
    a, b = WGS84
    e2 = (a * a - b * b) / (a * a)
    rx, ry, rz = (math.radians(r / 3600) for r in ROTATION)
    s = 1 + SCALE_PPM * 1e-6
    a2, b2 = AIRY
    f2, g2 = (a2 * a2 - b2 * b2) / (a2 * a2), (a2 * a2 - b2 * b2) / (b2 * b2)
    n = (a2 - b2) / (a2 + b2)
    p0, l0 = math.radians(ORIGIN_LAT), math.radians(ORIGIN_LON)
    m = [1 + n + 5 / 4 * n**2 + 5 / 4 * n**3, 3 * n + 3 * n**2 + 21 / 8 * n**3, 15 / 8 * n**2 + 15 / 8 * n**3, 35 / 24 * n**3]
    return [
        {"g_p": f"radians({lat})", "g_l": f"radians({lon})"},
        {"g_v": f"{_n(a)} / sqrt(1e0 - {_n(e2)} * sin(g_p) * sin(g_p))"},
        {"g_x": "g_v * cos(g_p) * cos(g_l)", "g_y": "g_v * cos(g_p) * sin(g_l)", "g_z": f"{_n(1 - e2)} * g_v * sin(g_p)"},
        {
            "h_x": f"{_n(SHIFT[0])} + {_n(s)} * g_x - {_n(rz)} * g_y + {_n(ry)} * g_z",
            "h_y": f"{_n(SHIFT[1])} + {_n(rz)} * g_x + {_n(s)} * g_y - {_n(rx)} * g_z",
            "h_z": f"{_n(SHIFT[2])} - {_n(ry)} * g_x + {_n(rx)} * g_y + {_n(s)} * g_z",
        },
        {"h_r": "sqrt(h_x * h_x + h_y * h_y)"},
        {"h_t": f"atan2(h_z * {_n(a2)}, h_r * {_n(b2)})"},
        {"t_p": f"atan2(h_z + {_n(g2 * b2)} * sin(h_t) * sin(h_t) * sin(h_t), h_r - {_n(f2 * a2)} * cos(h_t) * cos(h_t) * cos(h_t))", "t_d": f"atan2(h_y, h_x) - {_n(l0)}"},
        {"t_s": "sin(t_p)", "t_c": "cos(t_p)", "t_t": "tan(t_p) * tan(t_p)", "t_q": f"1e0 - {_n(f2)} * sin(t_p) * sin(t_p)"},
        {"t_v": f"{_n(a2 * CENTRAL_SCALE)} / sqrt(t_q)", "t_r": f"{_n(a2 * CENTRAL_SCALE * (1 - f2))} / (t_q * sqrt(t_q))"},
        {
            "t_m": f"{_n(b2 * CENTRAL_SCALE)} * ({_n(m[0])} * (t_p - {_n(p0)}) - {_n(m[1])} * sin(t_p - {_n(p0)}) * cos(t_p + {_n(p0)}) + {_n(m[2])} * sin(2e0 * (t_p - {_n(p0)})) * cos(2e0 * (t_p + {_n(p0)})) - {_n(m[3])} * sin(3e0 * (t_p - {_n(p0)})) * cos(3e0 * (t_p + {_n(p0)})))",
            "t_e": "t_v / t_r - 1e0",
            "t_d2": "t_d * t_d",
            "t_c3": "t_c * t_c * t_c",
        },
        {
            "x": f"{_n(FALSE_EAST)} + t_d * (t_v * t_c + t_d2 * (t_v / 6e0 * t_c3 * (t_v / t_r - t_t) + t_d2 * t_v / 120e0 * t_c3 * t_c * t_c * (5e0 - 18e0 * t_t + t_t * t_t + 14e0 * t_e - 58e0 * t_t * t_e)))",
            "y": f"{_n(FALSE_NORTH)} + t_m + t_d2 * (t_v / 2e0 * t_s * t_c + t_d2 * (t_v / 24e0 * t_s * t_c3 * (5e0 - t_t + 9e0 * t_e) + t_d2 * t_v / 720e0 * t_s * t_c3 * t_c * t_c * (61e0 - 58e0 * t_t + t_t * t_t)))",
        },
    ]


def to_grid(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """df with x (metres east) and y (metres north). Null coordinates give nulls."""
    kept = [c for c in df.columns if c not in ("x", "y")]
    out = df.select(*kept)
    for step in steps(lat, lon):
        out = out.selectExpr("*", *[f"{sql} AS {name}" for name, sql in step.items()])
    # a generator of one row: the optimizer does not push conditions on x and y through it, which would repeat all the steps in them
    return out.select(*kept, F.explode(F.array(F.struct("x", "y"))).alias("_at")).select(*kept, "_at.x", "_at.y")


def grid_sql(source: str, lat: str = "latitude", lon: str = "longitude") -> str:
    """The same as a SELECT over the relation `source`."""
    for step in steps(lat, lon):
        source = f"(SELECT *, {', '.join(f'{sql} AS {name}' for name, sql in step.items())} FROM {source}) AS g"
    names = [n for step in steps(lat, lon)[:-1] for n in step]
    return f"SELECT * EXCLUDE ({', '.join(names)}) FROM {source}"
