"""National-grid coordinates to WGS84 longitude and latitude.

The published Ordnance Survey method: inverse transverse Mercator on the Airy
1830 ellipsoid, then a Helmert shift to WGS84 (accurate to a few metres).

The grid latitude starts from a footpoint series, so two of the published
correction steps reach its fixed point; the shifted latitude is Bowring's closed
form.  Each stage reads the previous one many times, so the transform is a chain
of projections: as a single nested expression it would grow geometrically.
Every stage stays inside generated code.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# Airy 1830 and the national grid projection.
AIRY_A, AIRY_B = 6377563.396, 6356256.909
SCALE_F0 = 0.9996012717
ORIGIN_LAT, ORIGIN_LON = math.radians(49.0), math.radians(-2.0)
EASTING_0, NORTHING_0 = 400000.0, -100000.0
# WGS84 and the Helmert shift (metres, arc-seconds, ppm).
WGS_A, WGS_B = 6378137.0, 6356752.314245
SHIFT = (446.448, -125.157, 542.060)
ROTATION = tuple(math.radians(s / 3600) for s in (0.1502, 0.2470, 0.8421))
SCALE_PPM = -20.4894e-6

_N = (AIRY_A - AIRY_B) / (AIRY_A + AIRY_B)
_E2 = 1 - AIRY_B**2 / AIRY_A**2
_W2 = 1 - WGS_B**2 / WGS_A**2


CORRECTIONS = 2


def _arc(p: Column) -> Column:
    """Scaled meridian arc from the grid's origin latitude on Airy 1830."""
    n, d, s = _N, p - ORIGIN_LAT, p + ORIGIN_LAT
    return AIRY_B * SCALE_F0 * (
        (1 + n + 1.25 * n**2 + 1.25 * n**3) * d
        - (3 * n + 3 * n**2 + 21 / 8 * n**3) * F.sin(d) * F.cos(s)
        + 15 / 8 * (n**2 + n**3) * F.sin(2 * d) * F.cos(2 * s)
        - 35 / 24 * n**3 * F.sin(3 * d) * F.cos(3 * s)
    )


def _arc_to_origin() -> float:
    """Meridian arc from the equator to the origin latitude, unscaled."""
    n, lat = _N, ORIGIN_LAT
    return AIRY_B * (
        (1 + n + 1.25 * n**2 + 1.25 * n**3) * lat
        - (3 * n + 3 * n**2 + 21 / 8 * n**3) * math.sin(lat) * math.cos(lat)
        + 15 / 8 * (n**2 + n**3) * math.sin(2 * lat) * math.cos(2 * lat)
        - 35 / 24 * n**3 * math.sin(3 * lat) * math.cos(3 * lat)
    )


def _airy_stages(easting: Column, northing: Column) -> list[dict[str, Column]]:
    """Stages ending in ``_lam`` and ``_phi``, radians on the Airy ellipsoid."""
    n = _N
    arc_scale = AIRY_B * (1 + n + 1.25 * n**2 + 1.25 * n**3)
    mu, foot = F.col("_mu"), F.col("_foot")
    nu, rho, t, d = F.col("_nu"), F.col("_rho"), F.col("_t"), F.col("_d")
    t2, eta2, d2 = F.col("_t2"), F.col("_nu") / F.col("_rho") - 1, F.col("_d") * F.col("_d")
    q = d / nu
    q2 = F.col("_q2")
    series = t / (2 * rho) * nu * q2 * (
        1
        - q2 / 12 * (5 + 3 * t2 + eta2 - 9 * t2 * eta2)
        + q2 * q2 / 360 * (61 + 90 * t2 + 45 * t2 * t2)
    )
    across = q / F.cos(foot) * (
        1
        - q2 / 6 * (nu / rho + 2 * t2)
        + q2 * q2 / 120 * (5 + 28 * t2 + 24 * t2 * t2)
        - q2 * q2 * q2 / 5040 * (61 + 662 * t2 + 1320 * t2 * t2 + 720 * t2 * t2 * t2)
    )
    return [
        {
            "_north": northing.cast("double") - NORTHING_0,
            "_mu": ((northing.cast("double") - NORTHING_0) / SCALE_F0 + _arc_to_origin()) / arc_scale,
            "_d": easting.cast("double") - EASTING_0,
        },
        {
            "_foot": mu
            + (3 * n / 2 - 27 * n**3 / 32) * F.sin(2 * mu)
            + (21 * n**2 / 16 - 55 * n**4 / 32) * F.sin(4 * mu)
            + (151 * n**3 / 96) * F.sin(6 * mu)
            + (1097 * n**4 / 512) * F.sin(8 * mu)
        },
        *[{"_foot": foot + (F.col("_north") - _arc(foot)) / (AIRY_A * SCALE_F0)}] * CORRECTIONS,
        {"_w": 1 - _E2 * F.sin(foot) * F.sin(foot), "_t": F.tan(foot)},
        {
            "_nu": AIRY_A * SCALE_F0 / F.sqrt("_w"),
            "_rho": AIRY_A * SCALE_F0 * (1 - _E2) / (F.col("_w") * F.sqrt("_w")),
            "_t2": t * t,
        },
        {"_q2": d2 / (nu * nu)},
        {"_phi": foot - series, "_lam": ORIGIN_LON + across},
    ]


def _wgs_stages() -> list[dict[str, Column]]:
    """Stages from ``_lam`` and ``_phi`` to the cartesian WGS84 point and latitude terms."""
    phi, lam, nu = F.col("_phi"), F.col("_lam"), F.col("_nu1")
    x, y, z = F.col("_x"), F.col("_y"), F.col("_z")
    (tx, ty, tz), (rx, ry, rz), s = SHIFT, ROTATION, 1 + SCALE_PPM
    theta, p = F.col("_theta"), F.col("_p")
    second = (WGS_A**2 - WGS_B**2) / WGS_B**2
    return [
        {"_nu1": AIRY_A / F.sqrt(1 - _E2 * F.sin(phi) * F.sin(phi))},
        {
            "_x": nu * F.cos(phi) * F.cos(lam),
            "_y": nu * F.cos(phi) * F.sin(lam),
            "_z": nu * (1 - _E2) * F.sin(phi),
        },
        {
            "_x2": tx + s * x - rz * y + ry * z,
            "_y2": ty + rz * x + s * y - rx * z,
            "_z2": tz - ry * x + rx * y + s * z,
        },
        {"_p": F.sqrt(F.col("_x2") * F.col("_x2") + F.col("_y2") * F.col("_y2"))},
        {"_theta": F.atan2(F.col("_z2") * WGS_A, p * WGS_B)},
        {"_sin": F.sin(theta), "_cos": F.cos(theta)},
        {
            "_lat": F.atan2(
                F.col("_z2") + second * WGS_B * F.col("_sin") * F.col("_sin") * F.col("_sin"),
                p - _W2 * WGS_A * F.col("_cos") * F.col("_cos") * F.col("_cos"),
            )
        },
    ]


def _run(df: DataFrame, stages: list[dict[str, Column]]) -> DataFrame:
    for stage in stages:
        df = df.withColumns(stage)
    return df


def with_airy(df: DataFrame, easting: str, northing: str) -> DataFrame:
    """Adds ``airy_longitude`` and ``airy_latitude`` (degrees, before the datum shift)."""
    keep = [F.col(c) for c in df.columns]
    staged = _run(df, _airy_stages(F.col(easting), F.col(northing)))
    return staged.select(
        *keep, F.degrees("_lam").alias("airy_longitude"), F.degrees("_phi").alias("airy_latitude")
    )


def with_lonlat(
    df: DataFrame,
    easting: str,
    northing: str,
    longitude: str = "Longitude",
    latitude: str = "Latitude",
) -> DataFrame:
    """Adds WGS84 degrees; null where either grid coordinate is null."""
    keep = [F.col(c) for c in df.columns]
    staged = _run(df, _airy_stages(F.col(easting), F.col(northing)) + _wgs_stages())
    return staged.select(
        *keep,
        F.degrees(F.atan2("_y2", "_x2")).alias(longitude),
        F.degrees("_lat").alias(latitude),
    )
