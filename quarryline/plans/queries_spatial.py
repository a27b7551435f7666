"""Coordinates, containment, grids, density and generalisation."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from quarryline.functions import geodesy
from quarryline.operators import spatial
from quarryline.operators.generalise import simplify_neighbours
from quarryline.plans.registry import query, table

EAST = "100000 + c_custkey * 7919 % 500000"
NORTH = "50000 + c_custkey * 104729 % 900000"


def grid_sql() -> str:
    """The published method with its latitude loops written out, as an independent check."""
    g = geodesy
    n = (g.AIRY_A - g.AIRY_B) / (g.AIRY_A + g.AIRY_B)
    e2, w2 = 1 - g.AIRY_B**2 / g.AIRY_A**2, 1 - g.WGS_B**2 / g.WGS_A**2
    af = g.AIRY_A * g.SCALE_F0
    arc = (
        f"{g.AIRY_B * g.SCALE_F0!r} * ({1 + n + 1.25 * n**2 + 1.25 * n**3!r} * (p - {g.ORIGIN_LAT!r})"
        f" - {3 * n + 3 * n**2 + 21 / 8 * n**3!r} * sin(p - {g.ORIGIN_LAT!r}) * cos(p + {g.ORIGIN_LAT!r})"
        f" + {15 / 8 * (n**2 + n**3)!r} * sin(2 * (p - {g.ORIGIN_LAT!r})) * cos(2 * (p + {g.ORIGIN_LAT!r}))"
        f" - {35 / 24 * n**3!r} * sin(3 * (p - {g.ORIGIN_LAT!r})) * cos(3 * (p + {g.ORIGIN_LAT!r})))"
    )
    (tx, ty, tz), (rx, ry, rz), s = g.SHIFT, g.ROTATION, 1 + g.SCALE_PPM
    steps = [
        f"l0 AS (SELECT c_custkey, CAST({EAST} AS DOUBLE) - {g.EASTING_0!r} AS d, CAST({NORTH} AS DOUBLE) - ({g.NORTHING_0!r}) AS nn,"
        f" (CAST({NORTH} AS DOUBLE) - ({g.NORTHING_0!r})) / {af!r} + {g.ORIGIN_LAT!r} AS p FROM customer)"
    ]
    steps += [f"l{i} AS (SELECT c_custkey, d, nn, p + (nn - {arc}) / {af!r} AS p FROM l{i - 1})" for i in range(1, 8)]
    steps.append(
        f"a AS (SELECT c_custkey, d, p, tan(p) AS t, 1 / cos(p) AS sec, {af!r} / sqrt(1 - {e2!r} * sin(p) * sin(p)) AS nu,"
        f" {af * (1 - e2)!r} / pow(1 - {e2!r} * sin(p) * sin(p), 1.5) AS rho FROM l7)"
    )
    steps.append("b AS (SELECT *, nu / rho - 1 AS h FROM a)")
    steps.append(
        "g AS (SELECT c_custkey, p - d*d * t / (2*rho*nu) + pow(d,4) * t / (24*rho*pow(nu,3)) * (5 + 3*t*t + h - 9*t*t*h)"
        " - pow(d,6) * t / (720*rho*pow(nu,5)) * (61 + 90*t*t + 45*pow(t,4)) AS lat,"
        f" {g.ORIGIN_LON!r} + d*sec/nu - pow(d,3)*sec/(6*pow(nu,3)) * (nu/rho + 2*t*t)"
        " + pow(d,5)*sec/(120*pow(nu,5)) * (5 + 28*t*t + 24*pow(t,4))"
        " - pow(d,7)*sec/(5040*pow(nu,7)) * (61 + 662*t*t + 1320*pow(t,4) + 720*pow(t,6)) AS lon FROM b)"
    )
    steps.append(f"v AS (SELECT *, {g.AIRY_A!r} / sqrt(1 - {e2!r} * sin(lat) * sin(lat)) AS nu FROM g)")
    steps.append(
        f"c AS (SELECT c_custkey, nu*cos(lat)*cos(lon) AS x, nu*cos(lat)*sin(lon) AS y, nu*{1 - e2!r}*sin(lat) AS z FROM v)"
    )
    steps.append(
        f"w AS (SELECT c_custkey, {tx!r} + {s!r}*x - {rz!r}*y + {ry!r}*z AS x, {ty!r} + {rz!r}*x + {s!r}*y - {rx!r}*z AS y,"
        f" {tz!r} - {ry!r}*x + {rx!r}*y + {s!r}*z AS z FROM c)"
    )
    steps.append(f"m0 AS (SELECT *, atan2(z, sqrt(x*x + y*y) * {1 - w2!r}) AS q FROM w)")
    turn = f"atan2(z + {w2 * g.WGS_A!r} * sin(q) / sqrt(1 - {w2!r} * sin(q) * sin(q)), sqrt(x*x + y*y))"
    steps += [f"m{i} AS (SELECT c_custkey, x, y, z, {turn} AS q FROM m{i - 1})" for i in range(1, 7)]
    return (
        "WITH " + ", ".join(steps) + " SELECT c_custkey, round(degrees(atan2(y, x)), 7) AS longitude,"
        " round(degrees(q), 7) AS latitude FROM m6"
    )


@query("geo_grid_to_lonlat", grid_sql())
def geo_grid_to_lonlat(spark, sf):
    customer = table(spark, sf, "customer", "c_custkey")
    placed = customer.select("c_custkey", F.expr(EAST).alias("e"), F.expr(NORTH).alias("n"))
    located = geodesy.with_lonlat(placed, "e", "n", "longitude", "latitude")
    return located.select("c_custkey", F.round("longitude", 7).alias("longitude"), F.round("latitude", 7).alias("latitude"))


# One hexagon per supplier on a lattice, every other one with a square hole; all
# coordinates are exact binary fractions, so points do fall on edges.
_HEXAGON = ((3, 0), (1.5, 2.5), (-1.5, 2.5), (-3, 0), (-1.5, -2.5), (1.5, -2.5), (3, 0))
_HOLE = ((0.5, 0.5), (0.5, -0.5), (-0.5, -0.5), (-0.5, 0.5), (0.5, 0.5))
_EDGES = [
    (hole, *a, *b)
    for hole, ring in ((0, _HEXAGON), (1, _HOLE))
    for a, b in zip(ring[:-1], ring[1:], strict=True)
]
_CX, _CY = "(s_suppkey % 64 + 0.5)", "(floor(s_suppkey / 64) + 0.5)"
_PX = "floor(c_custkey / 16) % 64 + (c_custkey * 5 % 16) / 16.0"
_PY = "floor(floor(c_custkey / 16) / 64) + ((c_custkey * 7 + c_nationkey * 3) % 32) / 32.0"
_POINTS = f"SELECT c_custkey, CAST({_PX} AS DOUBLE) AS x, CAST({_PY} AS DOUBLE) AS y FROM customer"


@query(
    "join_point_in_polygon",
    f"""WITH shape(hole, ax, ay, bx, by_) AS (VALUES {', '.join(str(e) for e in _EDGES)}),
        edges AS (SELECT s_suppkey, CAST({_CX} + ax / 8.0 AS DOUBLE) AS x1, CAST({_CY} + ay / 8.0 AS DOUBLE) AS y1,
            CAST({_CX} + bx / 8.0 AS DOUBLE) AS x2, CAST({_CY} + by_ / 8.0 AS DOUBLE) AS y2
            FROM supplier, shape WHERE hole = 0 OR s_suppkey % 2 = 0),
        tests AS (SELECT c_custkey, s_suppkey,
            count(*) FILTER ((y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / CASE WHEN y2 = y1 THEN 1 ELSE y2 - y1 END + x1) AS crossings,
            count(*) FILTER ((x2 - x1) * (y - y1) = (y2 - y1) * (x - x1) AND x BETWEEN least(x1, x2) AND greatest(x1, x2)
                AND y BETWEEN least(y1, y2) AND greatest(y1, y2)) AS touches
            FROM ({_POINTS}), edges GROUP BY 1, 2)
       SELECT c_custkey, s_suppkey FROM tests WHERE crossings % 2 = 1 AND touches = 0""",
)
def join_point_in_polygon(spark, sf):
    supplier = table(spark, sf, "supplier", "s_suppkey")
    shape = F.array(*[F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(("hole", "ax", "ay", "bx", "by"), e, strict=True)]) for e in _EDGES])
    edges = supplier.select("s_suppkey", F.explode(shape).alias("e")).filter("e.hole = 0 OR s_suppkey % 2 = 0").select(
        "s_suppkey",
        *[
            F.expr(f"CAST({base} + e.{part} / 8.0D AS DOUBLE)").alias(name)
            for base, part, name in ((_CX, "ax", "x1"), (_CY, "ay", "y1"), (_CX, "bx", "x2"), (_CY, "by", "y2"))
        ],
    )
    customer = table(spark, sf, "customer", "c_custkey", "c_nationkey")
    points = customer.select("c_custkey", F.expr(f"CAST({_PX} AS DOUBLE)").alias("x"), F.expr(f"CAST({_PY} AS DOUBLE)").alias("y"))
    inside = spatial.points_in_boundaries(points, "x", "y", edges, "s_suppkey", cell=0.5)
    return inside.select("c_custkey", "s_suppkey")


_PLACE = "label, CAST(embedding[{i}] AS DOUBLE) AS x, CAST(embedding[{j}] AS DOUBLE) AS y"
_PLACE_SQL = f"SELECT {_PLACE.format(i=1, j=2)} FROM embeddings"
_SIDE = 20


def _places(spark, sf):
    return table(spark, sf, "embeddings", "label", "embedding").selectExpr(*_PLACE.format(i=0, j=1).split(", "))


@query(
    "join_grid",
    f"""WITH e AS (SELECT label, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM ({_PLACE_SQL}) GROUP BY 1),
        r AS (SELECT unnest(range(0, {_SIDE})) AS k)
       SELECT label, CAST(i.k AS INTEGER) AS i, CAST(j.k AS INTEGER) AS j, round(x0 + j.k * ((x1 - x0) / {_SIDE - 1}), 9) AS x,
        round(y0 + i.k * ((y1 - y0) / {_SIDE - 1}), 9) AS y FROM e, r i, r j""",
)
def join_grid(spark, sf):
    extents = _places(spark, sf).groupBy("label").agg(
        *[f(c).alias(f"{n}_{c}") for c in ("x", "y") for n, f in (("min", F.min), ("max", F.max))]
    )
    cells = spatial.grid(extents, _SIDE)
    return cells.select("label", "i", "j", F.round("x", 9).alias("x"), F.round("y", 9).alias("y"))


@query(
    "agg_kde_grid",
    f"""WITH p AS ({_PLACE_SQL}),
        s AS (SELECT label, pow(count(*), -1.0 / 3) AS f, var_samp(x) AS vx, var_samp(y) AS vy, covar_samp(x, y) AS vxy,
            min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p GROUP BY 1),
        r AS (SELECT unnest(range(0, {_SIDE})) AS k),
        g AS (SELECT s.*, i.k AS i, j.k AS j, x0 + j.k * ((x1 - x0) / {_SIDE - 1}) AS gx, y0 + i.k * ((y1 - y0) / {_SIDE - 1}) AS gy
            FROM s, r i, r j),
        m AS (SELECT g.label, i, j, sum(exp(-0.5 * (vy * (gx - x) * (gx - x) - 2 * vxy * (gx - x) * (gy - y) + vx * (gy - y) * (gy - y))
            / (f * (vx * vy - vxy * vxy)))) AS mass FROM g JOIN p ON g.label = p.label GROUP BY 1, 2, 3)
       SELECT label, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(mass / max(mass) OVER (PARTITION BY label), 9) AS density FROM m""",
)
def agg_kde_grid(spark, sf):
    surface = spatial.kernel_density(_places(spark, sf), ["label"], "x", "y", _SIDE)
    return surface.select("label", "i", "j", F.round("density", 9).alias("density"))


_TOLERANCE = 0.1


def _gap(px: str, py: str, a: str, b: str) -> str:
    """SQL of a point's distance from the segment between the points aliased a and b."""
    dx, dy = f"({b}.x - {a}.x)", f"({b}.y - {a}.y)"
    t = f"greatest(0, least(1, (({px} - {a}.x) * {dx} + ({py} - {a}.y) * {dy}) / nullif({dx} * {dx} + {dy} * {dy}, 0)))"
    t = f"coalesce({t}, 0)"
    return f"sqrt(pow({px} - ({a}.x + {t} * {dx}), 2) + pow({py} - ({a}.y + {t} * {dy}), 2))"


@query(
    "geo_simplify",
    f"""WITH RECURSIVE p AS (SELECT vec_id, k, (1 + v) * cos((k % 64) * {2 * math.pi / 64!r}) AS x, (1 + v) * sin((k % 64) * {2 * math.pi / 64!r}) AS y
            FROM (SELECT vec_id, unnest(range(0, 65)) AS k, CAST(embedding[k % 64 + 1] AS DOUBLE) AS v FROM embeddings)),
        ring AS (SELECT vec_id, list(x ORDER BY k) AS xs, list(y ORDER BY k) AS ys FROM p GROUP BY 1),
        far AS (SELECT p.vec_id, arg_max(p.k, (sqrt(pow(p.x - o.x, 2) + pow(p.y - o.y, 2)), -p.k)) AS k FROM p JOIN p o ON p.vec_id = o.vec_id AND o.k = 0 GROUP BY 1),
        off AS (SELECT p.vec_id, arg_max(p.k, ({_gap('p.x', 'p.y', 'o', 'e')}, -p.k)) AS k FROM p JOIN far USING (vec_id)
            JOIN p o ON o.vec_id = p.vec_id AND o.k = 0 JOIN p e ON e.vec_id = p.vec_id AND e.k = far.k
            WHERE p.k NOT IN (0, 64) AND p.k <> far.k GROUP BY 1),
        fixed AS (SELECT vec_id, k FROM far UNION ALL SELECT vec_id, k FROM off UNION ALL SELECT vec_id, unnest([0, 64]) FROM far),
        seg(vec_id, a, b) AS (
            SELECT vec_id, k, lead(k) OVER (PARTITION BY vec_id ORDER BY k) FROM fixed
            UNION ALL
            SELECT vec_id, unnest([a, m]) AS a, unnest([m, b]) AS b FROM (
                SELECT vec_id, a, b, arg_max(k, ({_gap('x', 'y', 'u', 'w')}, -k)) AS m, max({_gap('x', 'y', 'u', 'w')}) AS d
                FROM (SELECT vec_id, a, b, u, w, k, xs[k + 1] AS x, ys[k + 1] AS y FROM (
                    SELECT s.vec_id, s.a, s.b, {{'x': xs[s.a + 1], 'y': ys[s.a + 1]}} AS u, {{'x': xs[s.b + 1], 'y': ys[s.b + 1]}} AS w,
                        xs, ys, unnest(range(s.a + 1, s.b)) AS k FROM seg s JOIN ring ON ring.vec_id = s.vec_id WHERE s.b - s.a > 1))
                GROUP BY 1, 2, 3) WHERE d > {_TOLERANCE}),
        kept AS (SELECT DISTINCT vec_id, a AS k FROM seg)
       SELECT vec_id, round(x, 9) + 0 AS x, round(y, 9) + 0 AS y FROM kept JOIN p USING (vec_id, k)""",
)
def geo_simplify(spark, sf):
    """Each vector as a closed ring: its numbers push the points of a circle in or out."""
    vectors = table(spark, sf, "embeddings", "vec_id", "embedding")
    turn = F.lit(2 * math.pi / 64)
    around = F.transform(
        F.col("embedding"),
        lambda v, k: F.array((1 + v.cast("double")) * F.cos(k * turn), (1 + v.cast("double")) * F.sin(k * turn)),
    )
    rings = vectors.select("vec_id", around.alias("open")).select(
        "vec_id", F.concat("open", F.slice("open", 1, 1)).alias("points")
    )
    kept = spatial.simplify_rings(rings, _TOLERANCE).select("vec_id", F.explode("points").alias("p"))
    x, y = (F.round(F.col("p")[i], 9) + F.lit(0.0) for i in (0, 1))
    return kept.select("vec_id", x.alias("x"), y.alias("y"))


# One cell of a lattice per vector; its lower and left borders swing with its numbers,
# least near the corners, so that reduced borders cannot meet.
_WIDE, _STEPS, _SWING = 32, 16, 0.03
_SWUNG = "CAST(CASE WHEN {k} IN (0, 16) THEN 0 ELSE 0.45 * least({k}, 16 - {k}) / 16 * {v} / (1 + abs({v})) END AS DOUBLE)"


@query(
    "geo_simplify_neighbours",
    f"""WITH RECURSIVE c AS (SELECT vec_id, vec_id % {_WIDE} AS cx, vec_id // {_WIDE} AS cy, embedding FROM embeddings),
        side AS (SELECT unnest([0, 1]) AS s),
        border AS (SELECT c.vec_id, s, cx, cy, embedding FROM c, side WHERE EXISTS (SELECT 1 FROM c o
            WHERE CASE s WHEN 0 THEN o.cx = c.cx AND o.cy = c.cy - 1 ELSE o.cx = c.cx - 1 AND o.cy = c.cy END)),
        b AS (SELECT vec_id, s, cx, cy, k, {_SWUNG.format(k='k', v='CAST(embedding[k + 1 + 17 * s] AS DOUBLE)')} AS w
            FROM (SELECT *, unnest(range(0, {_STEPS + 1})) AS k FROM border)),
        p AS (SELECT vec_id, s, k, CASE s WHEN 0 THEN cx + k / {_STEPS}.0::DOUBLE ELSE cx + w END AS x,
            CASE s WHEN 0 THEN cy + w ELSE cy + k / {_STEPS}.0::DOUBLE END AS y FROM b),
        line AS (SELECT vec_id, s, list(x ORDER BY k) AS xs, list(y ORDER BY k) AS ys FROM p GROUP BY 1, 2),
        seg(vec_id, s, a, b) AS (
            SELECT vec_id, s, 0::BIGINT, {_STEPS}::BIGINT FROM line
            UNION ALL
            SELECT vec_id, s, unnest([a, m]) AS a, unnest([m, b]) AS b FROM (
                SELECT vec_id, s, a, b, arg_max(k, ({_gap('x', 'y', 'u', 'w')}, -k)) AS m, max({_gap('x', 'y', 'u', 'w')}) AS d
                FROM (SELECT vec_id, s, a, b, u, w, k, xs[k + 1] AS x, ys[k + 1] AS y FROM (
                    SELECT g.vec_id, g.s, g.a, g.b, {{'x': xs[g.a + 1], 'y': ys[g.a + 1]}} AS u, {{'x': xs[g.b + 1], 'y': ys[g.b + 1]}} AS w,
                        xs, ys, unnest(range(g.a + 1, g.b)) AS k FROM seg g JOIN line USING (vec_id, s) WHERE g.b - g.a > 1))
                GROUP BY 1, 2, 3, 4) WHERE d > {_SWING})
       SELECT round(x, 9) + 0 AS x, round(y, 9) + 0 AS y, 2::BIGINT AS n_rings FROM (SELECT DISTINCT vec_id, s, a AS k FROM seg WHERE a > 0) JOIN p USING (vec_id, s, k)""",
)
def geo_simplify_neighbours(spark, sf):
    """Points, between the corners, that two reduced neighbours have in common."""
    cells = table(spark, sf, "embeddings", "vec_id", "embedding")
    cells = cells.selectExpr("vec_id", f"vec_id % {_WIDE} AS cx", f"vec_id DIV {_WIDE} AS cy", "embedding")

    def border(held, at_x, at_y, s):
        """Points of a side of a cell, straight where no cell holds its numbers."""
        w = _SWUNG.format(k="k", v=f"CAST({held}[k + {17 * s}] AS DOUBLE)")
        along, across = f"{('cx', 'cy')[s]} + k / {_STEPS}.0D", f"coalesce({w}, 0D)"
        x, y = ((f"{along} + {at_x}", f"cy + {at_y} + {across}"), (f"cx + {at_x} + {across}", f"{along} + {at_y}"))[s]
        return F.expr(f"transform(sequence(0, {_STEPS}), k -> array(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)))")

    above = cells.selectExpr("cx", "cy - 1 AS cy", "embedding AS above")
    beside = cells.selectExpr("cx - 1 AS cx", "cy", "embedding AS beside")
    whole = cells.join(above, ["cx", "cy"], "left").join(beside, ["cx", "cy"], "left")
    sides = [border("embedding", 0, 0, 0), border("beside", 1, 0, 1), F.reverse(border("above", 0, 1, 0)), F.reverse(border("embedding", 0, 0, 1))]
    rings = whole.select("vec_id", F.concat(sides[0], *[F.slice(s, 2, _STEPS) for s in sides[1:]]).alias("points"))
    kept = simplify_neighbours(rings, ["vec_id"], _SWING)
    open_ring = F.explode(F.slice("points", F.lit(1), F.size("points") - 1)).alias("p")
    x, y = (F.round(F.col("p")[i], 9) + F.lit(0.0) for i in (0, 1))
    counted = kept.select(open_ring).select(x.alias("x"), y.alias("y")).groupBy("x", "y").agg(F.count(F.lit(1)).alias("n_rings"))
    return counted.filter("n_rings > 1 AND NOT (x = round(x) AND y = round(y))")


@query(
    "geo_edges_length",
    f"""WITH shape(hole, ax, ay, bx, by_) AS (VALUES {', '.join(str(e) for e in _EDGES)})
       SELECT s_suppkey, count(*) AS n_edges, round(sum(sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay))), 6) AS length
       FROM supplier, shape WHERE hole = 0 OR s_suppkey % 2 = 0 GROUP BY 1""",
)
def geo_edges_length(spark, sf):
    """Edges per boundary and their length, from rings with and without a hole."""
    supplier = table(spark, sf, "supplier", "s_suppkey")

    def ring(corners):
        return F.array(*[F.array(F.col("s_suppkey") + F.lit(float(x)), F.lit(float(y))) for x, y in corners])

    shapes = F.when(F.col("s_suppkey") % 2 == 0, F.array(ring(_HEXAGON), ring(_HOLE))).otherwise(F.array(ring(_HEXAGON)))
    features = supplier.select(
        "s_suppkey", F.struct(F.lit("Polygon").alias("type"), F.to_json(shapes).alias("coordinates")).alias("geometry")
    )
    edges = spatial.ring_edges(spatial.rings(features, ["s_suppkey"]), ["s_suppkey"])
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    return edges.groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("n_edges"), F.round(F.sum(length), 6).alias("length"))
