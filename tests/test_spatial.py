"""Containment, density, coordinates and generalisation against direct computation."""

import math
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryline.functions import geodesy
from quarryline.operators import generalise, spatial


def _inside(x, y, edges):
    odd = False
    for x1, y1, x2, y2 in edges:
        if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return False
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def _star(rng, cx, cy, size, n):
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    points = [(cx + size * rng.uniform(0.3, 1) * math.cos(a), cy + size * rng.uniform(0.3, 1) * math.sin(a)) for a in angles]
    return [(*a, *b) for a, b in zip(points, points[1:] + points[:1], strict=True)]


@pytest.mark.parametrize("cell", [0.07, 0.3, 1.0, 50.0])
def test_points_in_random_shapes(spark, cell):
    rng = random.Random(5)
    shapes = {i: _star(rng, rng.uniform(-5, 5), rng.uniform(-5, 5), rng.uniform(0.5, 4), 12) for i in range(12)}
    # Coordinates on a coarse grid put points exactly on edges and vertices.
    shapes[100] = [(0, 0, 4, 0), (4, 0, 4, 4), (4, 4, 0, 4), (0, 4, 0, 0), (1, 1, 3, 1), (3, 1, 3, 3), (3, 3, 1, 3), (1, 3, 1, 1)]
    shapes[101] = [(-4, -4, 0, 0), (0, 0, -4, 4), (-4, 4, -8, 0), (-8, 0, -4, -4)]
    points = [(i, rng.uniform(-7, 7), rng.uniform(-7, 7)) for i in range(300)]
    points += [(1000 + 21 * a + b, a / 2 - 4, b / 2 - 4) for a in range(21) for b in range(21)]
    edges = spark.createDataFrame([(k, *map(float, e)) for k, es in shapes.items() for e in es], "b int, x1 double, y1 double, x2 double, y2 double")
    frame = spark.createDataFrame([(i, float(x), float(y)) for i, x, y in points], "p int, x double, y double")
    got = {(r["p"], r["b"]) for r in spatial.points_in_boundaries(frame, "x", "y", edges, "b", cell).collect()}
    want = {(i, k) for i, x, y in points for k, es in shapes.items() if _inside(x, y, es)}
    assert got == want and want


def test_points_in_jagged_shapes(spark):
    rng = random.Random(9)
    shapes = {i: _star(rng, rng.uniform(-2, 2), rng.uniform(-2, 2), 3, 400) for i in range(4)}
    # Ends that differ from a border of cells by rounding only, and nearly level edges.
    shapes[11] = [(0.1, 0.3, 2.1, 0.3 + 1e-12), (2.1, 0.3 + 1e-12, 2.1, 1.2), (2.1, 1.2, 0.1, 0.1 * 3 * 4), (0.1, 0.1 * 3 * 4, 0.1, 0.3)]
    points = [(i, rng.uniform(-5, 5), rng.uniform(-5, 5)) for i in range(2000)] + [(5000 + i, 0.1 * i, 0.3) for i in range(30)]
    points += [(6000 + k, x, y) for k, (x, y, _, _) in enumerate(shapes[0])]
    edges = spark.createDataFrame([(k, *map(float, e)) for k, es in shapes.items() for e in es], "b int, x1 double, y1 double, x2 double, y2 double")
    frame = spark.createDataFrame([(i, float(x), float(y)) for i, x, y in points], "p int, x double, y double")
    got = {(r["p"], r["b"]) for r in spatial.points_in_boundaries(frame, "x", "y", edges, "b", 0.1).collect()}
    assert got == {(i, k) for i, x, y in points for k, es in shapes.items() if _inside(x, y, es)}


@pytest.mark.parametrize("width", [10, 20, 40])
def test_edges_are_copied_only_into_cells_they_touch(spark, width):
    """Two jagged sides of 200 short edges each, joined by two long edges."""
    sides = [[(x + 0.3 * (k % 2), k / 50) for k in range(201)] for x in (0.2, width + 0.2)]
    ring = sides[0] + sides[1][::-1] + sides[0][:1]
    rows = [("b", *map(float, a), *map(float, b)) for a, b in zip(ring, ring[1:])]
    edges = spark.createDataFrame(rows, "b string, x1 double, y1 double, x2 double, y2 double")
    index = spatial.edge_cells(edges, "b", 1.0).collect()
    assert sum(len(r["_edges"]) for r in index) <= 420 + 2 * (width + 3)
    assert sum(len(r["_levels"]) for r in index) <= 5 * (width + 3) + 420
    assert {len(r["_edges"]) for r in index if r["_row"] == 2 and 2 <= r["_col"] <= width - 2} == {0}


def test_geojson_rings_to_edges(spark):
    rows = [
        ("P", "Polygon", "[[[0,0],[1,0],[1,1],[0,0]],[[0.2,0.1],[0.3,0.1],[0.3,0.2],[0.2,0.1]]]"),
        ("M", "MultiPolygon", "[[[[0,0],[2,0],[2,2],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]"),
        ("X", "Point", "[1,2]"),
    ]
    df = spark.createDataFrame(rows, "id string, type string, coordinates string")
    features = df.select("id", F.struct("type", "coordinates").alias("geometry"))
    edges = spatial.ring_edges(spatial.rings(features, ["id"]), ["id"]).collect()
    shape = {(r["id"], r["part"], r["ring"], r["seq"]): (r["x1"], r["y1"], r["x2"], r["y2"]) for r in edges}
    assert len(shape) == 12
    assert shape["P", 0, 1, 0] == (0.2, 0.1, 0.3, 0.1) and shape["M", 1, 0, 2] == (6, 6, 5, 5)


@pytest.mark.parametrize(("memory", "side"), [(32, 15), (1, 7)])
def test_density_matches_direct_sum(spark, monkeypatch, memory, side):
    monkeypatch.setattr(spatial, "SURFACES_IN_MEMORY", memory)
    rng = np.random.default_rng(3)
    groups = {"a": rng.multivariate_normal([0, 50], [[1, 0.6], [0.6, 2]], 400), "b": rng.normal(size=(90, 2)) * [1e-3, 40]}
    groups["a"][:50] = groups["a"][0]
    rows = [(k, float(x), float(y)) for k, p in groups.items() for x, y in p]
    rows += [("flat", 1.0, 1.0), ("flat", 2.0, 2.0), ("flat", 3.0, 3.0), ("a", None, 1.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double").repartition(5)
    got = {(r["k"], r["i"], r["j"]): r["density"] for r in spatial.kernel_density(df, ["k"], "x", "y", side).collect()}
    for k, p in groups.items():
        n = len(p)
        inverse = np.linalg.inv(np.cov(p.T) * n ** (-1 / 3))
        gx, gy = (np.linspace(p[:, d].min(), p[:, d].max(), side) for d in (0, 1))
        grid = np.array([[x, y] for y in gy for x in gx])
        delta = grid[:, None, :] - p[None, :, :]
        mass = np.exp(-0.5 * np.einsum("gpi,ij,gpj->gp", delta, inverse, delta)).sum(axis=1)
        want = (mass / mass.max()).reshape(side, side)
        mine = np.array([[got[k, i, j] for j in range(side)] for i in range(side)])
        assert np.allclose(mine, want, rtol=1e-9, atol=1e-12)
    assert all(got["flat", i, j] is None for i in range(side) for j in range(side))


def test_gauss_sums_keep_their_bound():
    """Points far apart and close together, boxes dropped on the way; work not by point."""
    rng = np.random.default_rng(8)
    for a, b, c, n in ((40.0, -25.0, 30.0, 40), (0.01, 0.004, 0.02, 9), (900.0, 0.0, 4.0, 25), (1.0, 0.5, 1.0, 1)):
        x, y, w = rng.uniform(-3, 5, 3000), rng.normal(size=3000), rng.integers(1, 9, 3000).astype(float)
        x[:900], y[:900] = 1.25, 0.5
        surface = spatial.GaussSurface(n, x.min(), x.max(), y.min(), y.max(), a, b, c)
        for part in np.array_split(np.arange(3000), 7):
            surface.add(x[part], y[part], w[part])
        gx, gy = np.linspace(x.min(), x.max(), n), np.linspace(y.min(), y.max(), n)
        dx, dy = gx[None, :, None] - x, gy[:, None, None] - y
        direct = (w * np.exp(-(a * dx * dx + 2 * b * dx * dy + c * dy * dy))).sum(axis=2)
        assert np.abs(surface.done() - direct).max() < 5e-14 * w.sum()


def test_gauss_sums_by_the_box(monkeypatch):
    """A million points in few boxes cost no more series than a thousand do."""
    evaluated = []
    hermite = spatial._hermite
    monkeypatch.setattr(spatial, "_hermite", lambda x: evaluated.append(x.size) or hermite(x))
    rng, totals = np.random.default_rng(9), []
    for size in (1_000, 200_000):
        evaluated.clear()
        x, y = rng.uniform(0, 4, size), rng.uniform(0, 4, size)
        surface = spatial.GaussSurface(50, 0, 4, 0, 4, 1.0, 0.0, 1.0)
        surface.add(x, y, np.ones(size))
        assert len(surface.boxes) == 16
        surface.done()
        totals.append(sum(evaluated))
    assert totals[0] == totals[1]


def test_grid_has_both_ends(spark):
    df = spark.createDataFrame([(0.0, 1.0, 10.0, 30.0)], "min_x double, max_x double, min_y double, max_y double")
    cells = {(r["i"], r["j"]): (r["x"], r["y"]) for r in spatial.grid(df, 5).collect()}
    assert len(cells) == 25 and cells[0, 0] == (0.0, 10.0) and cells[4, 4] == (1.0, 30.0) and cells[1, 2] == (0.5, 15.0)


def test_published_coordinate_example(spark):
    df = spark.createDataFrame([(651409.903, 313177.270), (None, 1.0)], "e double, n double")
    airy = geodesy.with_airy(df, "e", "n").collect()
    assert abs(airy[0]["airy_latitude"] - (52 + 39 / 60 + 27.2531 / 3600)) < 2e-8
    assert abs(airy[0]["airy_longitude"] - (1 + 43 / 60 + 4.5177 / 3600)) < 2e-8
    assert airy[1]["airy_latitude"] is None
    wgs = geodesy.with_lonlat(df, "e", "n").first()
    # Within a few metres of the surveyed position, as the method promises.
    assert abs(wgs["Longitude"] - 1.716073973) < 5e-5 and abs(wgs["Latitude"] - 52.658007833) < 5e-5


def _reduce(points, first, last, tolerance, keep):
    """Textbook recursion over vertex positions."""
    if last - first < 2:
        return
    a, b = np.array(points[first]), np.array(points[last])
    along = b - a
    best, at = -1.0, None
    for i in range(first + 1, last):
        p = np.array(points[i])
        t = 0.0 if not along.any() else min(1.0, max(0.0, float((p - a) @ along / (along @ along))))
        d = float(np.hypot(*(p - (a + t * along))))
        if d > best:
            best, at = d, i
    if best > tolerance:
        keep.add(at)
        _reduce(points, first, at, tolerance, keep)
        _reduce(points, at, last, tolerance, keep)


def test_simplify_matches_recursion(spark):
    rng = random.Random(8)
    shapes = []
    for n in (3, 4, 30, 200):
        angles = [2 * math.pi * i / n for i in range(n)]
        ring = [[(1 + rng.uniform(-0.1, 0.1)) * math.cos(a), (1 + rng.uniform(-0.1, 0.1)) * math.sin(a)] for a in angles]
        shapes.append((n, ring + ring[:1]))
    df = spark.createDataFrame([*shapes, (0, None)], "n int, points array<array<double>>")
    got = {r["n"]: r["points"] for r in spatial.simplify_rings(df, 0.05).collect()}
    assert got.pop(0) is None
    for n, ring in shapes:
        if len(ring) <= 4:
            assert got[n] == ring
            continue
        far = max(range(len(ring)), key=lambda i: math.dist(ring[i], ring[0]))
        line = np.array(ring[far]) - ring[0]
        off = [abs(float(line[0] * (p[1] - ring[0][1]) - line[1] * (p[0] - ring[0][0]))) if i not in (0, far, len(ring) - 1) else -1 for i, p in enumerate(ring)]
        kept = {0, far, len(ring) - 1, int(np.argmax(off))}
        fixed = sorted(kept)
        for a, b in zip(fixed[:-1], fixed[1:], strict=True):
            _reduce(ring, a, b, 0.05, kept)
        assert got[n] == [ring[i] for i in sorted(kept)]
        assert len(got[n]) >= 4 and got[n][0] == got[n][-1]


def test_simplify_drops_points_within_tolerance(spark):
    ring = [[0, 0], [1, 0.0001], [2, 0], [2, 1], [2, 2], [1, 2], [0, 2], [0, 1], [0, 0]]
    df = spark.createDataFrame([([[float(a), float(b)] for a, b in ring],)], "points array<array<double>>")
    assert spatial.simplify_rings(df, 0.001).first()[0] == [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]


# ---- boundaries with neighbours -------------------------------------------------


def _lattice(rng, side, steps, wild):
    """Cells of a lattice whose borders wander; each border is made once and used by both cells."""
    def border(a, b):
        line = [a]
        for k in range(1, steps):
            t, w = k / steps, wild * min(k, steps - k) / steps
            line.append((a[0] + (b[0] - a[0]) * t + rng.uniform(-w, w), a[1] + (b[1] - a[1]) * t + rng.uniform(-w, w)))
        return [*line, b]

    low = {(c, r): border((c, r), (c + 1, r)) for c in range(side) for r in range(side + 1)}
    left = {(c, r): border((c, r), (c, r + 1)) for c in range(side + 1) for r in range(side)}
    cells = {}
    for c in range(side):
        for r in range(side):
            ring = low[c, r][:-1] + left[c + 1, r][:-1] + low[c, r + 1][::-1][:-1] + left[c, r][::-1]
            turn = rng.randrange(len(ring) - 1)
            ring = ring[turn:-1] + ring[: turn + 1]
            cells[c * side + r] = ring[::-1] if rng.random() < 0.5 else ring
    return cells


def _sides(rings):
    return Counter(tuple(sorted((tuple(a), tuple(b)))) for ring in rings for a, b in zip(ring[:-1], ring[1:], strict=True))


def _cross(s, t):
    def turn(a, b, p):
        return np.sign((b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]))

    (a, b), (c, d) = s, t
    return turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0


def _generalised(spark, cells, tolerance):
    rows = [(k, [[float(x), float(y)] for x, y in ring]) for k, ring in cells.items()]
    df = spark.createDataFrame(rows, "k int, points array<array<double>>")
    return {r["k"]: [tuple(p) for p in r["points"]] for r in generalise.simplify_neighbours(df, ["k"], tolerance).collect()}


def test_neighbours_stay_joined(spark):
    cells = _lattice(random.Random(3), 5, 24, 0.05)
    got = _generalised(spark, cells, 0.08)
    before, after = _sides(cells.values()), _sides(got.values())
    assert len(after) < len(before) / 4
    assert Counter(after.values())[1] < 60 and max(after.values()) == 2
    rim = lambda p: min(p) < 0.06 or max(p) > 4.94
    assert all(rim(a) and rim(b) for (a, b), n in after.items() if n == 1)  # no gap inside
    corners = {(c, r) for c in range(5) for r in range(5) if c and r}
    assert corners <= {p for ring in got.values() for p in ring}
    plain = spark.createDataFrame([(k, [list(map(float, p)) for p in r]) for k, r in cells.items()], "k int, points array<array<double>>")
    alone = _sides([tuple(p) for p in r["points"]] for r in spatial.simplify_rings(plain, 0.08).collect())
    assert any(n == 1 and not (rim(a) and rim(b)) for (a, b), n in alone.items())  # rings on their own do part


def test_reduced_borders_do_not_cross(spark):
    """Two combs whose teeth stand in one another's gaps, much closer than the tolerance."""
    up = [(k / 2, 0.9 if k % 2 else 0.1) for k in range(21)]
    down = [(k / 2, 1.0 if k % 2 else 0.2) for k in range(21)]
    cells = {1: [(0, -3), (10, -3), *up[::-1], (0, -3)], 2: [(0, 4), *down, (10, 4), (0, 4)]}
    for tolerance in (0.3, 0.75, 2.0):
        sides = list(_sides(_generalised(spark, cells, tolerance).values()))
        assert not any(_cross(s, t) for s, t in combinations(sides, 2))
    wild = _lattice(random.Random(5), 4, 12, 0.9)
    given = {s for s in _sides(wild.values())}
    sides = list(_sides(_generalised(spark, wild, 0.4).values()))
    bad = {x for s, t in combinations(sides, 2) if _cross(s, t) for x in (s, t)}
    assert bad <= given and len(sides) < len(given)  # only crossings of the input are left


def test_an_island_stays_on_its_side(spark):
    bay = [(0, 0), (4, 0), (4.5, 1), (5, 1.5), (5.5, 1), (6, 0), (10, 0), (10, 9), (0, 9), (0, 0)]
    island = [(4.9, 0.4), (5.1, 0.4), (5.1, 0.6), (4.9, 0.6), (4.9, 0.4)]  # in the bay, outside the ring
    got = _generalised(spark, {1: bay, 2: island}, 2.0)
    assert (5.0, 1.5) in got[1]
    assert (5.0, 1.5) not in _generalised(spark, {1: bay}, 2.0)[1]


def test_odd_rings(spark):
    hole = [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]
    rows = [(1, None), (2, []), (3, [[0.0, 0.0], [1.0, 0.0], [0.0, 0.0]]), (4, [[float(x), float(y)] for x, y in hole]),
            (5, [[float(x), float(y)] for x, y in [(2, 2), (2, 2), *hole[3:], *hole[1:3]]])]
    df = spark.createDataFrame(rows, "k int, points array<array<double>>")
    got = {r["k"]: r["points"] for r in generalise.simplify_neighbours(df, ["k"], 0.001).collect()}
    assert got[1] is None and got[2] == [] and got[3] == rows[2][1]
    assert _sides([got[4]]) == _sides([got[5]]) == _sides([rows[3][1]])
    assert generalise.simplify_neighbours(df.limit(0), ["k"], 1.0).count() == 0
