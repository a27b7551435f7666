"""Boundaries as edges, containment, grids, kernel density and generalisation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from quarryline.plans.sizing import BROADCAST_BYTES, small_side
from quarryline.session import pin

RING = "array<array<double>>"


# ---- boundaries ------------------------------------------------------------


def rings(features: DataFrame, keys: Sequence[str], geometry: str = "geometry") -> DataFrame:
    """One row per ring of a Polygon or MultiPolygon (``type``, ``coordinates`` as text)."""
    kind, text = F.col(f"{geometry}.type"), F.col(f"{geometry}.coordinates")
    multi = F.when(kind == "MultiPolygon", F.from_json(text, f"array<array<{RING}>>"))
    single = F.when(kind == "Polygon", F.array(F.from_json(text, f"array<{RING}>")))
    parts = features.select(*keys, F.posexplode(F.coalesce(multi, single)).alias("part", "_rings"))
    return parts.select(*keys, "part", F.posexplode("_rings").alias("ring", "points"))


def ring_edges(ring_table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per edge: consecutive points of each ring."""
    points = F.col("points")
    pairs = F.arrays_zip(
        F.slice(points, F.lit(1), F.size(points) - 1).alias("a"),
        F.slice(points, F.lit(2), F.size(points) - 1).alias("b"),
    )
    usable = ring_table.filter(F.size(points) >= 2)
    edges = usable.select(*keys, "part", "ring", F.posexplode(pairs).alias("seq", "_e"))
    ends = [F.col("_e.a")[0], F.col("_e.a")[1], F.col("_e.b")[0], F.col("_e.b")[1]]
    return edges.select(*keys, "part", "ring", "seq", *[e.alias(n) for e, n in zip(ends, ("x1", "y1", "x2", "y2"), strict=True)])


# ---- containment -----------------------------------------------------------


# Share of a cell by which rounding may move an edge.
ROUNDING = 1e-6


def edge_cells(edges: DataFrame, boundary: str, cell: float) -> DataFrame:
    """Per (cell row, cell column, boundary): ``_edges``, the edges that touch the cell, and ``_levels``.

    A ray to the right from a point of the cell meets, beyond its own cell, each
    edge whose ends lie on different sides of the ray: it matters only which ends
    are above.  Ends that two such edges share cancel out, so what is left per
    cell are the few ends where a line enters the cell's column, and one infinite
    level if an odd number of lines leaves through the row's upper side.  A cell
    inside a boundary holds that one level and no edge; edges are copied only
    into cells that they touch.
    """
    def at(c: Column) -> Column:
        return F.floor(c / F.lit(cell)).cast("bigint")

    y_low, y_high = F.least("y1", "y2"), F.greatest("y1", "y2")
    per_row = edges.select(
        boundary, "x1", "y1", "x2", "y2",
        F.explode(F.sequence(at(y_low), at(y_high))).alias("_row"),
    )
    # The stretch of the edge in this row; a nearly level edge counts in full.
    x_low, x_high = F.least("x1", "x2"), F.greatest("x1", "x2")
    level = F.abs(F.col("y2") - F.col("y1")) <= F.lit(cell * ROUNDING)

    def x_where(y: Column) -> Column:
        held = F.greatest(y_low, F.least(y_high, y))
        x = F.col("x1") + (F.col("x2") - F.col("x1")) * (held - F.col("y1")) / F.when(~level, F.col("y2") - F.col("y1"))
        return F.greatest(x_low, F.least(x_high, x))

    ends = [x_where(F.col("_row") * F.lit(cell)), x_where((F.col("_row") + 1) * F.lit(cell))]
    margin = F.lit(cell * ROUNDING)
    placed = per_row.select(
        boundary, "x1", "y1", "x2", "y2", "_row",
        at(F.when(level, x_low).otherwise(F.least(*ends)) - margin).alias("_from"),
        at(F.when(level, x_high).otherwise(F.greatest(*ends)) + margin).alias("_to"),
    )
    touched = placed.select(
        "_row", F.explode(F.sequence("_from", "_to")).alias("_col"), boundary,
        F.struct("x1", "y1", "x2", "y2").alias("_edge"), F.lit(None).cast("double").alias("_level"),
    )

    def end_level(y: str) -> Column:
        """Above every point of the row, among them, or (null) below all."""
        return F.when(at(F.col(y)) > F.col("_row"), float("inf")).when(at(F.col(y)) == F.col("_row"), F.col(y))

    ends_of = placed.select(boundary, "_row", "_from", F.explode(F.array(end_level("y1"), end_level("y2"))).alias("_level"))
    left = placed.groupBy(boundary, "_row").agg(F.min("_from").alias("_left"))
    steps = ends_of.filter("_level is not null").groupBy(boundary, "_row", "_level").agg(
        F.sort_array(F.collect_list("_from"), asc=False).alias("_steps")
    )
    # Columns with an odd number of such ends beyond them lie between every other pair of steps.
    pairs = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_steps") - 1) / 2).cast("int")),
        lambda k: F.struct(
            F.coalesce(F.get("_steps", 2 * k + 1), F.col("_left")).alias("first"), (F.get("_steps", 2 * k) - 1).alias("last")
        ),
    )
    odd = steps.join(left, [boundary, "_row"]).select(boundary, "_row", "_level", F.explode(pairs).alias("_p"))
    beyond = odd.filter("_p.first <= _p.last").select(
        "_row", F.explode(F.sequence("_p.first", "_p.last")).alias("_col"), boundary,
        F.lit(None).cast(touched.schema["_edge"].dataType).alias("_edge"), "_level",
    )
    cells = touched.unionByName(beyond).groupBy("_row", "_col", boundary)
    return cells.agg(F.collect_list("_edge").alias("_edges"), F.collect_list("_level").alias("_levels"))


def _strictly_inside(x: Column, y: Column, edges: Column, levels: Column) -> Column:
    """Odd number of crossings, in the cell and beyond it, and on no edge."""

    def step(state: Column, e: Column) -> Column:
        x1, y1, x2, y2 = e["x1"], e["y1"], e["x2"], e["y2"]
        straddles = (y1 > y) != (y2 > y)
        crosses = straddles & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
        level = (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1)
        touches = level & x.between(F.least(x1, x2), F.greatest(x1, x2)) & y.between(F.least(y1, y2), F.greatest(y1, y2))
        return F.struct(
            (state["odd"] != F.coalesce(crosses, F.lit(False))).alias("odd"),
            (state["on"] | touches).alias("on"),
        )

    beyond = F.size(F.filter(levels, lambda v: v > y)) % 2 == 1
    start = F.struct(beyond.alias("odd"), F.lit(False).alias("on"))
    return F.aggregate(edges, start, step, lambda s: s["odd"] & ~s["on"])


def points_in_boundaries(
    points: DataFrame, x: str, y: str, edges: DataFrame, boundary: str, cell: float
) -> DataFrame:
    """Points joined to every boundary that strictly contains them (parts and holes
    by the even-odd rule; a point on an edge is outside).

    An equi-join on the grid cell: a point meets only boundaries present in its
    own cell and only the edges that matter there.  The edge side is built once
    and broadcast if it proves small; otherwise a hot cell of points is split by
    the adaptive skew join.
    """
    index = pin(edge_cells(edges, boundary, cell).withColumnsRenamed({boundary: "_boundary"}))
    row_bytes = 64 + 40 * F.size("_edges") + 8 * F.size("_levels") + F.coalesce(F.octet_length(F.col("_boundary").cast("string")), F.lit(0))
    held = index.agg(F.sum(row_bytes)).first()[0] or 0
    side = F.broadcast(index) if held <= BROADCAST_BYTES else index
    located = points.withColumns(
        {
            "_row": F.floor(F.col(y) / F.lit(cell)).cast("bigint"),
            "_col": F.floor(F.col(x) / F.lit(cell)).cast("bigint"),
        }
    )
    joined = located.join(side, ["_row", "_col"])
    inside = joined.filter(_strictly_inside(F.col(x), F.col(y), F.col("_edges"), F.col("_levels")))
    return inside.select(*points.columns, F.col("_boundary").alias(boundary))


# ---- grids and density -----------------------------------------------------


def grid(extents: DataFrame, n: int, x: str = "x", y: str = "y") -> DataFrame:
    """The n-by-n axis product per row of ``min_x, max_x, min_y, max_y``: ``i`` runs
    along y and ``j`` along x, ends included."""
    cells = extents.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(n * n - 1))))
    i, j = F.floor(F.col("cell") / n).cast("int"), (F.col("cell") % n).cast("int")

    def along(axis: str, k: Column) -> Column:
        low, high = F.col(f"min_{axis}").cast("double"), F.col(f"max_{axis}").cast("double")
        return low + k * ((high - low) / F.lit(float(max(n - 1, 1))))

    return cells.withColumns({"i": i, "j": j}).withColumns({x: along(x, F.col("j")), y: along(y, F.col("i"))})


# Groups whose partial surfaces one task holds before it hands them on.
SURFACES_IN_MEMORY = 32
# In units where the kernel is exp(-d*d): points lie in boxes of side 1, each box is a
# Hermite series of ORDER terms along either axis, and a box adds to cells within REACH.
ORDER = 22
REACH = 6.5
BOXES_IN_MEMORY = 2_000
POINTS_PER_STEP = 1_024


def kernel_density(
    df: DataFrame, keys: Sequence[str], x: str, y: str, n: int = 200
) -> DataFrame:
    """Gaussian kernel density per group on its own n-by-n grid, Silverman bandwidth,
    scaled so that each group's highest cell is 1.

    Repeated points are counted first.  Rows are then range-partitioned by group
    and position, so a hot group spreads over many tasks; each task adds its
    points into one partial surface per group, and the surfaces are summed.  A
    task therefore sends n*n rows per group it met, never point-cell pairs.  A
    group whose points have no spread has a null density.

    Points are summed by a fast Gauss transform: each adds to the series of its box,
    and each box is evaluated at the cells within its reach, so the work grows with
    points plus boxes, not with points times cells.  A sum of the kernel over points
    of weight W within reach is off by less than 4e-14 W (term n of a
    series along one axis is below 1.1 * 0.5**(n/2) / sqrt(n!)) and by less
    than 3e-16 of the weight beyond it.
    """
    points = df.select(*keys, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).na.drop(subset=["x", "y"])
    stats = points.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("_n"),
        *[f(c).alias(f"{name}_{c}") for c in ("x", "y") for name, f in (("min", F.min), ("max", F.max))],
        F.var_samp("x").alias("_vx"),
        F.var_samp("y").alias("_vy"),
        F.covar_samp("x", "y").alias("_vxy"),
    )
    factor = F.pow(F.col("_n"), F.lit(-1.0 / 3.0))
    det = F.col("_vx") * F.col("_vy") - F.col("_vxy") * F.col("_vxy")
    # Inverse of the scaled 2x2 covariance, halved: the exponent's coefficients.
    scale = F.when(det > 0, 0.5 / (det * factor))
    shapes = pin(stats.select(
        *keys, "min_x", "max_x", "min_y", "max_y",
        (F.col("_vy") * scale).alias("_a"),
        (-F.col("_vxy") * scale).alias("_b"),
        (F.col("_vx") * scale).alias("_c"),
    ))
    cells = grid(shapes.select(*keys, "min_x", "max_x", "min_y", "max_y"), n).select(*keys, "cell", "i", "j", "x", "y")

    weighted = points.groupBy(*keys, "x", "y").agg(F.count(F.lit(1)).cast("double").alias("_w"))
    spread = weighted.repartitionByRange(*keys, "x", "y")
    shape_side = small_side(shapes.filter("_a is not null"))
    joined = spread.join(shape_side, list(keys))
    key_fields = [joined.schema[k] for k in keys]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in key_fields) + ", cell int, mass double"
    masses = joined.mapInPandas(_surface_task(list(keys), n), schema).groupBy(*keys, "cell").agg(F.sum("mass").alias("mass"))

    placed = cells.join(masses, [*keys, "cell"], "left")
    top = F.max("mass").over(Window.partitionBy(*keys))
    return placed.select(*keys, "i", "j", "x", "y", (F.col("mass") / top).alias("density"))


def _surface_task(keys: list[str], n: int):
    shape = ["min_x", "max_x", "min_y", "max_y", "_a", "_b", "_c"]

    def frames(surfaces: dict) -> Iterator[pd.DataFrame]:
        for key, surface in surfaces.items():
            out = pd.DataFrame({"cell": np.arange(n * n, dtype=np.int32), "mass": surface.done().ravel()})
            for name, value in zip(reversed(keys), reversed(key), strict=True):
                out.insert(0, name, value)
            yield out

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        surfaces: dict = {}
        for batch in batches:
            for key, part in batch.groupby(keys, sort=False, dropna=False):
                if key not in surfaces and len(surfaces) >= SURFACES_IN_MEMORY:
                    yield from frames(surfaces)
                    surfaces.clear()
                if key not in surfaces:
                    surfaces[key] = GaussSurface(n, *part[shape].iloc[0])
                surfaces[key].add(part["x"].to_numpy(), part["y"].to_numpy(), part["_w"].to_numpy())
        yield from frames(surfaces)

    return task


class GaussSurface:
    """Sums of ``w * exp(-(a dx^2 + 2 b dx dy + c dy^2))`` over points, on an n-by-n grid."""

    def __init__(self, n: int, x0: float, x1: float, y0: float, y1: float, a: float, b: float, c: float):
        # u = along * (x + shear * y) and v = across * y make the kernel exp(-du^2 - dv^2).
        self.origin, self.shear = (x0, y0), b / a
        self.along, self.across = np.sqrt(a), np.sqrt(c - b * b / a)
        self.grid_x, self.grid_y = np.linspace(x0, x1, n) - x0, np.linspace(y0, y1, n) - y0
        self.mass = np.zeros((n, n))
        self.boxes, self.series = np.zeros((0, 2)), np.zeros((0, ORDER, ORDER))

    def add(self, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> None:
        dx, dy = x - self.origin[0], y - self.origin[1]
        u, v = self.along * (dx + self.shear * dy), self.across * dy
        for at in range(0, len(w), POINTS_PER_STEP):
            part = slice(at, at + POINTS_PER_STEP)
            places = np.column_stack([np.floor(u[part]), np.floor(v[part])])
            order = np.lexsort(places.T)
            places = places[order]
            opens = np.flatnonzero(np.append(True, (places[1:] != places[:-1]).any(axis=1)))
            within = [_scaled_powers(q[part][order] - places[:, k] - 0.5) for k, q in enumerate((u, v))]
            products = (within[0] * w[part][order][:, None])[:, :, None] * within[1][:, None, :]
            self._keep(places[opens], np.add.reduceat(products, opens, axis=0))

    def _keep(self, boxes: np.ndarray, series: np.ndarray) -> None:
        boxes = np.concatenate([self.boxes, boxes])
        self.boxes, at = np.unique(boxes, axis=0, return_inverse=True)
        summed = np.zeros((len(self.boxes), ORDER, ORDER))
        summed[at.ravel()[: len(self.series)]] = self.series
        summed[at.ravel()[len(self.series) :]] += series  # the boxes of one step differ
        self.series = summed
        if len(self.boxes) > BOXES_IN_MEMORY:
            self.done()

    def done(self) -> np.ndarray:
        """The sums so far; the boxes are evaluated and forgotten."""
        n = len(self.grid_x)
        centre_u, centre_v = self.boxes[:, 0] + 0.5, self.boxes[:, 1] + 0.5
        step = self.along * (self.grid_x[1] - self.grid_x[0]) if n > 1 else 1.0
        for row, y in enumerate(self.grid_y if len(self.boxes) else []):
            near = np.flatnonzero(np.abs(self.across * y - centre_v) <= REACH)
            if not len(near):
                continue
            middle, start = centre_u[near], self.along * self.shear * y
            first = np.clip(np.ceil((middle - REACH - start) / step), 0, n).astype(int)
            end = np.clip(np.floor((middle + REACH - start) / step) + 1, 0, n).astype(int)
            columns = first[:, None] + np.arange(max(int((end - first).max()), 0))
            inside = columns < end[:, None]
            columns = np.minimum(columns, n - 1)
            across = np.stack(list(_hermite(self.across * y - centre_v[near])), axis=1)
            weights = np.einsum("kuv,kv->ku", self.series[near], across)
            offset = self.along * self.grid_x[columns] + start - middle[:, None]
            values = np.zeros(columns.shape)
            for order, term in enumerate(_hermite(offset)):
                values += weights[:, order, None] * term
            self.mass[row] += np.bincount(columns[inside], values[inside], n)
        self.boxes, self.series = np.zeros((0, 2)), np.zeros((0, ORDER, ORDER))
        return self.mass


def _scaled_powers(x: np.ndarray) -> np.ndarray:
    """x**k / k! for k below ORDER, a column each."""
    out = np.ones((len(x), ORDER))
    for k in range(1, ORDER):
        out[:, k] = out[:, k - 1] * x / k
    return out


def _hermite(x: np.ndarray) -> Iterator[np.ndarray]:
    """The Hermite functions of x, of order 0 up to ORDER."""
    before, term = np.zeros_like(x), np.exp(-x * x)
    for k in range(ORDER):
        yield term
        before, term = term, 2 * x * term - 2 * k * before


# ---- generalisation --------------------------------------------------------


def simplify_rings(ring_table: DataFrame, tolerance: float, points: str = "points") -> DataFrame:
    """Vertex reduction (Douglas-Peucker) of every ring; a ring keeps at least four points.

    A ring arrives as one value of one record, so it is reduced where it lies:
    no shuffle and no grouping, and a task holds one Arrow batch of records.
    """

    @F.arrow_udf(RING)
    def reduce(column: pa.Array) -> pa.Array:
        vertices = column.flatten()
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        xy = np.column_stack([pc.list_element(vertices, i).to_numpy(zero_copy_only=False) for i in (0, 1)])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        keep = kept_vertices(xy, starts, tolerance)
        offsets = np.concatenate([[0], np.cumsum(keep)])[starts].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), vertices.filter(pa.array(keep)), mask=column.is_null())

    return ring_table.withColumn(points, reduce(F.col(points)))


def kept_vertices(xy: np.ndarray, starts: np.ndarray, tolerance: float, closed: np.ndarray | None = None) -> np.ndarray:
    """Which vertices stay, for many rings laid end to end (``starts`` has one entry
    per ring and the end).  All open stretches of all rings are split together,
    one level at a time.  Lines that ``closed`` says are no rings keep their ends."""
    first, end = starts[:-1], starts[1:]
    closed = np.ones(len(first), bool) if closed is None else closed
    keep = np.repeat(closed & (end - first <= 4), end - first)
    opened, last = first[~closed], end[~closed] - 1
    keep[opened] = keep[last] = True
    a, b = opened, last
    first, last = (x[closed & (end - first > 4)] for x in (first, end - 1))
    if len(first):
        # A closed ring has no chord of its own: split it at the vertex farthest from
        # its start and at the one farthest from that chord, which are always kept.
        far = farthest(xy, first, last, first, first)[0]
        before, after = farthest(xy, first, far, first, far), farthest(xy, far, last, first, far)
        off = np.where(after[1] > before[1], after[0], before[0])
        fixed = np.sort(np.stack([first, far, off, last]), axis=0)
        keep[fixed.ravel()] = True
        a, b = np.concatenate([a, fixed[:-1].ravel()]), np.concatenate([b, fixed[1:].ravel()])
    while len(a):
        middle, gap = farthest(xy, a, b, a, b)
        split = gap > tolerance
        keep[middle[split]] = True
        a, b = np.concatenate([a[split], middle[split]]), np.concatenate([middle[split], b[split]])
    return keep


def farthest(xy, a, b, p, q) -> tuple[np.ndarray, np.ndarray]:
    """Per stretch a..b: the vertex strictly inside it farthest from segment p-q (the
    first of equals) and its distance, which is -1 for a stretch without any."""
    lengths = np.maximum(b - a - 1, 0)
    best, at = np.full(len(a), -1.0), a.copy()
    some = np.flatnonzero(lengths)
    if not len(some):
        return at, best
    counts = lengths[some]
    offsets = np.concatenate([[0], np.cumsum(counts)[:-1]])
    index = np.repeat(a[some] + 1 - offsets, counts) + np.arange(counts.sum())
    base, along = xy[np.repeat(p[some], counts)], xy[np.repeat(q[some], counts)] - xy[np.repeat(p[some], counts)]
    away = xy[index] - base
    square = (along * along).sum(axis=1)
    t = np.clip((away * along).sum(axis=1) / np.where(square == 0, 1.0, square), 0.0, 1.0)
    distance = np.hypot(*(away - t[:, None] * along).T)
    best[some] = np.maximum.reduceat(distance, offsets)
    hits = np.flatnonzero(distance == np.repeat(best[some], counts))
    owner = np.searchsorted(offsets, hits, side="right") - 1
    owners, where = np.unique(owner, return_index=True)
    at[some[owners]] = index[hits[where]]
    return at, best
