"""Vertex reduction of boundaries that keeps neighbours joined and apart.

A border that two rings share is one arc: it is reduced between the same ends and in
the same direction for both, so no gap opens.  A reduced stretch that would cross or
touch another one, or leave a kept vertex on its wrong side, gets vertices back.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quarryline.operators.spatial import RING, farthest, kept_vertices
from quarryline.session import pin

POSITIONS = "array<int>"
# Rounds in which a stretch in conflict is halved; later ones give it all its points back.
HALVINGS = 3


def simplify_neighbours(
    ring_table: DataFrame, ring_id: Sequence[str], tolerance: float, points: str = "points"
) -> DataFrame:
    """Douglas-Peucker on shared arcs; ``ring_id`` columns (not null) name a ring.

    Rings are closed (the first point again at the end).  A point where rings part
    is kept, and so is every ring of up to four points; null rings stay null, and
    points that repeat their predecessor go.  Crossings that the input has stay:
    they get all their vertices back.  Which side a point lies on is judged in
    doubles.

    A ring is one value of one record throughout.  What is shuffled are its vertices
    (once, to find where rings part) and, in every round, the reduced stretches: a
    stretch meets others by cells as wide as itself, so a dense place makes its cells
    small instead of full.  A round returns its farthest vertex to each stretch in
    conflict, from the fourth on all its vertices, so rounds end.
    """
    ids = list(ring_id)
    # Written first: an unpinned expression would be worked out again for every point.
    before = F.concat(F.array(F.lit(None).cast("array<double>")), points)
    fresh = F.zip_with(points, before, lambda p, q: F.when(p == q, F.lit(None)).otherwise(p))
    clean = pin(ring_table.withColumn(points, F.filter(fresh, lambda p: p.isNotNull())))
    parts = _parting_points(clean, ids, points)
    cuts = parts.groupBy(*ids).agg(F.array_sort(F.collect_list("_at")).alias("_cuts"))
    state = clean.join(cuts, ids, "left")
    start = first_kept(F.col(points), F.coalesce("_cuts", F.array().cast(POSITIONS)), tolerance)
    state = pin(state.select(*ring_table.columns, start.alias("_kept")))
    for turn in count():
        stretches = pin(_stretches(state, ids, points))
        found = pin(_conflicts(stretches))
        if found.isEmpty():
            break
        back = stretches.join(found, ["_x1", "_y1", "_x2", "_y2", "_print"], "left_semi")
        places = F.array("_middle") if turn < HALVINGS else F.col("_places")
        more = back.groupBy(*ids).agg(F.flatten(F.collect_list(places)).alias("_more"))
        union = F.array_sort(F.array_union("_kept", F.coalesce("_more", F.array().cast(POSITIONS))))
        state = pin(state.join(more, ids, "left").select(*ring_table.columns, union.alias("_kept")))
    kept = F.transform("_kept", lambda k: F.get(points, k))
    closed = F.when(F.size("_kept") > 0, F.concat(kept, F.slice(kept, 1, 1))).otherwise(F.col(points))
    return state.withColumn(points, closed).select(*ring_table.columns)


def _parting_points(clean: DataFrame, ids: list[str], points: str) -> DataFrame:
    """``_at`` per ring: places of the points whose neighbours differ between visits."""
    n = F.size(points) - 1
    around = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.struct(
            i.cast("int").alias("at"), F.get(points, i).alias("p"),
            F.array_sort(F.array(F.get(points, F.when(i == 0, n - 1).otherwise(i - 1)), F.get(points, i + 1))).alias("sides"),
        ),
    )
    visits = clean.filter(n >= 3).select(*ids, F.explode(around).alias("_v")).select(
        *ids, F.col("_v.at").alias("_at"), F.col("_v.p")[0].alias("_x"), F.col("_v.p")[1].alias("_y"),
        F.xxhash64("_v.sides").alias("_sides"),
    )
    seen = visits.groupBy("_x", "_y").agg(F.min("_sides").alias("lo"), F.max("_sides").alias("hi"))
    return visits.join(seen.filter("lo <> hi").select("_x", "_y"), ["_x", "_y"]).select(*ids, "_at")


# ---- inside a ring ---------------------------------------------------------


def _rings(column: pa.Array):
    """Each ring's points without the closing one, as an array (empty if there is none)."""
    for ring in column.to_pylist():
        yield np.array(ring[:-1] if ring and len(ring) > 3 else [], float).reshape(-1, 2)


def _one_way(xy: np.ndarray, start: int, end: int) -> np.ndarray:
    """Places from ``start`` on to ``end`` around a ring, in the direction that every
    ring with these points takes."""
    places = np.arange(start, end + 1) % len(xy)
    line = xy[places]
    differ = np.flatnonzero((line != line[::-1]).any(axis=1))
    if len(differ) and tuple(line[differ[0]]) > tuple(line[::-1][differ[0]]):
        return places[::-1]
    return places


def first_kept(points: Column, cuts: Column, tolerance: float) -> Column:
    """Places that stay of a ring, reduced arc by arc between its cuts."""

    @F.arrow_udf(POSITIONS)
    def reduce(column: pa.Array, cuts: pa.Array) -> pa.Array:
        lines, places, owners, closed, n_rings = [], [], [], [], len(column)
        for owner, (xy, at) in enumerate(zip(_rings(column), cuts.to_pylist(), strict=True)):
            if not len(xy):
                continue
            at = sorted(at) or [int(np.lexsort((xy[:, 1], xy[:, 0]))[0])]
            for a, b in zip(at, [*at[1:], at[0] + len(xy)], strict=True):
                way = _one_way(xy, a, b)
                lines.append(xy[way])
                places.append(way)
                owners.append(owner)
                closed.append(bool((xy[way[0]] == xy[way[-1]]).all()))
        kept: list[set[int]] = [set() for _ in range(n_rings)]
        if lines:
            starts = np.cumsum([0, *map(len, lines)])
            keep = kept_vertices(np.concatenate(lines), starts, tolerance, np.array(closed))
            for owner, way, first in zip(owners, places, starts, strict=False):
                kept[owner].update(way[keep[first : first + len(way)]].tolist())
        return pa.array([sorted(k) for k in kept], pa.list_(pa.int32()))

    return reduce(points, cuts)


def middles(points: Column, kept: Column) -> Column:
    """Per kept place: the place, up to the next kept one, that lies farthest from the
    chord between them; null where nothing lies between."""

    @F.arrow_udf(POSITIONS)
    def find(column: pa.Array, kept: pa.Array) -> pa.Array:
        out = []
        for xy, at in zip(_rings(column), kept.to_pylist(), strict=True):
            ways = [_one_way(xy, a, b) for a, b in zip(at, [*at[1:], at[0] + len(xy)], strict=True)] if at else []
            found: list[int | None] = []
            if ways:
                ends = np.cumsum([len(w) for w in ways])
                begins, line = ends - [len(w) for w in ways], np.concatenate(ways)
                best, _ = farthest(xy[line], begins, ends - 1, begins, ends - 1)
                found = [int(line[m]) if len(w) > 2 else None for m, w in zip(best, ways, strict=True)]
            out.append(found)
        return pa.array(out, pa.list_(pa.int32()))

    return find(points, kept)


# ---- between stretches -----------------------------------------------------


def _stretches(state: DataFrame, ids: list[str], points: str) -> DataFrame:
    """One row per ring and kept place: the chord to the next one, lesser end first,
    what it leaves out, and a print that is the same in both rings of a border."""
    n = F.size(points) - 1
    listed = state.filter(F.size("_kept") > 0).withColumn("_middles", middles(F.col(points), F.col("_kept")))
    each = F.transform(
        F.col("_kept"),
        lambda a, k: F.struct(
            a.alias("a"), F.coalesce(F.get("_kept", k + 1), F.get("_kept", F.lit(0)) + n).alias("b"),
            F.get("_middles", k).alias("middle"),
        ),
    )
    inner = F.transform(F.sequence(F.col("_s.a") + 1, F.col("_s.b") - 1), lambda i: (i % n).cast("int"))
    inner = F.when(F.col("_s.b") - F.col("_s.a") > 1, inner).otherwise(F.array().cast(POSITIONS))
    rows = listed.select(*ids, points, F.explode(each).alias("_s")).select(
        *ids, F.col("_s.middle").alias("_middle"), inner.alias("_places"),
        F.get(points, F.col("_s.a")).alias("_p"), F.get(points, F.col("_s.b") % n).alias("_q"),
        F.transform(inner, lambda i: F.get(points, i)).alias("_out"),
    )
    swap = F.col("_p") > F.col("_q")
    low, high = F.least("_p", "_q"), F.greatest("_p", "_q")
    between = F.when(swap, F.reverse("_out")).otherwise(F.col("_out"))
    rows = rows.select(*ids, "_middle", "_places", low.alias("_p"), high.alias("_q"), between.alias("_out"))
    line = F.concat("_out", F.array("_p", "_q"))
    xs, ys = F.transform(line, lambda p: p[0]), F.transform(line, lambda p: p[1])
    return rows.select(
        *ids, "_middle", "_places", "_out", F.xxhash64("_out").alias("_print"),
        *[F.col(end)[i].alias(name) for end, i, name in (("_p", 0, "_x1"), ("_p", 1, "_y1"), ("_q", 0, "_x2"), ("_q", 1, "_y2"))],
        F.array_min(xs).alias("_left"), F.array_max(xs).alias("_right"), F.array_min(ys).alias("_low"), F.array_max(ys).alias("_high"),
    )


def _conflicts(stretches: DataFrame) -> DataFrame:
    """Stretches with points left out that meet another one elsewhere than at a common end."""
    names = ["_x1", "_y1", "_x2", "_y2", "_print", "_out", "_left", "_right", "_low", "_high"]
    width = F.greatest(F.col("_right") - F.col("_left"), F.col("_high") - F.col("_low"))
    # The least power of two that is no narrower; a stretch lies in at most four cells of it.
    level = F.when(width > 0, F.ceil(F.log2(width))).otherwise(F.lit(-1000)).cast("int")
    one = pin(stretches.select(*names, level.alias("_level")).dropDuplicates(names[:5]))
    levels = sorted(r[0] for r in one.select("_level").distinct().collect())  # a double has some 2,000 exponents at most
    if not levels:
        return one.select(*names[:5])

    def cells(df: DataFrame) -> DataFrame:
        for low, high, name in (("_left", "_right", "_cx"), ("_low", "_high", "_cy")):
            at = [F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("_at"))) for c in (low, high)]
            df = df.withColumn(name, F.explode(F.sequence(*at)))
        return df

    home = cells(one.withColumn("_at", F.col("_level")))
    above = F.filter(F.lit(levels).cast(POSITIONS), lambda v: v >= F.col("_level"))
    guest = cells(one.withColumn("_at", F.explode(above)))
    h, g = home.alias("h"), guest.alias("g")
    # Both at home on one level would meet twice; the lesser end and print decide.
    order = [F.struct(*[F.col(f"{s}.{c}") for c in names[:5]]) for s in "hg"]
    met = (
        (F.col("h._at") == F.col("g._at")) & (F.col("h._cx") == F.col("g._cx")) & (F.col("h._cy") == F.col("g._cy"))
        & ((F.size("h._out") > 0) | (F.size("g._out") > 0))
        & (F.col("h._left") <= F.col("g._right")) & (F.col("g._left") <= F.col("h._right"))
        & (F.col("h._low") <= F.col("g._high")) & (F.col("g._low") <= F.col("h._high"))
        & ((F.col("g._level") < F.col("h._level")) | (order[0] < order[1]))
    )
    pairs = h.join(g, met & _disturb("h", "g"))
    both = F.array(*[F.struct(*[F.col(f"{s}.{c}").alias(c) for c in names[:5]], (F.size(f"{s}._out") > 0).alias("cut")) for s in "hg"])
    hit = pairs.select(F.explode(both).alias("c")).filter("c.cut").select("c.*").drop("cut")
    return hit.distinct()


def _turn(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    """Which side of the line a-b the point p lies on: -1, 0 or 1."""
    return F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def _disturb(h: str, g: str) -> Column:
    """The chords meet, or an end of one lies between the other and what it left out."""
    ends = {s: [(F.col(f"{s}._x{k}"), F.col(f"{s}._y{k}")) for k in (1, 2)] for s in (h, g)}

    def same(p, q) -> Column:
        return (p[0] == q[0]) & (p[1] == q[1])

    def on(p, s: str) -> Column:
        """On the chord, its ends left out."""
        a, b = ends[s]
        inside = p[0].between(F.least(a[0], b[0]), F.greatest(a[0], b[0])) & p[1].between(F.least(a[1], b[1]), F.greatest(a[1], b[1]))
        return (_turn(*a, *b, *p) == 0) & inside & ~same(p, a) & ~same(p, b)

    def enclosed(p, s: str) -> Column:
        """By the left-out points and the chord, by the even-odd rule."""
        a, b = ends[s]
        loop = F.concat(F.array(F.array(*a)), F.col(f"{s}._out"), F.array(F.array(*b), F.array(*a)))
        sides = F.zip_with(
            F.slice(loop, F.lit(1), F.size(loop) - 1), F.slice(loop, F.lit(2), F.size(loop) - 1),
            lambda u, v: F.struct(u.alias("u"), v.alias("v")),
        )

        def crossed(e: Column) -> Column:
            u, v = e["u"], e["v"]
            return ((u[1] > p[1]) != (v[1] > p[1])) & (p[0] < (v[0] - u[0]) * (p[1] - u[1]) / (v[1] - u[1]) + u[0])

        odd = F.size(F.filter(sides, lambda e: F.coalesce(crossed(e), F.lit(False)))) % 2 == 1
        box = p[0].between(F.col(f"{s}._left"), F.col(f"{s}._right")) & p[1].between(F.col(f"{s}._low"), F.col(f"{s}._high"))
        return (F.size(f"{s}._out") > 0) & ~same(p, a) & ~same(p, b) & box & odd

    (a, b), (c, d) = ends[h], ends[g]
    across = (_turn(*a, *b, *c) * _turn(*a, *b, *d) < 0) & (_turn(*c, *d, *a) * _turn(*c, *d, *b) < 0)
    alike = same(a, c) & same(b, d)  # the same chord from different points
    tests = [across, alike, *[on(p, h) for p in (c, d)], *[on(p, g) for p in (a, b)]]
    tests += [enclosed(p, h) for p in (c, d)] + [enclosed(p, g) for p in (a, b)]
    met = tests[0]
    for t in tests[1:]:
        met = met | t
    return met
