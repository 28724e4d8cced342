"""Points and polygons: strict point-in-polygon by a grid of cells, nearest polygon in an equal-area projection.

A polygon table has geo_id, name, position and rings: array<array<struct<x double, y double>>> (first ring is the
shell, others are holes), and a crs that must not be null.  Datum shifts under a metre are taken as none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: nearest_polygon sends its polygons to tasks in blocks of about this many vertices.
BLOCK_VERTICES = 5_000_000
#: Points times edges, or points times boxes, that are measured at once.
AT_ONCE = 1 << 17


def rings_of(value: object) -> list[np.ndarray]:
    return [np.array([(p["x"], p["y"]) for p in ring], float).reshape(-1, 2) for ring in value]


def inside_each(x: np.ndarray, y: np.ndarray, rings: list[np.ndarray]) -> np.ndarray:
    """Strictly inside, for each point: even-odd over all rings, points on an edge are outside."""
    odd, edge = np.zeros(len(x), bool), np.zeros(len(x), bool)
    x, y = x[:, None], y[:, None]
    for ring in rings:
        (ax, ay), (bx, by) = ring.T, np.roll(ring, -1, axis=0).T
        cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        box = (np.minimum(ax, bx) <= x) & (x <= np.maximum(ax, bx)) & (np.minimum(ay, by) <= y) & (y <= np.maximum(ay, by))
        edge |= ((cross == 0) & box).any(axis=1)
        up = (ay > y) != (by > y)
        with np.errstate(divide="ignore", invalid="ignore"):
            at = (bx - ax) * (y - ay) / (by - ay) + ax
        odd ^= (up & (x < at)).sum(axis=1) % 2 == 1
    return odd & ~edge


def inside(x: float, y: float, rings: list[np.ndarray]) -> bool:
    return bool(inside_each(np.array([x]), np.array([y]), rings)[0])


def albers(lon: np.ndarray, lat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Metres in the equal-area conic of the conterminous United States (Snyder 1987, ellipsoid GRS80)."""
    a, e2 = 6378137.0, 0.0066943800229
    e = math.sqrt(e2)

    def q(phi: np.ndarray) -> np.ndarray:
        s = np.sin(phi)
        return (1 - e2) * (s / (1 - e2 * s * s) - np.log((1 - e * s) / (1 + e * s)) / (2 * e))

    m = lambda phi: np.cos(phi) / np.sqrt(1 - e2 * np.sin(phi) ** 2)
    p0, p1, p2, l0 = np.radians(23.0), np.radians(29.5), np.radians(45.5), np.radians(-96.0)
    n = (m(p1) ** 2 - m(p2) ** 2) / (q(p2) - q(p1))
    c = m(p1) ** 2 + n * q(p1)
    rho = a * np.sqrt(c - n * q(np.radians(lat))) / n
    theta = n * (np.radians(lon) - l0)
    return rho * np.sin(theta), a * np.sqrt(c - n * q(p0)) / n - rho * np.cos(theta)


def edge_distances(x: np.ndarray, y: np.ndarray, rings: list[np.ndarray]) -> np.ndarray:
    """Distance of each point to the nearest edge, unrounded.

    Corners and edges along an axis take differences of coordinates alone, and an edge is measured the same from either end, so that
    equal distances come out equal and others, however close, do not.
    """
    best = np.full(len(x), math.inf)
    x, y = x[:, None], y[:, None]
    for ring in rings:
        a, b = ring, np.roll(ring, -1, axis=0)
        swap = ((a[:, 0] > b[:, 0]) | ((a[:, 0] == b[:, 0]) & (a[:, 1] > b[:, 1])))[:, None]
        (ax, ay), (bx, by) = np.where(swap, b, a).T, np.where(swap, a, b).T
        dx, dy = bx - ax, by - ay
        size = dx * dx + dy * dy
        size[size == 0] = 1
        t = ((x - ax) * dx + (y - ay) * dy) / size
        gap_x = np.where((dy == 0) & (ax <= x) & (x <= bx), 0.0, np.where(t < 1, ax, bx) - x)
        gap_y = np.where((dx == 0) & (ay <= y) & (y <= by), 0.0, np.where(t < 1, ay, by) - y)
        slanted = (t > 0) & (t < 1) & (dx != 0) & (dy != 0)
        far = np.where(slanted, np.abs(dx * (y - ay) - dy * (x - ax)) / np.sqrt(size), np.sqrt(gap_x * gap_x + gap_y * gap_y))
        best = np.minimum(best, far.min(axis=1))
    return best


def edge_distance(x: float, y: float, rings: list[np.ndarray]) -> float:
    return float(edge_distances(np.array([x]), np.array([y]), rings)[0])


def cells(low_x: Column, high_x: Column, low_y: Column, high_y: Column, size: float) -> Column:
    step = lambda c: F.floor(c / size).cast("bigint")
    xs, ys = F.sequence(step(low_x), step(high_x)), F.sequence(step(low_y), step(high_y))
    return F.explode(F.flatten(F.transform(xs, lambda i: F.transform(ys, lambda j: F.struct(i.alias("i"), j.alias("j"))))))


def point_in_polygon(points: DataFrame, polygons: DataFrame, id_col: str, x: str, y: str, cell: float = 1.0) -> DataFrame:
    """(id, geo_id) of the polygon that strictly holds each point; the first by position where polygons overlap.

    Points and the cells of the polygons' boxes meet in an equi-join; only those pairs are tested exactly.
    """
    if polygons.where("crs is null").limit(1).count():
        raise ValueError("a polygon has no coordinate reference system")
    flat = F.flatten("rings")
    xs, ys = F.transform(flat, lambda p: p["x"]), F.transform(flat, lambda p: p["y"])
    boxed = polygons.select("geo_id", "position", "rings", F.array_min(xs).alias("x0"), F.array_max(xs).alias("x1"), F.array_min(ys).alias("y0"), F.array_max(ys).alias("y1"))
    tiled = boxed.select("*", cells(F.col("x0"), F.col("x1"), F.col("y0"), F.col("y1"), cell).alias("cell"))
    spots = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(id_col).alias("__id"), F.col(x).alias("__x"), F.col(y).alias("__y")).withColumn("cell", F.struct(F.floor(F.col("__x") / cell).cast("bigint").alias("i"), F.floor(F.col("__y") / cell).cast("bigint").alias("j")))
    near = spots.join(tiled, "cell").where(F.col("__x").between(F.col("x0"), F.col("x1")) & F.col("__y").between(F.col("y0"), F.col("y1")))

    @F.pandas_udf("boolean")
    def test(px: pd.Series, py: pd.Series, shape: pd.Series) -> pd.Series:
        return pd.Series([inside(a, b, rings_of(r)) for a, b, r in zip(px, py, shape, strict=True)], dtype=bool)

    return near.where(test("__x", "__y", "rings")).groupBy(F.col("__id").alias(id_col)).agg(F.min_by("geo_id", "position").alias("geo_id"))


Shape = tuple[int, str, list[np.ndarray]]


def nearest_of(x: np.ndarray, y: np.ndarray, shapes: list[Shape], boxes: np.ndarray, rounded: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(distance, number) of the shape nearest to each point, the first by position and geo_id among equal distances; -1 without a shape.

    A point visits shapes by the distance of their boxes (x0, y0, x1, y1), which is never more than their own, until that passes the best;
    points that visit one shape do so together.  ``rounded`` compares distances at six decimals.
    """
    best, number = np.full(len(x), math.inf), np.full(len(x), -1)
    if not shapes:
        return best, number
    rank = np.empty(len(shapes), np.int64)
    rank[sorted(range(len(shapes)), key=lambda k: shapes[k][:2])] = np.arange(len(shapes))
    gap_x = np.maximum(0, np.maximum(boxes[:, 0] - x[:, None], x[:, None] - boxes[:, 2]))
    gap_y = np.maximum(0, np.maximum(boxes[:, 1] - y[:, None], y[:, None] - boxes[:, 3]))
    bound = np.hypot(gap_x, gap_y)
    order = np.argsort(bound, axis=1, kind="stable")
    left = np.arange(len(x))
    for k in order.T:
        left = left[~(bound[left, k[left]] > best[left] * (1 + 1e-9) + 1e-6 * rounded)]  # the last bits of both are rounded
        if not len(left):
            break
        by = left[np.argsort(k[left], kind="stable")]
        for same in np.split(by, np.flatnonzero(np.diff(k[by])) + 1):
            shape = int(k[same[0]])
            rings = shapes[shape][2]
            step = max(1, AT_ONCE // max(len(r) for r in rings))
            for i in range(0, len(same), step):
                at = same[i : i + step]
                far = np.where(inside_each(x[at], y[at], rings), 0.0, edge_distances(x[at], y[at], rings))
                far = np.round(far, 6) if rounded else far
                better = (far < best[at]) | ((far == best[at]) & ((number[at] < 0) | (rank[shape] < rank[number[at]])))
                best[at[better]], number[at[better]] = far[better], shape
    return best, number


def nearest_polygon(points: DataFrame, polygons: DataFrame, id_col: str, x: str, y: str, project: bool = True, block: int = BLOCK_VERTICES) -> DataFrame:
    """(id, nearest geo_id, metres) over all polygons; ties go to the smaller position; without a polygon: null.

    Distances are given to six decimals and compared unrounded, except in the projection: its own rounding would part a
    point on a border from one of the polygons there.  Polygons go to the tasks in blocks of about ``block`` vertices by a hash of their id.  Each point meets every block, and the nearest of
    the blocks' nearest polygons is kept, so that neither the driver nor a task holds more than a block.
    """
    size = polygons.agg(F.sum(F.size(F.flatten("rings")))).first()[0] or 0
    blocks = max(1, -(-size // block))
    place = albers if project else lambda a, b: (a, b)
    kind = points.schema[id_col].dataType.simpleString()
    spots = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(id_col).alias("__id"), F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y"))

    def against(k: int) -> DataFrame:
        part = polygons.where(F.pmod(F.xxhash64("geo_id", "position"), F.lit(blocks)) == k) if blocks > 1 else polygons
        shapes = []
        for r in part.select("position", "geo_id", "rings").toLocalIterator():
            rings = [np.stack(place(g[:, 0], g[:, 1]), axis=1) for g in rings_of(r["rings"]) if len(g)]
            if rings:
                shapes.append((r["position"], r["geo_id"], rings))
        sent = points.sparkSession.sparkContext.broadcast(shapes)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            boxes = np.array([[*np.min([g.min(axis=0) for g in rings], axis=0), *np.max([g.max(axis=0) for g in rings], axis=0)] for _, _, rings in sent.value]).reshape(-1, 4)
            for batch in batches:
                px, py = place(batch.column("__x").to_numpy(zero_copy_only=False), batch.column("__y").to_numpy(zero_copy_only=False))
                step = max(1, AT_ONCE // max(1, len(boxes)))
                for i in range(0, len(px), step):
                    far, number = nearest_of(px[i : i + step], py[i : i + step], sent.value, boxes, project)
                    found = [(sent.value[n][0], sent.value[n][1], m) if n >= 0 else (None, None, None) for n, m in zip(number.tolist(), far.tolist(), strict=True)]
                    columns = [pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), (pa.int64(), pa.string(), pa.float64()), strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column("__id").slice(i, step), *columns], ["__id", "position", "geo_id", "metres"])

        return spots.mapInArrow(run, f"__id {kind}, position long, geo_id string, metres double")

    found = against(0)
    if blocks > 1:
        for k in range(1, blocks):
            found = found.union(against(k))
        by = F.struct(F.coalesce("metres", F.lit(math.inf)).alias("m"), "position")
        found = found.groupBy("__id").agg(F.min_by("geo_id", by).alias("geo_id"), F.min("metres").alias("metres"))
    return found.select(F.col("__id").alias(id_col), F.col("geo_id").alias("nearest_geo_id"), F.round("metres", 6).alias("nearest_distance_m"))


def assign_polygons(points: DataFrame, polygons: DataFrame, id_col: str, lat: str, lon: str) -> DataFrame:
    """All points with their polygon, the nearest one for those outside, and a status."""
    held = point_in_polygon(points, polygons, id_col, lon, lat)
    placed = points.join(held, id_col, "left")
    lost = placed.where(F.col("geo_id").isNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull())
    near = nearest_polygon(lost.select(id_col, lat, lon), polygons, id_col, lon, lat)
    status = F.when(F.col("geo_id").isNotNull(), "assigned").when(F.col(lat).isNull() | F.col(lon).isNull(), "no_coordinates").otherwise("outside_county_boundaries")
    return placed.join(near, id_col, "left").withColumn("county_assignment_status", status)
