"""Point in polygon (J9): which neighbourhood boundary contains each listing.

The reference stores boundaries but never uses them; this is the
re-aimed operator. Boundaries are MultiPolygon coordinate arrays
(polygons -> rings -> [lon, lat] points, staging P4).

Plan: an equi-join on cells of a quadtree, then the exact test near borders.
  1. cover: each polygon of a MultiPolygon, however far from the others, begins with the at most four cells of the least
     power-of-two side that is no less than its own width and height. A cell that an edge
     touches is cut in four, ``depth`` times; it keeps only the edges that touch it.
     Cells without edges lie inside or outside as a whole, decided at their
     middle; those outside go. So the cells of a polygon follow the length of its border
     in units of its own size, not its area, and no cell size need be given;
  2. each point gets its cell at each level of the cover (a few, one for each
     order of size of the polygons);
  3. equi-join on the cell (AQE broadcasts the cover when its measured
     size is small and splits a hot cell if one holds a third of the points). A point in an
     inner cell is inside; only those in border cells meet the boundary;
  4. ray casting with higher-order functions (``exists``/``aggregate``/
     ``filter`` over rings, no Python): a point is inside a polygon when
     a ray to +lon crosses its rings (outer ring and holes) an odd number
     of times; edges are half-open in latitude so a vertex is counted once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _ring_crossings(ring: Column, lon: Column, lat: Column) -> Column:
    """Number of ring edges crossed by the ray from (lon, lat) towards +lon."""
    idx = F.sequence(F.lit(0), F.size(ring) - 2)

    def crosses(i):
        a, b = ring[i], ring[i + 1]
        ya, yb, xa, xb = a[1], b[1], a[0], b[0]
        straddles = (ya > lat) != (yb > lat)
        x_at = F.try_divide((xb - xa) * (lat - ya), yb - ya) + xa
        return straddles & (lon < x_at)

    return F.size(F.filter(idx, crosses))


def inside_multipolygon(boundary: Column, lon: Column, lat: Column) -> Column:
    """TRUE when the point lies inside any polygon of the MultiPolygon (holes excluded)."""
    def in_polygon(poly):
        total = F.aggregate(poly, F.lit(0), lambda acc, ring: acc + _ring_crossings(ring, lon, lat))
        return total % 2 == 1

    return F.coalesce(F.exists(boundary, in_polygon), F.lit(False))


def bounding_box(boundary: Column) -> list[Column]:
    pts = F.flatten(F.flatten(boundary))
    xs = F.transform(pts, lambda p: p[0])
    ys = F.transform(pts, lambda p: p[1])
    return [F.array_min(xs).alias("min_lon"), F.array_max(xs).alias("max_lon"),
            F.array_min(ys).alias("min_lat"), F.array_max(ys).alias("max_lat")]


#: A cell at a polygon's border has a side of 1/64 of the polygon's size or more.
DEPTH = 6


def _edges(boundary: Column) -> Column:
    """All ring edges as structs (xa, ya, xb, yb)."""
    def edge(ring, i):
        a, b = ring[i], ring[i + 1]
        return F.struct(a[0].alias("xa"), a[1].alias("ya"), b[0].alias("xb"), b[1].alias("yb"))

    rings = F.filter(F.flatten(boundary), lambda ring: F.size(ring) > 1)
    return F.flatten(F.transform(rings, lambda ring: F.transform(F.sequence(F.lit(0), F.size(ring) - 2), lambda i: edge(ring, i))))


#: Of the edges, those that meet the closed cell (x0, x1) x (y0, y1); one that passes it within rounding counts. As text: a level is one call then.
TOUCHING = """filter(edges, e -> least(e.xa, e.xb) <= x1 AND greatest(e.xa, e.xb) >= x0 AND least(e.ya, e.yb) <= y1 AND greatest(e.ya, e.yb) >= y0
  AND least({turns}) <= {slack} AND greatest({turns}) >= -({slack}))""".format(
    turns=", ".join(f"(e.xb - e.xa) * ({y} - e.ya) - (e.yb - e.ya) * ({x} - e.xa)" for x in ("x0", "x1") for y in ("y0", "y1")),
    slack="(abs(e.xb - e.xa) + abs(e.yb - e.ya)) * (abs(e.xa) + abs(e.ya) + 1) * 1e-12D")
#: The four parts of a cell that edges touch, any other cell as it is.
PARTS = "if(size(edges) > 0, array({parts}), array(struct(level, cx, cy)))".format(
    parts=", ".join(f"struct(level + 1 AS level, 2 * cx + {i} AS cx, 2 * cy + {j} AS cy)" for i in (0, 1) for j in (0, 1)))
CORNERS = "inline(array(struct(cx * pow(2D, -level) AS x0, (cx + 1) * pow(2D, -level) AS x1, cy * pow(2D, -level) AS y0, (cy + 1) * pow(2D, -level) AS y1)))"


def _parts(polygons: DataFrame, key: str, boundary: str) -> DataFrame:
    """(key, part, _shape): the polygons of each boundary, each as a MultiPolygon of its own."""
    return polygons.select(key, F.posexplode(boundary).alias("part", "_polygon")).select(key, "part", F.array("_polygon").alias("_shape"))


def polygon_cells(polygons: DataFrame, key: str, boundary: str, depth: int = DEPTH, cell: float | None = None) -> DataFrame:
    """(key, part, level, cx, cy, inner) for the cells of the cover of each polygon (part) of a boundary; the side of a cell is 2^-level.

    Boundaries without key and polygons without extent have none. ``cell`` bounds the side of all cells.
    """
    extent = F.greatest(F.col("max_lon") - F.col("min_lon"), F.col("max_lat") - F.col("min_lat"))
    c = _parts(polygons.where(F.col(key).isNotNull()), key, boundary)
    # inline() of one struct keeps what it computes apart: without it each use below would get a copy of the expressions
    c = c.select(key, "part", "_shape", F.inline(F.array(F.struct(_edges(F.col("_shape")).alias("edges"), *bounding_box(F.col("_shape"))))))
    level = F.floor(-F.log2(extent)).cast("int")
    if cell:
        level = F.greatest(level, F.lit(math.ceil(-math.log2(cell))))
    c = c.where(extent > 0).select("*", F.inline(F.array(F.struct(level.alias("level"), F.pow(F.lit(2.0), level).alias("unit")))))

    def span(z):
        return F.sequence(F.floor(F.col(f"min_{z}") * F.col("unit")), F.floor(F.col(f"max_{z}") * F.col("unit")))

    shared = [f"`{key}`", "part", "_shape"]

    def clipped(df):
        return df.selectExpr(*shared, "level", "cx", "cy", "edges", CORNERS).selectExpr(*shared, "level", "cx", "cy", f"{TOUCHING} AS edges")

    c = clipped(c.withColumn("cx", F.explode(span("lon"))).withColumn("cy", F.explode(span("lat"))))
    for _ in range(depth):
        c = clipped(c.selectExpr(*shared, "edges", f"inline({PARTS})"))
    # kept apart once more, as in the beginning
    c = c.selectExpr(*shared, "level", "cx", "cy", "inline(array(struct(size(edges) = 0 AS inner, (cx + 0.5D) * pow(2D, -level) AS mx, (cy + 0.5D) * pow(2D, -level) AS my)))")
    return c.where(~F.col("inner") | inside_multipolygon(F.col("_shape"), F.col("mx"), F.col("my"))).select(key, "part", "level", "cx", "cy", "inner")


def points_in_polygons(points: DataFrame, lon: str, lat: str, polygons: DataFrame, id_col: str,
                       key: str = "neighbourhood", boundary: str = "neighbourhood_boundary",
                       depth: int = DEPTH, cell: float | None = None) -> DataFrame:
    """Every point row with the key of each polygon it is inside; NULL where it is in none or has no coordinates.

    ``id_col`` tells points apart. ``depth`` says how often cells at a border are cut: one more
    doubles the cells of a polygon and halves the points that are cast rays for. ``cell``, if given, is the
    largest side of a cell in degrees; a polygon much larger than it has many cells then. The cover is
    written, its levels (one for each power of two of sizes, and ``depth`` more) reach the driver.
    """
    cover = cut_lineage(polygon_cells(polygons, key, boundary, depth, cell).withColumnRenamed(key, "_poly_key"))
    levels = sorted(r[0] for r in cover.select("level").distinct().collect())
    shape = _parts(polygons, key, boundary).withColumnsRenamed({key: "_shape_key", "part": "_shape_part"})
    same = (F.col("_poly_key") == F.col("_shape_key")) & (F.col("part") == F.col("_shape_part"))
    cells = [F.struct(F.lit(v).alias("level"), *[F.floor(F.col(z) * F.lit(2.0 ** v)).alias(c) for z, c in (("_lon", "cx"), ("_lat", "cy"))]) for v in levels]
    at = points.select(F.col(id_col).alias("_id"), F.col(lon).cast("double").alias("_lon"), F.col(lat).cast("double").alias("_lat"))
    at = at.where(F.col("_lon").isNotNull() & F.col("_lat").isNotNull() & ~F.isnan("_lon") & ~F.isnan("_lat"))
    at = at.select("*", F.inline(F.array(*cells) if cells else F.array().cast("array<struct<level:int,cx:bigint,cy:bigint>>")))
    near = at.join(cover, ["level", "cx", "cy"]).join(shape, same & ~F.col("inner"), "left")
    hit = near.where(F.col("inner") | inside_multipolygon(F.col("_shape"), F.col("_lon"), F.col("_lat"))).select("_id", "_poly_key").distinct()
    return points.join(hit, F.col(id_col) == F.col("_id"), "left").select(
        *[points[c] for c in points.columns], F.col("_poly_key").alias(f"{key}_in_boundary"))
