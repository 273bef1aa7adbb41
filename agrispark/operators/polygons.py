"""Points and polygons: membership and nearest polygon by grid cells.

Polygons come as vertices ``(keys..., ring, k, lon, lat)``: closed rings in the order of ``k``, any number of them a
polygon; what an odd number of rings surrounds is inside, so parts and holes need no marks. All work that grows with
the outlines is done on their side, and ends in one row a grid cell: the polygons there, whether the cell's centre is
inside, and the edges that pass through the cell. A point then joins the row of its cell alone and counts the edges
between the centre and itself. Points are neither shuffled nor multiplied while the cells are few enough to broadcast;
beyond that it is one join on the cell, whose skew adaptive execution splits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrispark.operators.geometry import RADIUS, to_utm, to_web_mercator
from agrispark.registry import query
from agrispark.storage import dropped, kept, small

#: Shares of a cell by which the grid is moved east and north, so that centres don't meet edges between round coordinates.
EAST, NORTH = 0.3819660113, 0.7320508076
#: Latitude to which web Mercator is cut, since the poles have no place in it.
MOST_LATITUDE = 89.9
KEYS = ("iso3", "region")


def cell_of(v: Column, size: float, shift: float) -> Column:
    return F.floor((v + shift * size) / size)


def centre_of(cell: Column, size: float, shift: float) -> Column:
    return (cell + 0.5) * size - shift * size


def in_mercator(table: DataFrame) -> DataFrame:
    """``lon`` and ``lat`` replaced by metres of web Mercator."""
    lat = F.greatest(F.lit(-MOST_LATITUDE), F.least(F.lit(MOST_LATITUDE), F.col("lat")))
    x, y = to_web_mercator(F.col("lon"), lat)
    return table.withColumns({"lon": x, "lat": y})


def edges_of(outlines: DataFrame, keys=KEYS) -> DataFrame:
    """``(shape, x0, y0, x1, y1)``: the edges of all rings."""
    after = Window.partitionBy(*keys, "ring").orderBy("k")
    ends = outlines.select(F.struct(*keys).alias("shape"), F.col("lon").alias("x0"), F.col("lat").alias("y0"), F.lead("lon").over(after).alias("x1"), F.lead("lat").over(after).alias("y1"))
    return ends.where("x1 is not null and (x0 <> x1 or y0 <> y1)")


def _x_at(e, y: Column) -> Column:
    return (e["x1"] - e["x0"]) * (y - e["y0"]) / (e["y1"] - e["y0"]) + e["x0"]


def _straddles(e, y: Column) -> Column:
    return (e["y0"] > y) != (e["y1"] > y)


def odd(edges: Column, x: Column, y: Column) -> Column:
    """Whether a ray to the right crosses an odd number of edges."""
    return F.size(F.filter(edges, lambda e: _straddles(e, y) & (x < _x_at(e, y)))) % 2 == 1


def crossed(edges: Column, cx: Column, cy: Column, x: Column, y: Column) -> Column:
    """How many edges are crossed on the way from (cx, cy) up or down to the height of (x, y) and then along it."""
    def upright(e) -> Column:
        at = (e["y1"] - e["y0"]) * (cx - e["x0"]) / (e["x1"] - e["x0"]) + e["y0"]
        return ((e["x0"] > cx) != (e["x1"] > cx)) & ((at > cy) != (at > y))

    def level(e) -> Column:
        return _straddles(e, y) & ((cx < _x_at(e, y)) != (x < _x_at(e, y)))

    return F.size(F.filter(edges, upright)) + F.size(F.filter(edges, level))


def cells_of_shapes(edges: DataFrame, size: float, margin: float = 0.0) -> DataFrame:
    """``(cx, cy, shapes)``: for each cell that a polygon touches, its polygons by key, ``(shape, odd, near)``; ``near`` has the edges within the margin."""
    slack = margin + 1e-9 * size
    steps = lambda a, b, shift: F.explode(F.sequence(cell_of(a - slack, size, shift), cell_of(b + slack, size, shift)))
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    rows = edges.withColumn("e", F.struct("x0", "y0", "x1", "y1")).withColumn("cy", steps(low, high, NORTH))
    bottom = F.col("cy") * size - NORTH * size
    flat = F.col("y0") == F.col("y1")
    ends = [F.when(flat, F.col(c)).otherwise(_x_at(F.col("e"), F.greatest(low, F.least(high, y)))) for c, y in (("x0", bottom - slack), ("x1", bottom + size + slack))]
    near = rows.withColumn("cx", steps(F.least(*ends), F.greatest(*ends), EAST)).groupBy("shape", "cx", "cy").agg(F.collect_list("e").alias("near"))
    strips = rows.groupBy("shape", "cy").agg(F.collect_list("e").alias("strip"))
    spans = near.groupBy("shape", "cy").agg(F.sequence(F.min("cx"), F.max("cx")).alias("cx")).withColumn("cx", F.explode("cx"))
    centres = spans.join(strips, ["shape", "cy"]).select("shape", "cx", "cy", odd(F.col("strip"), centre_of(F.col("cx"), size, EAST), centre_of(F.col("cy"), size, NORTH)).alias("odd"))
    found = centres.join(near, ["shape", "cx", "cy"], "left").where(F.col("odd") | F.col("near").isNotNull())
    held = F.struct("shape", "odd", F.coalesce("near", F.array().cast("array<struct<x0:double,y0:double,x1:double,y1:double>>")).alias("near"))
    return found.groupBy("cx", "cy").agg(F.array_sort(F.collect_list(held)).alias("shapes"))


def first_within(points: DataFrame, edges: DataFrame, size: float) -> DataFrame:
    """``points`` with ``held``, the first polygon by key that a point is inside of, or null."""
    cells = kept(cells_of_shapes(edges, size), "cells")
    keyed = points.withColumns({"cx": cell_of(F.col("lon"), size, EAST), "cy": cell_of(F.col("lat"), size, NORTH)})
    cx, cy = centre_of(F.col("cx"), size, EAST), centre_of(F.col("cy"), size, NORTH)
    inside = F.filter("shapes", lambda s: s["odd"] != (crossed(s["near"], cx, cy, F.col("lon"), F.col("lat")) % 2 == 1))
    return keyed.join(small(cells), ["cx", "cy"], "left").withColumn("held", F.get(inside, F.lit(0))["shape"]).drop("cx", "cy", "shapes")


def inset(points: DataFrame, outlines: DataFrame, metres: float, keys=KEYS, size: float = 2.0) -> DataFrame:
    """The points (with lon, lat) inside any polygon and at least ``metres`` from its edges, in the UTM zone of the polygon's middle.

    Edges are straight between their ends in UTM. Latitudes beyond 80 degrees see edges of fewer metres only.
    """
    box = outlines.groupBy(*keys).agg(((F.min("lon") + F.max("lon")) / 2).alias("_mid"), (F.min("lat") + F.max("lat") < 0).alias("south")).withColumn("zone", F.floor((F.col("_mid") + 180) / 6) + 1).drop("_mid")
    zoned = outlines.join(small(box), list(keys))
    margin = metres / 110_000 / math.cos(math.radians(80))
    cells = kept(cells_of_shapes(edges_of(zoned, (*keys, "zone", "south")), size, margin), "cells")
    keyed = points.withColumns({"_cx": cell_of(F.col("lon"), size, EAST), "_cy": cell_of(F.col("lat"), size, NORTH)})
    cx, cy = centre_of(F.col("_cx"), size, EAST), centre_of(F.col("_cy"), size, NORTH)
    held = cells.select(F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), F.col("shapes").alias("_shapes"))

    def well_inside(s) -> Column:
        zone, south = s["shape"]["zone"], s["shape"]["south"]
        _, x, y = to_utm(F.col("lon"), F.col("lat"), zone, south)

        def far(e) -> Column:
            (_, x0, y0), (_, x1, y1) = (to_utm(e[f"x{k}"], e[f"y{k}"], zone, south) for k in "01")
            line = F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"), x.alias("x"), y.alias("y"))
            return F.get(F.transform(F.array(line), lambda g: segment_distance(g["x"], g["y"], g) >= metres), F.lit(0))

        return (s["odd"] != (crossed(s["near"], cx, cy, F.col("lon"), F.col("lat")) % 2 == 1)) & F.forall(s["near"], far)

    return keyed.join(small(held), ["_cx", "_cy"]).where(F.exists("_shapes", well_inside)).drop("_cx", "_cy", "_shapes")


def segment_distance(x: Column, y: Column, e) -> Column:
    dx, dy = e["x1"] - e["x0"], e["y1"] - e["y0"]
    t = F.least(F.greatest(((x - e["x0"]) * dx + (y - e["y0"]) * dy) / (dx * dx + dy * dy), F.lit(0.0)), F.lit(1.0))
    a, b = x - e["x0"] - t * dx, y - e["y0"] - t * dy
    return F.sqrt(a * a + b * b)


def near_edges(cells: DataFrame, edges: DataFrame, size: float) -> DataFrame:
    """``(nx, ny, edges)``: for each cell all edges that are nearest to any of its points.

    With D the distance of the edge nearest to a cell's centre and r half its diagonal, they lie within D + 2r of the
    centre. D is searched in rounds: edges are sent to all squares within reach, cells look into their own square;
    those that find an edge within reach are done, the others go on with four times the reach.
    """
    r = size * math.sqrt(0.5)
    todo = kept(cells.select("nx", "ny", centre_of(F.col("nx"), size, EAST).alias("x"), centre_of(F.col("ny"), size, NORTH).alias("y")), "todo")
    reach, out = size, None
    while out is None or not todo.isEmpty():
        def squares(a: str, b: str, reach=reach) -> Column:
            beyond = reach + 2 * r
            return F.explode(F.sequence(F.floor((F.least(a, b) - beyond) / reach), F.floor((F.greatest(a, b) + beyond) / reach)))

        sent = edges.withColumn("sx", squares("x0", "x1")).withColumn("sy", squares("y0", "y1"))
        looked = todo.withColumns({"sx": F.floor(F.col("x") / reach), "sy": F.floor(F.col("y") / reach)}).join(sent, ["sx", "sy"])
        e = F.struct("shape", "x0", "y0", "x1", "y1")
        met = looked.select("nx", "ny", e.alias("e"), segment_distance(F.col("x"), F.col("y"), e).alias("d"))
        least = F.min("d").over(Window.partitionBy("nx", "ny"))
        last = reach > 4 * math.pi * RADIUS
        done = met.withColumn("least", least).where((F.col("least") <= reach) | F.lit(last)).where(F.col("d") <= F.col("least") + 2 * r)
        done = kept(done.groupBy("nx", "ny").agg(F.collect_list("e").alias("edges")), "near")
        out = done if out is None else out.unionByName(done)
        if last:
            break
        before, todo = todo, kept(todo.join(done, ["nx", "ny"], "left_anti"), "todo")
        dropped(before)
        reach *= 4
    return out


def placed(points: DataFrame, outlines: DataFrame, mercator: bool = False, keys=KEYS, degrees: float = 2.0, metres: float = 250_000.0) -> DataFrame:
    """``points`` (with lon, lat) and the first polygon by key that holds each, else the nearest in web Mercator.

    Adds the keys and ``status``: within, nearest, or invalid for coordinates that are null or out of range, which get
    no polygon. ``mercator``: edges are straight in web Mercator for membership too. Distances are compared in whole
    millimetres; of equally near polygons the first by key counts.
    """
    valid = F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)
    marked = points.withColumn("_valid", F.coalesce(valid, F.lit(False)))
    flat = in_mercator(outlines)
    if mercator:
        own = in_mercator(marked.withColumns({"_lon": F.col("lon"), "_lat": F.col("lat")}))
        within = first_within(own, edges_of(flat, keys), metres)
    else:
        own = marked.withColumns({"_lon": F.col("lon"), "_lat": F.col("lat")})
        within = in_mercator(first_within(own, edges_of(outlines, keys), degrees))
    alone = F.col("_valid") & F.col("held").isNull()
    keyed = within.withColumns({"nx": F.when(alone, cell_of(F.col("lon"), metres, EAST)), "ny": F.when(alone, cell_of(F.col("lat"), metres, NORTH))})
    cells = keyed.select("nx", "ny").where("nx is not null and ny is not null").distinct()
    near = near_edges(cells, kept(edges_of(flat, keys), "edges"), metres)
    best = F.array_min(F.transform("edges", lambda e: F.struct(F.round(segment_distance(F.col("lon"), F.col("lat"), e), 3).alias("d"), e["shape"].alias("shape"))))["shape"]
    shape = F.when(F.col("_valid"), F.coalesce("held", best))
    status = F.when(~F.col("_valid"), "invalid").when(F.col("held").isNotNull(), "within").when(shape.isNotNull(), "nearest")
    joined = keyed.join(small(near), ["nx", "ny"], "left").withColumns({"_shape": shape, "status": status})
    return joined.select(*(F.col({"lon": "_lon", "lat": "_lat"}.get(c, c)).alias(c) for c in points.columns), *(F.col("_shape")[k].alias(k) for k in keys), "status")


_EDGES = """ed AS (SELECT * FROM (SELECT iso3, region, lon AS x0, lat AS y0, lead(lon) OVER (PARTITION BY iso3, ring ORDER BY k) AS x1, lead(lat) OVER (PARTITION BY iso3, ring ORDER BY k) AS y1 FROM outlines) WHERE x1 IS NOT NULL)"""
_METRES = """radians({0}) * 6378137e0 AS {1}, ln(tan(radians({2}) / 2 + pi() / 4)) * 6378137e0 AS {3}"""
_FLAT = f"me AS (SELECT iso3, region, {_METRES.format('x0', 'x0', 'y0', 'y0')}, {_METRES.format('x1', 'x1', 'y1', 'y1')} FROM ed)"
_INSIDE = "SELECT sample_id, min(iso3) AS iso3, arg_min(region, iso3) AS region FROM (SELECT sample_id, iso3, region FROM {0} p, {1} WHERE (y0 > lat) <> (y1 > lat) AND lon < (x1 - x0) * (lat - y0) / (y1 - y0) + x0 GROUP BY ALL HAVING count(*) % 2 = 1) GROUP BY sample_id"
_NEAR = """SELECT sample_id, arg_min(iso3, o) AS iso3, arg_min(region, o) AS region FROM (SELECT sample_id, iso3, region, {'d': round(sqrt((x - x0 - t * (x1 - x0)) * (x - x0 - t * (x1 - x0)) + (y - y0 - t * (y1 - y0)) * (y - y0 - t * (y1 - y0))), 3), 'i': iso3} AS o FROM
  (SELECT *, least(greatest(((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)), 0), 1) AS t FROM un, me)) GROUP BY sample_id"""
#: ``reg``: each sample's polygon by counting all edges and measuring all distances.
PLACED_SQL = f"""{_EDGES}, {_FLAT}, ok AS (SELECT sample_id, lon, lat FROM {{0}} WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180), ins AS ({_INSIDE.format('ok', 'ed')}),
  un AS (SELECT sample_id, {_METRES.format('lon', 'x', 'lat', 'y')} FROM ok WHERE sample_id NOT IN (SELECT sample_id FROM ins)), nr AS ({_NEAR}),
  reg AS (SELECT s.sample_id, coalesce(ins.iso3, nr.iso3) AS iso3, coalesce(ins.region, nr.region) AS region, CASE WHEN ok.sample_id IS NULL THEN 'invalid' WHEN ins.iso3 IS NOT NULL THEN 'within' ELSE 'nearest' END AS status
    FROM {{0}} s LEFT JOIN ok USING (sample_id) LEFT JOIN ins USING (sample_id) LEFT JOIN nr USING (sample_id))""".replace("{'d'", "{{'d'").replace("iso3} AS o", "iso3}} AS o")
_FLAT_PLACED = PLACED_SQL.replace("ins AS (", f"om AS (SELECT sample_id, {_METRES.format('lon', 'lon', 'lat', 'lat')} FROM ok), ins AS (").replace("FROM ok p, ed", "FROM om p, me")


@query("spatial_join_within", "located", "outlines", sql=f"WITH {PLACED_SQL.format('located')} SELECT * FROM reg")
def spatial_join_within(located: DataFrame, outlines: DataFrame) -> DataFrame:
    """Region of each sample's polygon, else of the nearest; invalid coordinates are reported."""
    return placed(located.select("sample_id", "lon", "lat"), outlines).drop("lon", "lat")


@query("nearest_polygon_join", "samples", "outlines", sql=f"WITH {_FLAT_PLACED.format('samples')} SELECT sample_id, iso3, region, status = 'nearest' AS nearest FROM reg")
def nearest_polygon_join(samples: DataFrame, outlines: DataFrame) -> DataFrame:
    """The polygon nearest in web Mercator, which is the one around the sample where there is one."""
    return placed(samples.select("sample_id", "lon", "lat"), outlines, mercator=True).select("sample_id", "iso3", "region", (F.col("status") == "nearest").alias("nearest"))
