"""Production grids: areas cut into squares in metres of their UTM zone, and small tiles merged into neighbours.

Rings are arrays of points, closed by repeating the first. They are cut by half-planes one after the other, each a fold
over the edges; strips are cut first and squares from the strips, so an edge is looked at once a strip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrispark.operators.geometry import to_utm, utm_sql
from agrispark.operators.polygons import segment_distance
from agrispark.registry import query
from agrispark.storage import dropped, kept, small

#: Letters of latitude bands, of columns of squares (by zone modulo three) and of rows (fixed values of the military grid).
BANDS, COLUMNS, ROWS = "CDEFGHJKLMNPQRSTUVWX", ("STUVWXYZ", "ABCDEFGH", "JKLMNPQR"), "ABCDEFGHJKLMNPQRSTUV"
RING = "array<struct<x:double,y:double>>"
SQUARE = 100_000.0


def pairs(ring: Column) -> Column:
    """The edges of a ring."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def cut(ring: Column, axis: str, low: Column, high: Column) -> Column:
    """The part of a ring between two bounds of an axis; what follows a bound may double back along it."""
    other = "y" if axis == "x" else "x"

    def half(points: Column, h: Column) -> Column:
        within = lambda p: (p[axis] - h["bound"]) * h["sign"] >= 0

        def kept_of(e: Column) -> Column:
            a, b = e["a"], e["b"]
            at = a[other] + (b[other] - a[other]) * (h["bound"] - a[axis]) / (b[axis] - a[axis])
            cross = F.struct(*(v.alias(n) for n, v in sorted(((axis, h["bound"]), (other, at)))))
            none = F.array().cast(RING)
            return F.when(within(a) & within(b), F.array(b)).when(within(a), F.array(cross)).when(within(b), F.array(cross, b)).otherwise(none)

        left = F.flatten(F.transform(pairs(points), kept_of))
        return F.get(F.transform(F.array(left), lambda p: F.when(F.size(p) > 0, F.concat(F.array(F.element_at(p, -1)), p)).otherwise(p)), F.lit(0))

    planes = F.array(F.struct(low.alias("bound"), F.lit(1.0).alias("sign")), F.struct(high.alias("bound"), F.lit(-1.0).alias("sign")))
    return F.aggregate(planes, ring, half)


def signed_area(ring: Column) -> Column:
    """Positive for rings that run against the clock; measured from the first point, so that large coordinates don't cancel."""
    o = ring[0]
    cross = lambda e: (e["a"]["x"] - o["x"]) * (e["b"]["y"] - o["y"]) - (e["b"]["x"] - o["x"]) * (e["a"]["y"] - o["y"])
    return F.aggregate(F.transform(pairs(ring), cross), F.lit(0.0), lambda t, v: t + v) / 2


def area(rings: Column) -> Column:
    return F.aggregate(F.transform(rings, signed_area), F.lit(0.0), lambda t, v: t + v)


def oriented(rings: Column) -> Column:
    """Outer rings against the clock, holes (within an odd number of other rings) with it."""
    def turned(r: Column, k: Column) -> Column:
        p = r[0]
        crossed = lambda e: ((e["a"]["y"] > p["y"]) != (e["b"]["y"] > p["y"])) & (p["x"] < (e["b"]["x"] - e["a"]["x"]) * (p["y"] - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"])
        around = F.filter(rings, lambda other, j: (j != k) & (F.size(F.filter(pairs(other), crossed)) % 2 == 1))
        return F.when((signed_area(r) > 0) == (F.size(around) % 2 == 0), r).otherwise(F.reverse(r))

    return F.transform(rings, turned)


def rings_of(outlines: DataFrame, *keys: str) -> DataFrame:
    """``keys`` and ``rings`` of vertices ``(keys, ring, k, lon, lat)``."""
    points = F.transform(F.array_sort(F.collect_list(F.struct("k", "lon", "lat"))), lambda p: F.struct(p["lon"].alias("x"), p["lat"].alias("y")))
    each = outlines.groupBy(*keys, "ring").agg(points.alias("points"))
    rings = F.transform(F.array_sort(F.collect_list(F.struct("ring", "points"))), lambda r: r["points"])
    return each.groupBy(*keys).agg(oriented(rings).alias("rings"))


def bounds(rings: Column, axis: str) -> tuple[Column, Column]:
    values = F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p[axis])))
    return F.array_min(values), F.array_max(values)


def strips(rows: DataFrame, axis: str, size: float, origin: Column, index: str) -> DataFrame:
    """Rows cut into strips of a width along an axis, numbered from an origin; strips without area are left out."""
    at = rows.withColumns({"_o": origin, "_b": F.struct(*(b.alias(n) for n, b in zip(("lo", "hi"), bounds(F.col("rings"), axis), strict=True)))})
    first, last = F.floor((F.col("_b.lo") - F.col("_o")) / size), F.ceil((F.col("_b.hi") - F.col("_o")) / size) - 1
    each = at.withColumn(index, F.explode(F.sequence(first, F.greatest(first, last))))
    low = F.col("_o") + F.col(index) * size
    rings = F.filter(F.transform("rings", lambda r: cut(r, axis, low, low + size)), lambda r: F.size(r) > 3)
    return each.withColumn("rings", rings).where(F.size("rings") > 0).drop("_o", "_b")


def letter(letters: str, k: Column) -> Column:
    return F.substring(F.lit(letters), F.pmod(k, F.lit(len(letters))).cast("int") + 1, F.lit(1))


def production_grid(areas: DataFrame, kilometres: float) -> DataFrame:
    """Tiles of a size within the squares of 100 km of each UTM zone and band that an area ``(id, rings in degrees, ...)`` meets.

    Tiles start at the western and southern ends of the area's part of a square, are cut to it, and named
    ``<id>_<square>_<number>``. Further columns are carried. Null or repeated ids and areas without rings are errors.
    Areas beyond 80 degrees south and 84 north have no zone: what lies there is left out.
    """
    checks = areas.agg(F.count("*"), F.count("id"), F.countDistinct("id"), F.count(F.when(F.size("rings") > 0, 1))).first()
    if len(set(checks)) != 1:
        raise ValueError("areas need unique ids, none null, and rings that aren't empty")
    carried = [c for c in areas.columns if c not in ("id", "rings")]
    zones = strips(strips(areas, "x", 6.0, F.lit(-180.0), "_zone"), "y", 8.0, F.lit(-80.0), "_band").where(F.col("_band").between(0, 19))
    zone, south = F.col("_zone").cast("int") + 1, F.col("_band") < 10

    def metres(p: Column) -> Column:
        _, e, n = to_utm(p["x"], p["y"], zone, south)
        return F.struct(e.alias("x"), n.alias("y"))

    flat = zones.withColumn("rings", F.transform("rings", lambda r: F.transform(r, metres)))
    squares = strips(strips(flat, "x", SQUARE, F.lit(0.0), "_e"), "y", SQUARE, F.lit(0.0), "_n")
    west, south_end = bounds(F.col("rings"), "x")[0], bounds(F.col("rings"), "y")[0]
    started = squares.withColumns({"_west": west, "_south": south_end})
    size = kilometres * 1000.0
    tiles = strips(strips(started, "x", size, F.col("_west"), "_i"), "y", size, F.col("_south"), "_j").withColumn("area", area(F.col("rings"))).where("area > 1")
    column = F.when(zone % 3 == 0, letter(COLUMNS[0], F.col("_e") - 1)).when(zone % 3 == 1, letter(COLUMNS[1], F.col("_e") - 1)).otherwise(letter(COLUMNS[2], F.col("_e") - 1))
    row = letter(ROWS, F.col("_n") + F.when(zone % 2 == 0, 5).otherwise(0))
    tile = F.concat(F.lpad(zone.cast("string"), 2, "0"), letter(BANDS, F.col("_band")), column, row)
    number = F.row_number().over(Window.partitionBy("id", "tile").orderBy("_e", "_n", "_i", "_j")) - 1
    named = tiles.withColumn("tile", tile).withColumn("_k", number)
    name = F.concat_ws("_", F.col("id").cast("string"), "tile", F.col("_k").cast("string"))
    return named.select("id", name.alias("tile_name"), "tile", (F.when(south, 32700).otherwise(32600) + zone).cast("int").alias("epsg"), "rings", "area", *carried)


def boundary(tiles: DataFrame) -> DataFrame:
    """``(tile_name, epsg, line, a, b)``: edges by the line that they lie on, from a to b along it."""
    e = tiles.select("tile_name", "epsg", F.explode(F.flatten(F.transform("rings", pairs))).alias("e")).select("tile_name", "epsg", "e.a", "e.b")
    dx, dy = F.col("b.x") - F.col("a.x"), F.col("b.y") - F.col("a.y")
    length = F.sqrt(dx * dx + dy * dy)
    turn = F.when((dx < 0) | ((dx == 0) & (dy < 0)), -1).otherwise(1)
    e = e.withColumn("_l", length).where("_l > 0").withColumns({"ux": turn * dx / F.col("_l"), "uy": turn * dy / F.col("_l")})
    line = F.struct(F.round("ux", 7).alias("ux"), F.round("uy", 7).alias("uy"), F.round(F.col("a.x") * F.col("uy") - F.col("a.y") * F.col("ux"), 2).alias("off"))
    along = lambda p: F.col(f"{p}.x") * F.col("ux") + F.col(f"{p}.y") * F.col("uy")
    return e.select("tile_name", "epsg", line.alias("line"), F.least(along("a"), along("b")).alias("a"), F.greatest(along("a"), along("b")).alias("b"))


def merge_targets(tiles: DataFrame, least: float, gap: float) -> DataFrame:
    """``(tile_name, into)`` for tiles narrower or lower than ``least``: the tile of the zone with the longest shared edge, else the nearest within ``gap``."""
    (w, e), (s, n) = bounds(F.col("rings"), "x"), bounds(F.col("rings"), "y")
    boxed = tiles.select("tile_name", "epsg", "rings", w.alias("w"), e.alias("e"), s.alias("s"), n.alias("n"))
    narrow = boxed.where((F.col("e") - F.col("w") < least) | (F.col("n") - F.col("s") < least))
    steps = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / SQUARE), F.floor(F.col(b) / SQUARE)))
    edges = boundary(tiles).withColumn("part", steps("a", "b"))
    own = edges.join(narrow.select("tile_name"), "tile_name", "left_semi")
    other = edges.select(F.col("tile_name").alias("into"), "epsg", "line", "part", F.col("a").alias("_a"), F.col("b").alias("_b"))
    # an overlap is counted in the part of the line that it begins in
    begin, end = F.greatest("a", "_a"), F.least("b", "_b")
    met = own.join(other, ["epsg", "line", "part"]).where(F.col("tile_name") != F.col("into")).where((end > begin) & (F.floor(begin / SQUARE) == F.col("part")))
    shared = met.groupBy("tile_name", "into").agg(F.round(F.sum(end - begin), 2).alias("length")).where("length > 0")
    by_edge = shared.groupBy("tile_name").agg(F.min_by("into", F.struct(-F.col("length"), F.col("into"))).alias("into"))
    alone = narrow.join(by_edge, "tile_name", "left_anti")
    cells = lambda t: t.withColumn("_cx", steps("w", "e")).withColumn("_cy", steps("s", "n"))
    wide = cells(alone.withColumns({"w": F.col("w") - gap, "e": F.col("e") + gap, "s": F.col("s") - gap, "n": F.col("n") + gap}))
    near = cells(boxed).select("epsg", "_cx", "_cy", *(F.col(c).alias(f"_{c}") for c in ("rings", "w", "e", "s", "n")), F.col("tile_name").alias("into"))
    close = wide.join(near, ["epsg", "_cx", "_cy"]).where("tile_name <> into and w <= _e and e >= _w and s <= _n and n >= _s")
    points, lines = (lambda r: F.flatten(r)), (lambda r: F.transform(F.flatten(F.transform(r, pairs)), lambda p: F.struct(p["a"]["x"].alias("x0"), p["a"]["y"].alias("y0"), p["b"]["x"].alias("x1"), p["b"]["y"].alias("y1"))))

    def reach(of: str, to: str) -> Column:
        real = F.filter(lines(F.col(to)), lambda g: (g["x0"] != g["x1"]) | (g["y0"] != g["y1"]))
        return F.array_min(F.transform(points(F.col(of)), lambda p: F.array_min(F.transform(real, lambda g: segment_distance(p["x"], p["y"], g)))))

    far = F.round(F.least(reach("rings", "_rings"), reach("_rings", "rings")), 2)
    by_gap = close.withColumn("far", far).where(F.col("far") <= gap).groupBy("tile_name").agg(F.min_by("into", F.struct("far", "into")).alias("into"))
    return by_edge.unionByName(by_gap)


def merged(tiles: DataFrame, least: float = 100.0, gap: float = 20.0) -> DataFrame:
    """Tiles ``(tile_name, epsg, rings, area, ...)`` with the small ones merged; a merged tile keeps the name of its large one, else the first by name.

    Targets are chosen on the tiles as given; chains of small tiles are one group, closed in rounds of least names.
    The rings of a group are those of its tiles side by side, with ``n_merged`` tiles in all.
    """
    links = kept(merge_targets(tiles, least, gap), "links")
    narrow = links.select("tile_name").withColumn("_small", F.lit(True))
    both = links.unionByName(links.select(F.col("into").alias("tile_name"), F.col("tile_name").alias("into")))
    both = kept(both.join(narrow, "tile_name", "left").withColumn("label", F.struct(F.coalesce("_small", F.lit(False)).alias("small"), "tile_name")).drop("_small"), "both")
    labels = kept(both.select("tile_name", "label").distinct(), "labels")
    while True:
        said = both.drop("label").join(labels.select(F.col("tile_name").alias("into"), "label"), "into").groupBy("tile_name").agg(F.min("label").alias("said"))
        after = kept(labels.join(said, "tile_name").select("tile_name", F.least("label", "said").alias("label"), (F.col("said") < F.col("label")).alias("moved")), "labels")
        dropped(labels)
        labels = after.drop("moved")
        if after.where("moved").isEmpty():
            break
    named = tiles.join(small(labels), "tile_name", "left").withColumn("_to", F.coalesce("label.tile_name", "tile_name"))
    carried = [c for c in tiles.columns if c not in ("tile_name", "epsg", "rings", "area")]
    first = [F.min_by(c, F.struct(F.col("tile_name") != F.col("_to"), F.col("tile_name"))).alias(c) for c in carried]
    rings = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("tile_name", "rings"))), lambda t: t["rings"]))
    return named.groupBy(F.col("_to"), "epsg").agg(rings.alias("rings"), F.sum("area").alias("area"), F.count("*").alias("n_merged"), *first).withColumnRenamed("_to", "tile_name")


# queries


def _strip_sql(name: str, source: str, piece: str, axis: str, size: float, origin: str, index: str) -> str:
    """CTEs that cut the vertices of ``source`` (piece columns, ring, k, x, y) into strips: one half-plane after the other, by window functions over the vertices."""
    keys, other = f"{piece}, ring", "y" if axis == "x" else "x"
    part = f"{keys}, {index}"
    out = f"""{name}0 AS (SELECT s.*, CAST(_s AS BIGINT) AS {index}, {origin} + _s * {size!r}e0 AS lo, {origin} + _s * {size!r}e0 + {size!r}e0 AS hi FROM {source} s JOIN
      (SELECT {piece}, unnest(range(CAST(floor((min({axis}) - any_value({origin})) / {size!r}e0) AS BIGINT), CAST(greatest(floor((min({axis}) - any_value({origin})) / {size!r}e0), ceil((max({axis}) - any_value({origin})) / {size!r}e0) - 1) AS BIGINT) + 1)) AS _s FROM {source} GROUP BY {piece}) b USING ({piece}))"""
    for step, (bound, sign) in enumerate((("lo", ">="), ("hi", "<=")), 1):
        before = f"{name}{step - 1}"
        at = f"p{other} + ({other} - p{other}) * ({bound} - p{axis}) / ({axis} - p{axis})"
        w = f"(PARTITION BY {part} ORDER BY k)"
        last = f"(PARTITION BY {part} ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
        previous = ", ".join(f"coalesce(lag({c}) OVER {w}, last_value({c}) OVER {last}) AS p{c}" for c in "xy")
        carried = f"* EXCLUDE (k, x, y, px, py), k * 2 AS k, {bound} AS {axis}, {at} AS {other}"
        out += f""", {name}{step} AS (WITH e AS (SELECT *, {previous} FROM {before}) SELECT {carried} FROM e WHERE ({axis} {sign} {bound}) <> (p{axis} {sign} {bound})
          UNION ALL BY NAME SELECT * EXCLUDE (k, px, py), k * 2 + 1 AS k FROM e WHERE {axis} {sign} {bound})"""
    return out + f", {name} AS (SELECT * EXCLUDE (lo, hi, k), row_number() OVER (PARTITION BY {part} ORDER BY k) AS k FROM {name}2)"


def grid_sql(size: float) -> str:
    """CTEs up to ``g``: tile_name, tile, epsg and area of the tiles of the outlines."""
    letters = lambda text, k: f"substr('{text}', CAST(({k}) % {len(text)} AS INTEGER) + 1, 1)"
    steps = [_strip_sql("za", "v", "id", "x", 6.0, "(-180e0)", "zone"), _strip_sql("zb", "za", "id, zone", "y", 8.0, "(-80e0)", "band")]
    flat = f"u AS ({utm_sql('zone + 1', 'band < 10').format('(SELECT * EXCLUDE (x, y), x AS lon, y AS lat FROM zb WHERE band BETWEEN 0 AND 19)')})"
    flat = flat.replace("SELECT * EXCLUDE (xi, eta, t, d)", "SELECT * EXCLUDE (xi, eta, t, d, lon, lat)", 1)
    squares = [_strip_sql("sa", "u", "id, zone, band", "x", SQUARE, "0e0", "e"), _strip_sql("sb", "sa", "id, zone, band, e", "y", SQUARE, "0e0", "n")]
    started = "sc AS (SELECT *, min(x) OVER w AS west, min(y) OVER w AS south FROM sb WINDOW w AS (PARTITION BY id, zone, band, e, n))"
    tiles = [_strip_sql("ta", "sc", "id, zone, band, e, n", "x", size, "west", "i"), _strip_sql("tb", "ta", "id, zone, band, e, n, i", "y", size, "south", "j")]
    edge = "SELECT *, coalesce(lag(x) OVER w, last_value(x) OVER l) AS px, coalesce(lag(y) OVER w, last_value(y) OVER l) AS py, first_value(x) OVER w AS ox, first_value(y) OVER w AS oy FROM tb WINDOW w AS (PARTITION BY id, zone, band, e, n, i, j, ring ORDER BY k), l AS (PARTITION BY id, zone, band, e, n, i, j, ring ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    column = f"CASE (zone + 1) % 3 WHEN 0 THEN {letters(COLUMNS[0], 'e - 1')} WHEN 1 THEN {letters(COLUMNS[1], 'e - 1')} ELSE {letters(COLUMNS[2], 'e - 1')} END"
    row = letters(ROWS, "n + CASE WHEN (zone + 1) % 2 = 0 THEN 5 ELSE 0 END")
    areas = f"""r AS (SELECT id, zone, band, e, n, i, j, ring, abs(sum((px - ox) * (y - oy) - (x - ox) * (py - oy))) / 2 AS area FROM ({edge}) GROUP BY ALL),
      q AS (SELECT id, zone, band, e, n, i, j, sum(CASE WHEN ring = 1 THEN -area ELSE area END) AS area, concat(lpad(CAST(zone + 1 AS VARCHAR), 2, '0'), {letters(BANDS, 'band')}, {column}, {row}) AS tile FROM r GROUP BY ALL HAVING sum(CASE WHEN ring = 1 THEN -area ELSE area END) > 1),
      gk AS (SELECT *, concat_ws('_', id, tile, CAST(row_number() OVER (PARTITION BY id, tile ORDER BY e, n, i, j) - 1 AS VARCHAR)) AS tile_name, CAST(CASE WHEN band < 10 THEN 32700 ELSE 32600 END + zone + 1 AS INTEGER) AS epsg FROM q),
      g AS (SELECT tile_name, tile, epsg, round(area / 1e6, 3) AS km2 FROM gk)"""
    vertices = "v AS (SELECT iso3 AS id, ring, k, lon AS x, lat AS y FROM (SELECT *, max(k) OVER (PARTITION BY iso3, ring) AS last FROM estates) WHERE k < last)"
    return ", ".join([vertices, *steps, flat, *squares, started, *tiles, areas])


@query("aoi_tiling", "estates", sql=f"WITH {grid_sql(20_000.0)} SELECT * FROM g")
def aoi_tiling(estates: DataFrame) -> DataFrame:
    """Tiles of 20 km of all estates, with their area."""
    grid = production_grid(rings_of(estates, "iso3").withColumnRenamed("iso3", "id"), 20.0)
    return grid.select("tile_name", "tile", "epsg", F.round(F.col("area") / 1e6, 3).alias("km2"))


def merge_sql(size: float, least: float, gap: float) -> str:
    """CTEs up to ``mg``: the tiles merged, by comparing all edges of a zone."""
    at = "id, zone, band, e, n, i, j"
    w = f"w AS (PARTITION BY {at}, ring ORDER BY k), l AS (PARTITION BY {at}, ring ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    edges = f"ed AS (SELECT * FROM (SELECT {at}, coalesce(lag(x) OVER w, last_value(x) OVER l) AS ax, coalesce(lag(y) OVER w, last_value(y) OVER l) AS ay, x AS bx, y AS by_ FROM tb WINDOW {w}) JOIN (SELECT {at}, tile_name, epsg FROM gk) USING ({at}) WHERE ax <> bx OR ay <> by_)"
    turned = "SELECT *, sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) AS len, CASE WHEN bx < ax OR (bx = ax AND by_ < ay) THEN -1 ELSE 1 END AS turn FROM ed"
    lines = f"ln AS (SELECT tile_name, epsg, round(ux, 7) AS ru, round(uy, 7) AS rv, round(ax * uy - ay * ux, 2) AS off, least(ax * ux + ay * uy, bx * ux + by_ * uy) AS a, greatest(ax * ux + ay * uy, bx * ux + by_ * uy) AS b FROM (SELECT *, turn * (bx - ax) / len AS ux, turn * (by_ - ay) / len AS uy FROM ({turned})))"

    def reach(point: str, line: str) -> str:
        t = f"least(greatest((({point}.ax - {line}.ax) * ({line}.bx - {line}.ax) + ({point}.ay - {line}.ay) * ({line}.by_ - {line}.ay)) / (({line}.bx - {line}.ax) ** 2 + ({line}.by_ - {line}.ay) ** 2), 0), 1)"
        return f"sqrt(({point}.ax - {line}.ax - {t} * ({line}.bx - {line}.ax)) ** 2 + ({point}.ay - {line}.ay - {t} * ({line}.by_ - {line}.ay)) ** 2)"

    rounds = ["lb0 AS (SELECT tile_name, CASE WHEN tile_name IN (SELECT tile_name FROM lk) THEN '1' ELSE '0' END || tile_name AS label FROM (SELECT tile_name FROM lk UNION SELECT goes FROM lk))", "nb AS (SELECT tile_name, goes AS other FROM lk UNION SELECT goes, tile_name FROM lk)"]
    rounds += [f"lb{k} AS (SELECT o.tile_name, least(o.label, min(p.label)) AS label FROM lb{k - 1} o JOIN nb USING (tile_name) JOIN lb{k - 1} p ON p.tile_name = nb.other GROUP BY o.tile_name, o.label)" for k in range(1, 13)]
    return ", ".join([
        grid_sql(size), edges, lines,
        "bx AS (SELECT tile_name, any_value(epsg) AS epsg, min(ax) AS w, max(ax) AS e_, min(ay) AS s, max(ay) AS n_ FROM ed GROUP BY tile_name)",
        f"sm AS (SELECT * FROM bx WHERE e_ - w < {least!r}e0 OR n_ - s < {least!r}e0)",
        "sh AS (SELECT o.tile_name, p.tile_name AS goes, round(sum(least(o.b, p.b) - greatest(o.a, p.a)), 2) AS len FROM ln o JOIN ln p ON o.epsg = p.epsg AND o.ru = p.ru AND o.rv = p.rv AND o.off = p.off AND o.tile_name <> p.tile_name AND least(o.b, p.b) > greatest(o.a, p.a) WHERE o.tile_name IN (SELECT tile_name FROM sm) GROUP BY 1, 2)",
        "be AS (SELECT tile_name, arg_min(goes, {'l': -len, 'g': goes}) AS goes FROM sh WHERE len > 0 GROUP BY tile_name)",
        f"cl AS (SELECT o.tile_name, p.tile_name AS goes FROM sm o JOIN bx p ON o.epsg = p.epsg AND o.tile_name <> p.tile_name AND o.w - {gap!r}e0 <= p.e_ AND o.e_ + {gap!r}e0 >= p.w AND o.s - {gap!r}e0 <= p.n_ AND o.n_ + {gap!r}e0 >= p.s WHERE o.tile_name NOT IN (SELECT tile_name FROM be))",
        f"fr AS (SELECT cl.tile_name, goes, round(min(least({reach('u', 'v')}, {reach('v', 'u')})), 2) AS far FROM cl JOIN ed u ON u.tile_name = cl.tile_name JOIN ed v ON v.tile_name = goes GROUP BY 1, 2)",
        f"lk AS (SELECT * FROM be UNION ALL SELECT tile_name, arg_min(goes, {{'f': far, 'g': goes}}) FROM fr WHERE far <= {gap!r}e0 GROUP BY tile_name)",
        *rounds,
        "mg AS (SELECT coalesce(substr(label, 2), tile_name) AS tile_name, epsg, round(sum(area) / 1e6, 3) AS km2, count(*) AS n_merged FROM gk LEFT JOIN lb12 USING (tile_name) GROUP BY 1, 2)",
    ])


@query("merge_small_tiles", "estates", sql=f"WITH {merge_sql(20_000.0, 5_000.0, 20.0)} SELECT * FROM mg")
def merge_small_tiles(estates: DataFrame) -> DataFrame:
    """The tiles of 20 km with those under 5 km wide or high merged into neighbours."""
    grid = production_grid(rings_of(estates, "iso3").withColumnRenamed("iso3", "id"), 20.0)
    return merged(kept(grid, "grid"), 5_000.0, 20.0).select("tile_name", "epsg", F.round(F.col("area") / 1e6, 3).alias("km2"), "n_merged")
