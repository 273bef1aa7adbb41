"""Coordinates, grids and tiles in closed form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrispark.registry import query

RADIUS = 6378137.0
#: WGS84 flattening and the scale of UTM (fixed values).
FLATTENING, SCALE = 1 / 298.257223563, 0.9996


def to_web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lon) * RADIUS, F.ln(F.tan(F.radians(lat) / 2 + F.pi() / 4)) * RADIUS


def from_web_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / RADIUS), F.degrees(2 * F.atan(F.exp(y / RADIUS)) - F.pi() / 2)


@query("web_mercator", "samples", sql="SELECT sample_id, round(radians(lon) * 6378137, 3) AS x, round(ln(tan(radians(lat) / 2 + pi() / 4)) * 6378137, 3) AS y FROM samples")
def web_mercator(samples: DataFrame) -> DataFrame:
    x, y = to_web_mercator(F.col("lon"), F.col("lat"))
    return samples.select("sample_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("bbox_buffer", "samples", sql="""WITH m AS (SELECT sample_id, radians(lon) * 6378137 AS x, ln(tan(radians(lat) / 2 + pi() / 4)) * 6378137 AS y FROM samples)
  SELECT sample_id, round(degrees((x - 250000) / 6378137), 6) AS w, round(degrees((x + 250000) / 6378137), 6) AS e, round(degrees(2 * atan(exp((y - 250000) / 6378137)) - pi() / 2), 6) AS s, round(degrees(2 * atan(exp((y + 250000) / 6378137)) - pi() / 2), 6) AS n FROM m""")
def bbox_buffer(samples: DataFrame, metres: float = 250000.0) -> DataFrame:
    """Box of a square buffer in web Mercator."""
    x, y = to_web_mercator(F.col("lon"), F.col("lat"))
    w, s = from_web_mercator(x - metres, y - metres)
    e, n = from_web_mercator(x + metres, y + metres)
    return samples.select("sample_id", *(F.round(v, 6).alias(k) for k, v in {"w": w, "e": e, "s": s, "n": n}.items()))


def to_utm(lon: Column, lat: Column, zone: Column | None = None, south: Column | None = None) -> tuple[Column, Column, Column]:
    """(epsg, easting, northing) by the third-order Krueger series, in the point's own zone and half of the globe unless given."""
    n = FLATTENING / (2 - FLATTENING)
    a = RADIUS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    zone = F.floor((lon + 180) / 6) + 1 if zone is None else zone
    k = 2 * n**0.5 / (1 + n)
    sin = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(sin) - k * F.atanh(k * sin))
    d = F.radians(lon - (zone * 6 - 183))
    xi, eta = F.atan2(t, F.cos(d)), F.atanh(F.sin(d) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, c in enumerate(alpha, 1):
        east = east + c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    south = lat < 0 if south is None else south
    return (
        (F.when(south, 32700).otherwise(32600) + zone).cast("int"), 500000 + SCALE * a * east,
        SCALE * a * north + F.when(south, 10000000.0).otherwise(0.0),
    )


def utm_sql(zone: str, south: str) -> str:
    """SQL with a place for a table of (lon, lat, ...): easting x and northing y by the same series."""
    n = FLATTENING / (2 - FLATTENING)
    a = RADIUS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    k = 2 * n**0.5 / (1 + n)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    number = lambda v: repr(v) if "e" in repr(v) else f"{v!r}e0"
    east = "eta" + "".join(f" + {number(c)} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, c in enumerate(alpha, 1))
    north = "xi" + "".join(f" + {number(c)} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, c in enumerate(alpha, 1))
    t = f"sinh(atanh(sin(radians(lat))) - {number(k)} * atanh({number(k)} * sin(radians(lat))))"
    return f"""SELECT * EXCLUDE (xi, eta, t, d), 500000e0 + {number(SCALE * a)} * ({east}) AS x, {number(SCALE * a)} * ({north}) + CASE WHEN {south} THEN 10000000e0 ELSE 0e0 END AS y FROM
      (SELECT *, atan2(t, cos(d)) AS xi, atanh(sin(d) / sqrt(1 + t * t)) AS eta FROM (SELECT *, {t} AS t, radians(lon - (({zone}) * 6 - 183)) AS d FROM {{0}}))"""


_ZONED = utm_sql("CAST(floor((lon + 180) / 6) AS INTEGER) + 1", "lat < 0").format("samples")


@query("utm_projection", "samples", sql=f"SELECT sample_id, CASE WHEN lat < 0 THEN 32700 ELSE 32600 END + CAST(floor((lon + 180) / 6) AS INTEGER) + 1 AS epsg, round(x, 3) AS easting, round(y, 3) AS northing FROM ({_ZONED})")
def utm_projection(samples: DataFrame) -> DataFrame:
    epsg, e, n = to_utm(F.col("lon"), F.col("lat"))
    return samples.select("sample_id", epsg.alias("epsg"), F.round(e, 3).alias("easting"), F.round(n, 3).alias("northing"))


@query("mgrs_to_epsg", "samples", sql="""WITH t AS (SELECT sample_id, concat(lpad(CAST(CAST(quality_ct AS INTEGER) * 13 % 70 AS VARCHAR), 2, '0'), CASE WHEN lat >= 0 THEN 'T' ELSE 'H' END, 'XX') AS tile FROM samples)
  SELECT sample_id, CASE WHEN CAST(substr(tile, 1, 2) AS INTEGER) BETWEEN 1 AND 60 THEN CASE WHEN substr(tile, 3, 1) >= 'N' THEN 32600 ELSE 32700 END + CAST(substr(tile, 1, 2) AS INTEGER) END AS epsg FROM t""")
def mgrs_to_epsg(samples: DataFrame) -> DataFrame:
    """EPSG code of a grid tile: zone digits and latitude letter; invalid tiles give null."""
    number = F.lpad((F.col("quality_ct").cast("int") * 13 % 70).cast("string"), 2, "0")
    tiles = samples.select("sample_id", F.concat(number, F.when(F.col("lat") >= 0, "T").otherwise("H"), F.lit("XX")).alias("tile"))
    zone = F.nullif(F.regexp_extract("tile", "^([0-9]{2})[C-HJ-NP-X]", 1), F.lit("")).cast("int")
    north = F.substring("tile", 3, 1) >= "N"
    return tiles.select("sample_id", F.when(zone.between(1, 60), F.when(north, 32600).otherwise(32700) + zone).alias("epsg"))


def ring_of(regions: DataFrame) -> DataFrame:
    """Each rectangle as a closed ring with one corner cut."""
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    w, e, s, n = (F.col(c) for c in "wesn")
    points = [corner(w, s), corner(e, s), corner(e, (s + n) / 2), corner((w + e) / 2, n), corner(w, n), corner(w, s)]
    return regions.withColumn("ring", F.array(*points))


def ring_centroid(ring: Column) -> tuple[Column, Column, Column]:
    """(area, x, y) of a closed ring by the shoelace formula."""
    pairs = F.zip_with(F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    cross = lambda p: p["a"]["x"] * p["b"]["y"] - p["b"]["x"] * p["a"]["y"]
    total = lambda f: F.aggregate(F.transform(pairs, f), F.lit(0.0), lambda t, v: t + v)
    area = total(cross) / 2
    return area, total(lambda p: (p["a"]["x"] + p["b"]["x"]) * cross(p)) / (6 * area), total(lambda p: (p["a"]["y"] + p["b"]["y"]) * cross(p)) / (6 * area)


def in_ring(ring: Column, x: Column, y: Column) -> Column:
    """Whether a point is inside a closed ring: an odd number of edges crossed by a ray to the right."""
    pairs = F.zip_with(F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    def crossed(p):
        a, b = p["a"], p["b"]
        return ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]) + a["x"])
    return F.size(F.filter(pairs, crossed)) % 2 == 1


@query("polygon_to_point", "regions", sql="""WITH v AS (SELECT iso3, unnest([1, 2, 3, 4, 5]) AS k, unnest([w, e, e, (w + e) / 2, w]) AS x0, unnest([s, s, (s + n) / 2, n, n]) AS y0,
    unnest([e, e, (w + e) / 2, w, w]) AS x1, unnest([s, (s + n) / 2, n, n, s]) AS y1 FROM regions)
  SELECT iso3, round(sum((x0 + x1) * (x0 * y1 - x1 * y0)) / (3 * sum(x0 * y1 - x1 * y0)), 4) AS lon, round(sum((y0 + y1) * (x0 * y1 - x1 * y0)) / (3 * sum(x0 * y1 - x1 * y0)), 4) AS lat FROM v GROUP BY iso3""")
def polygon_to_point(regions: DataFrame) -> DataFrame:
    """Centroids of the polygons that hold their own."""
    r = ring_of(regions)
    _, x, y = ring_centroid(F.col("ring"))
    p = r.withColumn("lon", x).withColumn("lat", y)
    return p.where(in_ring(F.col("ring"), F.col("lon"), F.col("lat"))).select("iso3", F.round("lon", 4).alias("lon"), F.round("lat", 4).alias("lat"))


@query("snap_square_buffer", "samples", sql="SELECT sample_id, round(x / 20) * 20 - 160 AS x0, round(x / 20) * 20 + 160 AS x1 FROM (SELECT sample_id, round(lon * 1000) AS x FROM samples)")
def snap_square_buffer(samples: DataFrame) -> DataFrame:
    x = F.round(F.round(F.col("lon") * 1000) / 20) * 20
    return samples.select("sample_id", (x - 160).alias("x0"), (x + 160).alias("x1"))


@query("lat_lon_bins", "samples", sql="SELECT sample_id, concat_ws('_', CAST(floor((lat + 90) / 0.25e0) AS BIGINT), CAST(floor((lon + 180) / 0.25e0) AS BIGINT)) AS bin FROM samples")
def lat_lon_bins(samples: DataFrame, size: float = 0.25) -> DataFrame:
    return samples.select("sample_id", F.concat_ws("_", F.floor((F.col("lat") + 90) / size).cast("string"), F.floor((F.col("lon") + 180) / size).cast("string")).alias("bin"))


def tiles(areas: DataFrame, size: float) -> DataFrame:
    """Squares of a size that meet each area, clipped to it, numbered by row and column."""
    n = lambda a, b: F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.col(b) - F.col(a)) / size).cast("int") - 1))
    cut = areas.withColumn("i", F.explode(n("w", "e"))).withColumn("j", F.explode(n("s", "n")))
    return cut.select(
        "iso3", F.concat_ws("_", "iso3", F.col("j").cast("string"), F.col("i").cast("string")).alias("tile_name"),
        (F.col("w") + F.col("i") * size).alias("x0"), F.least(F.col("w") + (F.col("i") + 1) * size, F.col("e")).alias("x1"),
        (F.col("s") + F.col("j") * size).alias("y0"), F.least(F.col("s") + (F.col("j") + 1) * size, F.col("n")).alias("y1"),
    )


TILES_SQL = "t AS (SELECT iso3, concat(iso3, '_', CAST(j AS INTEGER), '_', CAST(i AS INTEGER)) AS tile_name, w + i * 7 AS x0, least(w + (i + 1) * 7, e) AS x1, s + j * 7 AS y0, least(s + (j + 1) * 7, n) AS y1 FROM regions, range(0, 9) a(i), range(0, 3) b(j))"


@query("ensure_utm_grid", "regions", sql=f"WITH {TILES_SQL} SELECT tile_name, CASE WHEN (y0 + y1) / 2 < 0 THEN 32700 ELSE 32600 END + CAST(floor(((x0 + x1) / 2 + 180) / 6) AS INTEGER) + 1 AS epsg, count(*) OVER (PARTITION BY tile_name) = 1 AS ok FROM t")
def ensure_utm_grid(regions: DataFrame) -> DataFrame:
    """EPSG of each tile's centre, and whether its name is given and unique."""
    t = tiles(regions, 7.0)
    epsg, _, _ = to_utm((F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2)
    ok = (F.count("*").over(Window.partitionBy("tile_name")) == 1) & F.col("tile_name").isNotNull()
    return t.select("tile_name", epsg.alias("epsg"), ok.alias("ok"))


@query("gdf_bbox", "regions", sql="SELECT iso3, w, e, s, n FROM regions")
def gdf_bbox(regions: DataFrame) -> DataFrame:
    xs, ys = F.transform(F.col("ring"), lambda p: p["x"]), F.transform(F.col("ring"), lambda p: p["y"])
    return ring_of(regions).select("iso3", F.array_min(xs).alias("w"), F.array_max(xs).alias("e"), F.array_min(ys).alias("s"), F.array_max(ys).alias("n"))


@query("prepare_grid", "regions", sql="""SELECT tile_name, parts, parts = 1 AS ok, count(*) OVER (PARTITION BY tile_name) > 1 AS repeated
  FROM (SELECT substr(iso3, 1, 2) AS tile_name, 1 AS parts FROM regions UNION ALL SELECT region, CAST(count(*) AS INTEGER) FROM regions GROUP BY region)""")
def q_prepare_grid(regions: DataFrame) -> DataFrame:
    """Countries as polygons and world regions as multi-polygons of them."""
    rings = ring_of(regions)
    single = rings.select(F.substring("iso3", 1, 2).alias("tile_name"), F.array("ring").alias("rings"))
    several = rings.groupBy(F.col("region").alias("tile_name")).agg(F.collect_list("ring").alias("rings"))
    return prepare_grid(single.unionByName(several)).drop("rings")


def prepare_grid(grid: DataFrame) -> DataFrame:
    """Rows (tile_name, rings) with the number of parts, whether there is just one (multi-polygons of one part are polygons), and repeated names."""
    return grid.withColumn("parts", F.size("rings")).withColumn("ok", (F.col("parts") == 1) & F.col("tile_name").isNotNull()).withColumn(
        "repeated", F.count("*").over(Window.partitionBy("tile_name")) > 1
    )


@query("validate_spatial_extent", "collections", sql="SELECT ref_id, w >= -180 AND e <= 180 AND s >= -90 AND n <= 90 AND w < e AND s < n AS ok FROM collections")
def validate_spatial_extent(collections: DataFrame) -> DataFrame:
    return collections.select("ref_id", F.expr("w >= -180 AND e <= 180 AND s >= -90 AND n <= 90 AND w < e AND s < n").alias("ok"))


@query("orbit_choice", "pixels", sql="SELECT tile, orbit, area FROM (SELECT tile, CASE WHEN scl % 2 = 0 THEN 'ascending' ELSE 'descending' END AS orbit, count(*) AS area FROM pixels WHERE label > 0 GROUP BY ALL) WHERE area > 0")
def orbit_choice(pixels: DataFrame) -> DataFrame:
    """One unit for each orbit direction with coverage."""
    orbit = F.when(F.col("scl") % 2 == 0, "ascending").otherwise("descending").alias("orbit")
    return pixels.where("label > 0").groupBy("tile", orbit).agg(F.count("*").alias("area")).where("area > 0")
