"""Rasters as rows (tile, y, x, value). Neighbourhoods are offset joins that start from pre-aggregated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrispark.functions.bands import NODATA, NON_CROP, POSTPROCESS_NODATA, linear_scale
from agrispark.functions.dates import align_to_composite
from agrispark.registry import query
from agrispark.storage import small

PIXEL = ["tile", "y", "x"]
INVALID_SCL = (0, 1, 3, 8, 9, 10, 11)


def sized(pixels: DataFrame) -> DataFrame:
    """Pixels with the height and width of their tile, which its last row and column give; a table of one row a tile is joined."""
    sizes = pixels.groupBy("tile").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"))
    return pixels.join(sizes, "tile")


def mirrored(i: Column, size: Column) -> Column:
    """Index reflected at the edges (the edge itself repeats)."""
    return F.when(i < 0, -i - 1).when(i >= size, 2 * size - 1 - i).otherwise(i)


def neighbours(df: DataFrame, reach: int, value: list[str], keep: Column | None = None) -> DataFrame:
    """(tile, y, x, dy, dx, values) of each pixel's neighbours within a square, as rows sent from the neighbours."""
    offsets = F.sequence(F.lit(-reach), F.lit(reach))
    rows = df.select(*PIXEL, *value).withColumn("dy", F.explode(offsets)).withColumn("dx", F.explode(offsets))
    if keep is not None:
        rows = rows.where(keep)
    return rows.select("tile", (F.col("y") - F.col("dy")).alias("y"), (F.col("x") - F.col("dx")).alias("x"), "dy", "dx", *value)


@query("scene_filter", "obs_raw", sql="SELECT sample_id, ts, seq, line FROM obs_raw WHERE b02 <= 45 AND vv % 2 = 0 AND ts BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'")
def scene_filter(scenes: DataFrame, cloud: int = 45, period=("1997-01-01", "1999-12-31")) -> DataFrame:
    """Scenes by cloud cover, orbit and period; every test can be pushed to the scan."""
    a, b = (F.to_date(F.lit(p)) for p in period)
    return scenes.where((F.col("b02") <= cloud) & (F.col("vv") % 2 == 0) & F.col("ts").between(a, b)).select("sample_id", "ts", "seq", "line")


@query("spatial_filter", "pixels", sql="SELECT tile, y, x, label FROM pixels WHERE x BETWEEN 4 AND 20 AND y BETWEEN 8 AND 30")
def spatial_filter(pixels: DataFrame) -> DataFrame:
    return pixels.where(F.col("x").between(4, 20) & F.col("y").between(8, 30)).select(*PIXEL, "label")


@query("composite", "obs_raw", sql="SELECT sample_id, CAST(date_trunc('month', ts) AS DATE) AS ts, median(b04) AS b04, round(avg(vv), 6) AS vv FROM obs_raw GROUP BY 1, 2")
def composite(raw: DataFrame) -> DataFrame:
    """Median of optical and mean of radar values by month."""
    return raw.groupBy("sample_id", align_to_composite(F.col("ts")).alias("ts")).agg(F.median("b04").alias("b04"), F.round(F.avg("vv"), 6).alias("vv"))


@query("scl_mask", "pixels", sql="SELECT tile, y, x, scl IN (0, 1, 3, 8, 9, 10, 11) AS masked, CASE WHEN scl NOT IN (0, 1, 3, 8, 9, 10, 11) THEN label END AS label FROM pixels")
def scl_mask(pixels: DataFrame) -> DataFrame:
    bad = F.col("scl").isin(*INVALID_SCL)
    return pixels.select(*PIXEL, bad.alias("masked"), F.when(~bad, F.col("label")).alias("label"))


def covered(pixels: DataFrame, sources: DataFrame, radius: int) -> DataFrame:
    """``pixels`` with ``covered``: whether a source lies in the disk about each.

    Sources become runs along their rows; a run reaches the rows within the radius as an interval, wider by half the
    disk there. A pixel is covered where more intervals have begun than ended, one running sum along its row. So a run
    sends 2 * radius + 1 rows, whatever its length, and nothing is joined.
    """
    row = Window.partitionBy("tile", "y").orderBy("x")
    runs = sources.select(*PIXEL).withColumn("run", F.col("x") - F.row_number().over(row)).groupBy("tile", "y", "run").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    half = F.floor(F.sqrt(F.lit(radius**2) - F.col("dy") ** 2))
    sent = runs.withColumn("dy", F.explode(F.sequence(F.lit(-radius), F.lit(radius)))).select("tile", (F.col("y") + F.col("dy")).alias("y"), (F.col("a") - half).alias("a"), (F.col("b") + half + 1).alias("b"))
    kind = pixels.schema["x"].dataType
    ends = sent.select("tile", "y", F.inline(F.array(*(F.struct(F.col(c).cast(kind).alias("x"), F.lit(k).alias("step")) for c, k in (("a", 1), ("b", -1))))))
    both = pixels.withColumn("step", F.lit(None).cast("int")).unionByName(ends, allowMissingColumns=True)
    open_ = F.coalesce(F.sum("step").over(row.rangeBetween(Window.unboundedPreceding, 0)), F.lit(0))
    return both.withColumn("covered", open_ > 0).where("step is null").drop("step")


def eroded(pixels: DataFrame, radius: int, masked=INVALID_SCL) -> DataFrame:
    """Masked pixels all of whose disk is masked: those that no clear pixel reaches; outside the raster counts as masked."""
    bad = F.coalesce(F.col("scl").isin(*masked), F.lit(False))
    marked = covered(pixels.select(*PIXEL, bad.alias("bad")), pixels.where(~bad), radius)
    return marked.where(F.col("bad") & ~F.col("covered")).select(*PIXEL)


#: A cloud a tile over the given classes.
_CLOUDS = "clouds AS (SELECT tile, y, x, CASE WHEN (x - 8 - 4 * tile) * (x - 8 - 4 * tile) + (y - 12) * (y - 12) <= 30 + 10 * tile THEN 9 ELSE scl END AS scl FROM pixels)"


def clouds(pixels: DataFrame) -> DataFrame:
    inside = (F.col("x") - 8 - 4 * F.col("tile")) ** 2 + (F.col("y") - 12) ** 2 <= 30 + 10 * F.col("tile")
    return pixels.select(*PIXEL, F.when(inside, 9).otherwise(F.col("scl")).alias("scl"))


def _core(bad: str) -> str:
    return f"""{_CLOUDS}, bad AS (SELECT * FROM clouds WHERE scl IN ({bad})), clear AS (SELECT * FROM clouds WHERE scl NOT IN ({bad})),
  core AS (SELECT b.tile, b.y, b.x FROM bad b WHERE NOT EXISTS (SELECT 1 FROM clear c WHERE c.tile = b.tile AND (c.y - b.y) * (c.y - b.y) + (c.x - b.x) * (c.x - b.x) <= 9))"""


@query("scl_erode_dilate", "pixels", sql=f"""WITH {_core('0, 1, 3, 8, 9, 10, 11')}
  SELECT p.tile, p.y, p.x, EXISTS (SELECT 1 FROM core c WHERE c.tile = p.tile AND (c.y - p.y) * (c.y - p.y) + (c.x - p.x) * (c.x - p.x) <= 169) AS masked FROM clouds p""")
def q_scl_erode_dilate(pixels: DataFrame) -> DataFrame:
    return scl_erode_dilate(clouds(pixels))


def scl_erode_dilate(pixels: DataFrame, erode: int = 3, dilate: int = 13) -> DataFrame:
    """The mask eroded by one disk and dilated by another."""
    return covered(pixels.select(*PIXEL), eroded(pixels, erode), dilate).withColumnRenamed("covered", "masked")


@query("distance_to_mask", "pixels", sql=f"""WITH {_core('3, 8, 9, 10')}, d AS (SELECT p.tile, p.y, p.x, min(greatest(abs(b.y - p.y), abs(b.x - p.x))) AS distance FROM clouds p JOIN core b ON b.tile = p.tile WHERE greatest(abs(b.y - p.y), abs(b.x - p.x)) <= 16 GROUP BY ALL)
  SELECT p.tile, p.y, p.x, CAST(coalesce(distance, 17) AS INTEGER) AS distance FROM clouds p LEFT JOIN d USING (tile, y, x)""")
def q_distance_to_mask(pixels: DataFrame) -> DataFrame:
    return distance_to_mask(clouds(pixels))


def distance_to_mask(pixels: DataFrame, most: int = 16, erode: int = 3, masked=(3, 8, 9, 10)) -> DataFrame:
    """Chessboard distance to the nearest pixel of the eroded clouds and shadows, up to a radius (beyond it: radius + 1).

    Along rows first and then along columns, with the least distance kept between: 2 * most + 1 rows a pixel twice, not once squared.
    """
    steps = F.explode(F.sequence(F.lit(-most), F.lit(most)))
    along = eroded(pixels, erode, masked).withColumn("s", steps).groupBy("tile", "y", (F.col("x") + F.col("s")).alias("x")).agg(F.min(F.abs("s")).alias("d"))
    near = along.withColumn("s", steps).groupBy("tile", (F.col("y") + F.col("s")).alias("y"), "x").agg(F.min(F.greatest(F.abs("s"), F.col("d"))).alias("d"))
    return pixels.select(*PIXEL).join(near, PIXEL, "left").select(*PIXEL, F.coalesce("d", F.lit(most + 1)).alias("distance"))


@query("clamp_scale", "pixels", sql="SELECT tile, y, x, round((least(greatest(prob, 0.1e0), 0.8e0) - 0.1e0) / 0.7e0 * 254 + 1, 6) AS scaled FROM pixels")
def clamp_scale(pixels: DataFrame) -> DataFrame:
    return pixels.select(*PIXEL, F.round(linear_scale(F.col("prob"), 0.1, 0.8, 1.0, 255.0), 6).alias("scaled"))


@query("resample_join", "pixels", sql="""WITH c AS (SELECT tile, y // 2 AS y, x // 2 AS x, avg(prob) AS coarse FROM pixels GROUP BY ALL) SELECT p.tile, p.y, p.x, round(c.coarse, 6) AS coarse FROM pixels p JOIN c ON c.tile = p.tile AND c.y = p.y // 2 AND c.x = p.x // 2""")
def resample_join(pixels: DataFrame, factor: int = 2) -> DataFrame:
    """Block means, joined back to the fine grid by the nearest block."""
    block = [F.col("tile"), F.floor(F.col("y") / factor).alias("by"), F.floor(F.col("x") / factor).alias("bx")]
    coarse = pixels.groupBy(*block).agg(F.round(F.avg("prob"), 6).alias("coarse"))
    return pixels.select(*PIXEL, *block[1:]).join(coarse, ["tile", "by", "bx"]).select(*PIXEL, "coarse")


@query("point_extract", "pixels", sql="SELECT p.tile, p.y, p.x, round(avg(q.prob), 6) AS mean FROM pixels p JOIN pixels q ON q.tile = p.tile AND abs(q.y - p.y) <= 1 AND abs(q.x - p.x) <= 1 WHERE p.label = 3 AND p.x % 8 = 0 GROUP BY p.tile, p.y, p.x")
def point_extract(pixels: DataFrame) -> DataFrame:
    """Mean of the pixels round each point: the points are sent to the places about them, the pixels stay."""
    points = pixels.where("label = 3 and x % 8 = 0").select(*PIXEL)
    around = lambda c: F.explode(F.sequence(F.col(c) - 1, F.col(c) + 1)).alias(c)
    sent = points.select("tile", F.col("y").alias("py"), F.col("x").alias("px"), "x", around("y")).select("tile", "py", "px", "y", around("x"))
    means = pixels.join(small(sent), PIXEL).groupBy("tile", "py", "px").agg(F.round(F.avg("prob"), 6).alias("mean"))
    return means.select("tile", F.col("py").alias("y"), F.col("px").alias("x"), "mean")


@query("zonal_stats", "pixels", sql="""SELECT tile, label AS zone, round(avg(nullif(scl, 7)), 6) AS mean, sum(nullif(scl, 7)) AS total, count(nullif(scl, 7)) AS n, round(stddev_pop(nullif(scl, 7)), 6) AS std, min(nullif(scl, 7)) AS low, max(nullif(scl, 7)) AS high FROM pixels GROUP BY tile, label""")
def zonal_stats(pixels: DataFrame, nodata: int = 7) -> DataFrame:
    v = F.nullif("scl", F.lit(nodata))
    stats = {"mean": F.round(F.avg(v), 6), "total": F.sum(v), "n": F.count(v), "std": F.round(F.stddev_pop(v), 6), "low": F.min(v), "high": F.max(v)}
    return pixels.groupBy("tile", F.col("label").alias("zone")).agg(*(c.alias(n) for n, c in stats.items()))


def votes(pixels: DataFrame, reach: int, weight: Column, excluded: int | None) -> DataFrame:
    """Votes of each label in each pixel's square, edges mirrored: a pixel sends a row for each place that sees it.

    A place off the grid stands for the pixel it mirrors, so pixels near an edge vote again through it.
    """
    offsets = F.sequence(F.lit(-reach), F.lit(reach))

    def seen(c: str, size: str) -> Column:
        # centres p whose window, mirrored, meets this pixel, with repeats
        inside = lambda p: (p >= 0) & (p < F.col(size))
        near = F.filter(F.transform(offsets, lambda d: F.col(c) + d), inside)
        low = F.filter(F.transform(offsets, lambda d: -F.col(c) - 1 + d), inside)
        high = F.filter(F.transform(offsets, lambda d: 2 * F.col(size) - 1 - F.col(c) + d), inside)
        return F.concat(near, low, high)

    whole = sized(pixels).withColumn("votes", weight)
    voters = whole if excluded is None else whole.where(F.col("label") != excluded)
    rows = voters.select("tile", F.explode(seen("y", "h")).alias("cy"), "x", "w", "label", "votes")
    by_row = rows.groupBy("tile", "cy", "x", "w", "label").agg(F.sum("votes").alias("votes"))  # summed by column of the square before it spreads
    spread = by_row.select("tile", F.col("cy").alias("y"), F.explode(seen("x", "w")).alias("cx"), "label", F.col("votes").alias("w"))
    return spread.groupBy("tile", "y", F.col("cx").alias("x"), "label").agg(F.sum("w").alias("w"))


_MIRROR = "CASE WHEN {i} < 0 THEN -{i} - 1 WHEN {i} >= {n} THEN 2 * {n} - 1 - {i} ELSE {i} END"
#: Tiles of different extents.
_CUT = "raster AS (SELECT * FROM rasters), size AS (SELECT tile, max(y) + 1 AS h, max(x) + 1 AS w FROM raster GROUP BY tile)"
_NEAR = f"""SELECT p.tile, p.y, p.x, p.label, dy, dx, {_MIRROR.format(i='(p.y + dy)', n='h')} AS ny, {_MIRROR.format(i='(p.x + dx)', n='w')} AS nx FROM raster p JOIN size USING (tile), range(-1, 2) a(dy), range(-1, 2) b(dx)"""


_FILL = """SELECT p.tile, p.y, p.x, coalesce(p.v, a.v, b.v, c.v, d.v) AS v FROM {t} p LEFT JOIN {t} a ON a.tile = p.tile AND a.y = p.y AND a.x = p.x - 1 LEFT JOIN {t} b ON b.tile = p.tile AND b.y = p.y AND b.x = p.x + 1
  LEFT JOIN {t} c ON c.tile = p.tile AND c.y = p.y - 1 AND c.x = p.x LEFT JOIN {t} d ON d.tile = p.tile AND d.y = p.y + 1 AND d.x = p.x"""
_SLOPE = f"""WITH {_CUT}, d0 AS (SELECT tile, y, x, CASE WHEN scl <> 2 THEN floor(prob * 200) END AS v FROM raster), d1 AS ({_FILL.format(t='d0')}), d2 AS ({_FILL.format(t='d1')}),
  py AS (SELECT * FROM d2 UNION ALL SELECT d2.tile, h, x, v FROM d2 JOIN size USING (tile) WHERE h % 2 = 1 AND y = h - 2), px AS (SELECT * FROM py UNION ALL SELECT py.tile, y, w, v FROM py JOIN size USING (tile) WHERE w % 2 = 1 AND x = w - 2),
  bl AS (SELECT tile, y // 2 AS y, x // 2 AS x, avg(v) AS v FROM px GROUP BY ALL), bs AS (SELECT tile, (h + 1) // 2 AS h, (w + 1) // 2 AS w FROM size),
  nb AS (SELECT p.tile, p.y, p.x, dy, dx, {_MIRROR.format(i='(p.y + dy)', n='h')} AS ny, {_MIRROR.format(i='(p.x + dx)', n='w')} AS nx FROM bl p JOIN bs USING (tile), range(-1, 2) a(dy), range(-1, 2) b(dx)),
  g AS (SELECT nb.tile, nb.y, nb.x, sum(q.v * dx * (2 - abs(dy))) / 160 AS gx, sum(q.v * dy * (2 - abs(dx))) / 160 AS gy FROM nb JOIN bl q ON q.tile = nb.tile AND q.y = ny AND q.x = nx WHERE q.v IS NOT NULL GROUP BY nb.tile, nb.y, nb.x HAVING count(*) = 9),
  s AS (SELECT tile, y, x, degrees(atan(sqrt(gx * gx + gy * gy))) AS s FROM g), f AS (SELECT d0.*, y * (h - 1e0) / (2 * h - 1) AS fy, x * (w - 1e0) / (2 * w - 1) AS fx FROM d0 JOIN bs USING (tile)),
  k AS (SELECT f.*, floor(fy) + i AS ky, floor(fx) + j AS kx, (CASE WHEN i = 0 THEN 1 - (fy - floor(fy)) ELSE fy - floor(fy) END) * (CASE WHEN j = 0 THEN 1 - (fx - floor(fx)) ELSE fx - floor(fx) END) AS k FROM f, range(0, 2) a(i), range(0, 2) b(j))
  SELECT k.tile, k.y, k.x, CAST(CASE WHEN bool_or(k.v IS NULL) OR count(s.s) < count(*) THEN 65535 ELSE floor(round(sum(k.k * s.s), 6)) END AS INTEGER) AS slope FROM k LEFT JOIN s ON s.tile = k.tile AND s.y = ky AND s.x = kx WHERE k.k > 1e-9 GROUP BY k.tile, k.y, k.x"""


@query("slope", "rasters", sql=_SLOPE)
def q_slope(pixels: DataFrame) -> DataFrame:
    """Heights from probabilities, unknown where the class is 2."""
    return slope(pixels.select(*PIXEL, F.when(F.col("scl") == 2, NODATA).otherwise(F.floor(F.col("prob") * 200)).alias("elevation")))


def filled(heights: DataFrame) -> DataFrame:
    """Unknown heights ``v`` take that of the first known neighbour: left, right, above, below."""
    sides = F.array(*(F.struct(F.lit(k).alias("k"), (F.col("y") + dy).alias("y"), (F.col("x") + dx).alias("x")) for k, (dy, dx) in enumerate([(0, 1), (0, -1), (1, 0), (-1, 0)])))
    sent = heights.where("v is not null").select("tile", "v", F.explode(sides).alias("s")).groupBy("tile", "s.y", "s.x").agg(F.min_by("v", "s.k").alias("near"))
    return heights.join(sent, PIXEL, "left").select(*PIXEL, F.coalesce("v", "near").alias("v"))


def slope(pixels: DataFrame, resolution: int = 10) -> DataFrame:
    """Whole degrees of slope from ``elevation``, 65535 where it is unknown.

    Unknown heights are filled from neighbours twice; block means bring the grid to 20 m (an odd edge is reflected);
    Sobel kernels with mirrored edges give the slope where all nine means are known; bilinear weights take it back to
    the pixels, the corner ones of both grids falling together.
    """
    factor = 20 // resolution
    if factor < 1 or factor % 2:
        raise ValueError(f"no slope at a resolution of {resolution} m")
    raw = pixels.select(*PIXEL, F.nullif("elevation", F.lit(NODATA)).cast("double").alias("v"))
    blocks = {c: F.ceil(F.col(n) / factor) for c, n in (("y", "h"), ("x", "w"))}

    def padded(c: str, n: str) -> Column:
        """The pixel's own index and that beyond an edge for which it stands."""
        other = 2 * (F.col(n) - 1) - F.col(c)
        beyond = (other >= F.col(n)) & (other < blocks[c] * factor)
        return F.when(beyond, F.array(F.col(c), other)).otherwise(F.array(c))

    grown = sized(filled(filled(raw))).withColumn("py", F.explode(padded("y", "h"))).withColumn("px", F.explode(padded("x", "w")))
    coarse = grown.groupBy("tile", F.floor(F.col("py") / factor).alias("y"), F.floor(F.col("px") / factor).alias("x"), blocks["y"].alias("h"), blocks["x"].alias("w")).agg(F.avg("v").alias("v"))
    offsets = F.sequence(F.lit(-1), F.lit(1))
    wanted = coarse.select(*PIXEL, "h", "w").withColumn("dy", F.explode(offsets)).withColumn("dx", F.explode(offsets))
    keyed = wanted.select(*PIXEL, "dy", "dx", mirrored(F.col("y") + F.col("dy"), F.col("h")).alias("ny"), mirrored(F.col("x") + F.col("dx"), F.col("w")).alias("nx"))
    known = coarse.where("v is not null").select("tile", F.col("y").alias("ny"), F.col("x").alias("nx"), "v")
    gx, gy = (F.sum(F.col("v") * F.col(a) * (2 - F.abs(b))) / (8 * 20) for a, b in (("dx", "dy"), ("dy", "dx")))
    sums = keyed.join(known, ["tile", "ny", "nx"]).groupBy(*PIXEL).agg(gx.alias("gx"), gy.alias("gy"), F.count("*").alias("n")).where("n = 9")
    degrees = sums.select("tile", F.col("y").alias("by"), F.col("x").alias("bx"), F.degrees(F.atan(F.sqrt(F.col("gx") ** 2 + F.col("gy") ** 2))).alias("s"))

    def corners(c: str, n: str) -> Column:
        """(block, weight) of the two blocks about a pixel."""
        at = F.col(c) * (blocks[c] - 1) / (blocks[c] * factor - 1)
        return F.array(*(F.struct((F.floor(at) + k).alias("at"), (at - F.floor(at) if k else 1 - (at - F.floor(at))).alias("k")) for k in (0, 1)))

    fine = sized(raw).withColumn("cy", F.explode(corners("y", "h"))).withColumn("cx", F.explode(corners("x", "w"))).withColumn("k", F.col("cy.k") * F.col("cx.k")).where("k > 1e-9")
    met = fine.select(*PIXEL, "v", "k", F.col("cy.at").alias("by"), F.col("cx.at").alias("bx")).join(degrees, ["tile", "by", "bx"], "left")
    known_all = F.bool_and(F.col("v").isNotNull() & F.col("s").isNotNull())
    return met.groupBy(*PIXEL).agg(F.when(known_all, F.floor(F.round(F.sum(F.col("k") * F.col("s")), 6))).otherwise(NODATA).cast("int").alias("slope"))


@query("majority_vote", "rasters", sql=f"""WITH {_CUT}, n AS ({_NEAR}),
  v AS (SELECT n.tile, n.y, n.x, q.label, count(*) AS w FROM n JOIN raster q ON q.tile = n.tile AND q.y = ny AND q.x = nx WHERE q.label <> 3 GROUP BY ALL),
  best AS (SELECT tile, y, x, arg_min(label, -w * 100 + label) AS label FROM v GROUP BY ALL)
  SELECT p.tile, p.y, p.x, CASE WHEN p.label = 3 THEN 3 ELSE coalesce(b.label, p.label) END AS label FROM raster p LEFT JOIN best b USING (tile, y, x)""")
def q_majority_vote(pixels: DataFrame) -> DataFrame:
    return majority_vote(pixels)


def majority_vote(pixels: DataFrame, kernel: int = 3, excluded: int = 3) -> DataFrame:
    """The most frequent label of the square, the lowest of ties; excluded labels neither vote nor change. 1 changes nothing, over 25 is an error."""
    if kernel > 25:
        raise ValueError("kernel sizes go up to 25")
    if kernel == 1:
        return pixels.select(*PIXEL, "label")
    best = votes(pixels, kernel // 2, F.lit(1), excluded).groupBy(*PIXEL).agg(F.min_by("label", F.struct(-F.col("w"), F.col("label"))).alias("v"))
    return pixels.join(best, PIXEL, "left").select(*PIXEL, F.when(F.col("label") == excluded, F.col("label")).otherwise(F.coalesce("v", "label")).alias("label"))


@query("majority_vote_weighted", "pixels", sql="""WITH v AS (SELECT p.tile, p.y, p.x, q.label, round(sum(q.prob), 6) AS w, count(*) AS k FROM pixels p JOIN pixels q ON q.tile = p.tile AND abs(q.y - p.y) <= 1 AND abs(q.x - p.x) <= 1 GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY tile, y, x ORDER BY w DESC, label) AS r FROM v) SELECT tile, y, x, label, round(w / k, 7) AS prob FROM r WHERE r = 1""")
def majority_vote_weighted(pixels: DataFrame) -> DataFrame:
    """The label with the greatest sum of probability in the square, nothing beyond the edges, with its mean probability."""
    v = neighbours(pixels, 1, ["label", "prob"]).groupBy(*PIXEL, "label").agg(F.round(F.sum("prob"), 6).alias("w"), F.count("*").alias("k"))
    best = v.groupBy(*PIXEL).agg(F.min_by(F.struct("label", "w", "k"), F.struct(-F.col("w"), F.col("label"))).alias("b"))
    return pixels.select(*PIXEL).join(best, PIXEL).select(*PIXEL, "b.label", F.round(F.col("b.w") / F.col("b.k"), 7).alias("prob"))


@query("smooth_probabilities", "rasters", sql=f"""WITH {_CUT}, n AS ({_NEAR} WHERE p.label <> 3), k AS (SELECT *, CASE WHEN dy = 0 AND dx = 0 THEN 3 WHEN dy = 0 OR dx = 0 THEN 2 ELSE 1 END AS k FROM n),
  s AS (SELECT k.tile, k.y, k.x, sum(q.prob * k) / 15 AS a, sum((1 - q.prob) * k) / 15 AS b FROM k JOIN raster q ON q.tile = k.tile AND q.y = ny AND q.x = nx AND q.label <> 3 GROUP BY ALL)
  SELECT tile, y, x, round(a / (a + b), 6) AS prob, CASE WHEN round(a - b, 9) >= 0 THEN 1 ELSE 0 END AS crop FROM s""")
def q_smooth_probabilities(pixels: DataFrame) -> DataFrame:
    return smooth_probabilities(pixels)


def smooth_probabilities(pixels: DataFrame, excluded: int = 3) -> DataFrame:
    """The two probabilities of a pixel (``prob`` and the rest) under the kernel 1 2 1 / 2 3 2 / 1 2 1 over 15, edges mirrored.

    Excluded pixels count 0 and are left out; what is left is brought to a sum of 1 again, and the class is that of the greater.
    """
    offsets = F.sequence(F.lit(-1), F.lit(1))
    kept = pixels.where(F.col("label") != excluded)
    wanted = sized(pixels).where(F.col("label") != excluded).select(*PIXEL, "h", "w").withColumn("dy", F.explode(offsets)).withColumn("dx", F.explode(offsets))
    kernel = F.when((F.col("dy") == 0) & (F.col("dx") == 0), 3).when((F.col("dy") == 0) | (F.col("dx") == 0), 2).otherwise(1)
    keyed = wanted.select("tile", "y", "x", mirrored(F.col("y") + F.col("dy"), F.col("h")).alias("ny"), mirrored(F.col("x") + F.col("dx"), F.col("w")).alias("nx"), kernel.alias("k"))
    values = kept.select("tile", F.col("y").alias("ny"), F.col("x").alias("nx"), "prob")
    sums = keyed.join(values, ["tile", "ny", "nx"]).groupBy(*PIXEL).agg(
        (F.sum(F.col("prob") * F.col("k")) / 15).alias("a"), (F.sum((1 - F.col("prob")) * F.col("k")) / 15).alias("b")
    )
    return sums.select(*PIXEL, F.round(F.col("a") / (F.col("a") + F.col("b")), 6).alias("prob"), F.when(F.round(F.col("a") - F.col("b"), 9) >= 0, 1).otherwise(0).alias("crop"))


@query("cropland_product", "pixels", sql="SELECT tile, y, x, CASE WHEN prob >= 0.5e0 THEN 1 ELSE 0 END AS cropland, CAST(round_even(prob * 100, 0) AS INTEGER) AS probability FROM pixels")
def cropland_product(pixels: DataFrame) -> DataFrame:
    """Cropland label and probability in percent."""
    return pixels.select(*PIXEL, F.when(F.col("prob") >= 0.5, 1).otherwise(0).alias("cropland"), F.rint(F.least(F.greatest("prob", F.lit(0.0)), F.lit(1.0)) * 100).cast("int").alias("probability"))


@query("croptype_gate", "pixels", sql="SELECT tile, y, x, CASE WHEN prob >= 0.5e0 THEN label ELSE 254 END AS croptype FROM pixels")
def croptype_gate(pixels: DataFrame) -> DataFrame:
    return pixels.select(*PIXEL, F.when(F.col("prob") >= 0.5, F.col("label")).otherwise(NON_CROP).alias("croptype"))


@query("combine_products", "pixels", sql="SELECT tile, y, x, 'cropland:label' AS band, CASE WHEN prob >= 0.5e0 THEN 1 ELSE 0 END AS value FROM pixels UNION ALL SELECT tile, y, x, 'croptype:label', CASE WHEN prob >= 0.5e0 THEN label ELSE 254 END FROM pixels")
def combine_products(pixels: DataFrame) -> DataFrame:
    crop = cropland_product(pixels).select(*PIXEL, F.lit("cropland:label").alias("band"), F.col("cropland").alias("value"))
    return crop.unionByName(croptype_gate(pixels).select(*PIXEL, F.lit("croptype:label").alias("band"), F.col("croptype").alias("value")))


@query("mosaic", "pixels", sql="SELECT y, x, arg_min(label, tile) AS label FROM pixels WHERE label <> 255 GROUP BY y, x")
def mosaic(pixels: DataFrame) -> DataFrame:
    """The first valid value over overlapping tiles."""
    return pixels.where(F.col("label") != POSTPROCESS_NODATA).groupBy("y", "x").agg(F.min_by("label", "tile").alias("label"))


@query("crop_fraction_mask", "pixels", sql="""WITH c AS (SELECT tile, y // 4 AS cy, x // 4 AS cx, avg(CASE WHEN label = 1 THEN 1e0 ELSE 0e0 END) AS share, avg(prob) AS dvi FROM pixels GROUP BY ALL) SELECT tile, round(avg(dvi), 6) AS dvi, count(*) AS n FROM c WHERE share >= 0.25e0 GROUP BY tile""")
def crop_fraction_mask(pixels: DataFrame, least: float = 0.25) -> DataFrame:
    """Mean index of the coarse pixels with enough of the class, by tile."""
    coarse = pixels.groupBy("tile", F.floor(F.col("y") / 4).alias("cy"), F.floor(F.col("x") / 4).alias("cx")).agg(
        F.avg((F.col("label") == 1).cast("double")).alias("share"), F.avg("prob").alias("dvi")
    )
    return coarse.where(F.col("share") >= least).groupBy("tile").agg(F.round(F.avg("dvi"), 6).alias("dvi"), F.count("*").alias("n"))
