"""Joins, aggregations, rankings and set operations over samples, legends, regions, jobs and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrispark.operators.geometry import TILES_SQL, tiles
from agrispark.operators.polygons import PLACED_SQL, placed
from agrispark.registry import query
from agrispark.storage import small


# joins


@query("legend_label_join", "samples", "legend", sql="""SELECT sample_id, coalesce(label_full, 'Unknown') AS label_full, coalesce(sampling_label, 'Unknown') AS sampling_label
  FROM samples LEFT JOIN legend USING (ewoc_code)""")
def legend_label_join(samples: DataFrame, legend: DataFrame) -> DataFrame:
    labels = ("label_full", "sampling_label")
    return samples.join(small(legend), "ewoc_code", "left").select("sample_id", *(F.coalesce(c, F.lit("Unknown")).alias(c) for c in labels))


@query("class_mapping_join", "samples", "legend", sql="""SELECT sample_id, level_2 AS finetune_class, level_3 AS balancing_class FROM samples JOIN legend USING (ewoc_code) WHERE ewoc_code NOT IN (0, 1000000000)""")
def class_mapping_join(samples: DataFrame, legend: DataFrame, excluded=(0, 1000000000)) -> DataFrame:
    """Codes mapped to classes; excluded and unmapped codes go."""
    kept = samples.where(~F.col("ewoc_code").isin(*excluded))
    return kept.join(small(legend), "ewoc_code").select("sample_id", F.col("level_2").alias("finetune_class"), F.col("level_3").alias("balancing_class"))


def in_rectangles(points: DataFrame, regions: DataFrame, cell: float = 10.0) -> DataFrame:
    """Points with the rectangles that hold them: an equi-join on grid cells and then the exact test, no cross join."""
    def steps(a: str, b: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(a) / cell), F.floor(F.col(b) / cell)))
    boxes = regions.withColumn("_cx", steps("w", "e")).withColumn("_cy", steps("s", "n"))
    keyed = points.withColumn("_cx", F.floor(F.col("lon") / cell)).withColumn("_cy", F.floor(F.col("lat") / cell))
    inside = F.col("lon").between(F.col("w"), F.col("e")) & F.col("lat").between(F.col("s"), F.col("n"))
    return keyed.join(boxes, ["_cx", "_cy"]).where(inside).drop("_cx", "_cy")


@query("country_from_id_or_geometry", "samples", "outlines", sql=f"WITH {PLACED_SQL.format('samples')} SELECT sample_id, CASE WHEN s.ref_id LIKE '%_100' THEN coalesce(iso3, 'Unknown') ELSE split_part(s.ref_id, '_', 2) END AS country FROM samples s LEFT JOIN reg USING (sample_id)")
def country_from_id_or_geometry(samples: DataFrame, outlines: DataFrame) -> DataFrame:
    """The code in the dataset id; for ambiguous ids that of the geometry."""
    return placed(samples.select("sample_id", "ref_id", "lon", "lat"), outlines).select("sample_id", F.when(F.col("ref_id").endswith("_100"), F.coalesce("iso3", F.lit("Unknown"))).otherwise(F.split_part("ref_id", F.lit("_"), F.lit(2))).alias("country"))


@query("tile_assignment_join", "samples", "regions", sql=f"WITH {TILES_SQL} SELECT sample_id, min(tile_name) AS tile FROM samples LEFT JOIN t ON lon BETWEEN x0 AND x1 AND lat BETWEEN y0 AND y1 GROUP BY sample_id")
def q_tile_assignment_join(samples: DataFrame, regions: DataFrame) -> DataFrame:
    return tile_assignment_join(samples, tiles(regions, 7.0))


def tile_assignment_join(samples: DataFrame, grid: DataFrame, how: str = "left") -> DataFrame:
    """The tile that a sample's point meets, the first by name on shared edges; without one null (left) or no row (inner)."""
    boxes = grid.select("tile_name", F.col("x0").alias("w"), F.col("x1").alias("e"), F.col("y0").alias("s"), F.col("y1").alias("n"))
    met = in_rectangles(samples.select("sample_id", "lon", "lat"), boxes).groupBy("sample_id").agg(F.min("tile_name").alias("tile"))
    return samples.select("sample_id").join(met, "sample_id", how)


_EARLIER = "SELECT DISTINCT concat('P', split_part(sample_id, '_', 1)) AS sample_id, ref_id FROM obs"


def earlier(obs: DataFrame) -> DataFrame:
    """The samples that a catalogue of observations holds, with their dataset."""
    return obs.select(F.concat(F.lit("P"), F.split_part("sample_id", F.lit("_"), F.lit(1))).alias("sample_id"), "ref_id").distinct()


@query("existing_samples_anti_join", "samples", "obs", sql=f"SELECT sample_id FROM samples WHERE sample_id NOT IN (SELECT sample_id FROM ({_EARLIER}))")
def existing_samples_anti_join(samples: DataFrame, obs: DataFrame) -> DataFrame:
    """Samples that the catalogue doesn't hold yet."""
    return samples.join(earlier(obs).select("sample_id"), "sample_id", "left_anti").select("sample_id")


@query("append_new_samples", "samples", "obs", sql=f"SELECT sample_id, ref_id FROM samples WHERE extract = 1 AND NOT EXISTS (SELECT 1 FROM ({_EARLIER}) o WHERE o.sample_id = samples.sample_id AND o.ref_id = samples.ref_id)")
def append_new_samples(samples: DataFrame, obs: DataFrame) -> DataFrame:
    """Flagged samples that earlier outputs of the same dataset don't hold."""
    return samples.where("extract = 1").join(earlier(obs), ["sample_id", "ref_id"], "left_anti").select("sample_id", "ref_id")


@query("sample_set_semi_join", "obs", "obs_raw", sql="SELECT DISTINCT split_part(sample_id, '_', 1) AS id, concat('S', split_part(sample_id, '_', 1)) IN (SELECT sample_id FROM obs_raw WHERE vv = 1) AS in_both FROM obs")
def sample_set_semi_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Ids of one catalogue, and whether the other has them."""
    ids = a.select(F.split_part("sample_id", F.lit("_"), F.lit(1)).alias("id")).distinct()
    other = b.where("vv = 1").select(F.expr("substr(sample_id, 2)").alias("id")).distinct().withColumn("y", F.lit(True))
    return ids.join(other, "id", "left").select("id", F.coalesce("y", F.lit(False)).alias("in_both"))


@query("semi_anti_filters", "samples", "legend", sql="SELECT sample_id FROM samples WHERE ewoc_code IN (SELECT ewoc_code FROM legend WHERE level_1 = 'L1-1') AND ref_id NOT LIKE '2017%'")
def semi_anti_filters(samples: DataFrame, legend: DataFrame) -> DataFrame:
    kept = samples.join(legend.where("level_1 = 'L1-1'").select("ewoc_code"), "ewoc_code", "left_semi")
    ignored = samples.where(F.col("ref_id").startswith("2017")).select("sample_id")
    return kept.join(ignored, "sample_id", "left_anti").select("sample_id")


@query("region_filter", "samples", "outlines", sql=f"WITH {PLACED_SQL.format('samples')} SELECT sample_id, region FROM reg WHERE lower(region) IN ('asia', 'europe')")
def region_filter(samples: DataFrame, outlines: DataFrame, wanted: str = "Asia, EUROPE") -> DataFrame:
    """Samples of the listed regions, whatever their case; ``all`` or blank keeps every one, an unknown name is an error."""
    found = placed(samples.select("sample_id", "lon", "lat"), outlines)
    names = [w.strip().lower() for w in wanted.split(",") if w.strip()]
    if not names or "all" in names:
        return found.select("sample_id", "region")
    known = {r[0].lower() for r in outlines.select("region").distinct().collect()}
    if unknown := set(names) - known:
        raise ValueError(f"unknown regions {sorted(unknown)}; known: {sorted(known)}")
    return found.where(F.lower("region").isin(names)).select("sample_id", "region")


@query("datasets_in_area", "collections", sql="SELECT DISTINCT ref_id FROM collections WHERE e >= -100 AND w <= 0 AND n >= -40 AND s <= 10 AND ref_id NOT LIKE '%GLO%'")
def datasets_in_area(collections: DataFrame, area=(-100.0, -40.0, 0.0, 10.0)) -> DataFrame:
    w, s, e, n = area
    meets = (F.col("e") >= w) & (F.col("w") <= e) & (F.col("n") >= s) & (F.col("s") <= n)
    return collections.where(meets & ~F.col("ref_id").contains("GLO")).select("ref_id").distinct()


@query("classify_dataset_source", "collections", sql="SELECT ref_id, CASE WHEN access = 'Private' THEN 'private' ELSE 'public' END AS source FROM collections WHERE t0 >= DATE '2018-01-01'")
def classify_dataset_source(collections: DataFrame) -> DataFrame:
    asked = collections.where("t0 >= DATE '2018-01-01'").select("ref_id")
    sides = [collections.where(F.col("access") == a).select("ref_id", F.lit(n).alias("source")) for a, n in (("Private", "private"), ("Public", "public"))]
    return asked.join(sides[0].unionByName(sides[1]), "ref_id")


@query("search_collections", "collections", sql="""SELECT ref_id FROM collections WHERE e >= -120 AND w <= 60 AND n >= -40 AND s <= 40 AND t0 <= DATE '2021-12-31' AND t1 >= DATE '2019-01-01' AND access = 'Public'""")
def search_collections(collections: DataFrame, bbox=(-120.0, -40.0, 60.0, 40.0), period=("2019-01-01", "2021-12-31"), access=("Public",)) -> DataFrame:
    """Collections that meet a box and a period, by access type."""
    w, s, e, n = bbox
    space = (F.col("e") >= w) & (F.col("w") <= e) & (F.col("n") >= s) & (F.col("s") <= n)
    time = (F.col("t0") <= F.to_date(F.lit(period[1]))) & (F.col("t1") >= F.to_date(F.lit(period[0])))
    return collections.where(space & time & F.col("access").isin(*access)).select("ref_id")


@query("cube_merge_join", "pixels", sql="""SELECT coalesce(a.x, b.x) AS x, coalesce(a.y, b.y) AS y, a.label AS optical, b.label AS radar, c.scl AS static FROM (SELECT * FROM pixels WHERE tile = 0) a
  FULL OUTER JOIN (SELECT * FROM pixels WHERE tile = 1) b ON a.x = b.x AND a.y = b.y LEFT JOIN (SELECT * FROM pixels WHERE tile = 2) c ON c.x = coalesce(a.x, b.x) AND c.y = coalesce(a.y, b.y)""")
def cube_merge_join(pixels: DataFrame) -> DataFrame:
    """Two sensors merged on the pixel, a static layer joined to both."""
    def layer(t: int, c: str, n: str) -> DataFrame:
        return pixels.where(F.col("tile") == t).select("x", "y", F.col(c).alias(n))
    both = layer(0, "label", "optical").join(layer(1, "label", "radar"), ["x", "y"], "full_outer")
    return both.join(layer(2, "scl", "static"), ["x", "y"], "left")


@query("dvi_weather_join", "obs_raw", "obs", sql="""WITH w AS (SELECT concat('S', split_part(sample_id, '_', 1)) AS sample_id, ts AS month, max(b02) AS weather FROM obs GROUP BY 1, 2),
  c AS (SELECT sample_id, dayofyear(ts) AS doy, max(b08) AS coefficient FROM obs_raw GROUP BY 1, 2)
  SELECT r.sample_id, r.ts, r.seq, r.line, w.weather, c.coefficient FROM obs_raw r JOIN w ON w.sample_id = r.sample_id AND w.month = date_trunc('month', r.ts) JOIN c ON c.sample_id = r.sample_id AND c.doy = dayofyear(r.ts)""")
def q_dvi_weather_join(index: DataFrame, obs: DataFrame) -> DataFrame:
    weather = obs.groupBy(F.concat(F.lit("S"), F.split_part("sample_id", F.lit("_"), F.lit(1))).alias("sample_id"), F.col("ts").alias("month")).agg(F.max("b02").alias("weather"))
    coefficients = index.groupBy("sample_id", F.dayofyear("ts").alias("doy")).agg(F.max("b08").alias("coefficient"))
    return dvi_weather_join(index, weather, coefficients).select("sample_id", "ts", "seq", "line", "weather", "coefficient")


def dvi_weather_join(index: DataFrame, weather: DataFrame, coefficients: DataFrame) -> DataFrame:
    """Index rows with the weather of their place and month and the coefficient of their place and day of the year."""
    keyed = index.withColumn("month", F.trunc("ts", "month")).withColumn("doy", F.dayofyear("ts"))
    return keyed.join(weather, ["sample_id", "month"]).join(coefficients, ["sample_id", "doy"])


# aggregations


@query("cell_class_counts", "samples", "legend", sql="""SELECT ewoc_code, level_2, landcover, CAST(floor((lat + 90) / 5) AS BIGINT) AS cy, CAST(floor((lon + 180) / 5) AS BIGINT) AS cx, count(DISTINCT sample_id) AS n
  FROM samples LEFT JOIN legend USING (ewoc_code) WHERE ewoc_code <> 1000000000 GROUP BY ALL""")
def cell_class_counts(samples: DataFrame, legend: DataFrame, size: float = 5.0) -> DataFrame:
    mapped = samples.where("ewoc_code <> 1000000000").join(small(legend), "ewoc_code", "left")
    cell = (F.floor((F.col("lat") + 90) / size).alias("cy"), F.floor((F.col("lon") + 180) / size).alias("cx"))
    return mapped.groupBy("ewoc_code", "level_2", "landcover", *cell).agg(F.countDistinct("sample_id").alias("n"))


@query("reaggregate_to_parent_cell", "samples", sql="SELECT CAST(floor((lat + 90) / 20) AS BIGINT) AS cy, CAST(floor((lon + 180) / 20) AS BIGINT) AS cx, landcover, count(DISTINCT sample_id) AS n FROM samples GROUP BY ALL")
def reaggregate_to_parent_cell(samples: DataFrame) -> DataFrame:
    """Counts of 5-degree cells summed to their 20-degree parents."""
    fine = samples.groupBy("landcover", F.floor((F.col("lat") + 90) / 5).alias("cy"), F.floor((F.col("lon") + 180) / 5).alias("cx")).agg(F.countDistinct("sample_id").alias("n"))
    return fine.groupBy("landcover", F.floor(F.col("cy") / 4).alias("cy"), F.floor(F.col("cx") / 4).alias("cx")).agg(F.sum("n").alias("n"))


@query("normalise_class_labels", "samples", "legend", sql="SELECT coalesce(level_1, 'ignore') AS lc, coalesce(level_2, 'ignore') AS ct, count(*) AS n FROM samples LEFT JOIN legend USING (ewoc_code) GROUP BY ALL")
def normalise_class_labels(samples: DataFrame, legend: DataFrame) -> DataFrame:
    joined = samples.join(small(legend), "ewoc_code", "left").select(F.col("level_1").alias("lc"), F.col("level_2").alias("ct"))
    return joined.fillna("ignore").groupBy("lc", "ct").agg(F.count("*").alias("n"))


def cells_of(samples: DataFrame) -> DataFrame:
    return samples.withColumn("cell", F.concat_ws("_", F.floor((F.col("lat") + 90) / 10).cast("string"), F.floor((F.col("lon") + 180) / 10).cast("string"))).withColumn(
        "parent", F.concat_ws("_", F.floor((F.col("lat") + 90) / 40).cast("string"), F.floor((F.col("lon") + 180) / 40).cast("string"))
    )


_CELLS = """cells AS (SELECT *, concat(CAST(floor((lat + 90) / 10) AS BIGINT), '_', CAST(floor((lon + 180) / 10) AS BIGINT)) AS cell, concat(CAST(floor((lat + 90) / 40) AS BIGINT), '_', CAST(floor((lon + 180) / 40) AS BIGINT)) AS parent FROM samples),
  summary AS (SELECT cell, any_value(parent) AS parent, count(*) AS n, count(*) FILTER (year(valid_time) >= 2021) AS recent, count(DISTINCT landcover) AS n_lc, count(DISTINCT CASE WHEN quality_ct > 0 THEN croptype END) AS n_ct FROM cells GROUP BY cell)"""


def cell_summary(cells: DataFrame) -> DataFrame:
    return cells.groupBy("cell").agg(
        F.min("parent").alias("parent"), F.count("*").alias("n"), F.count(F.when(F.year("valid_time") >= 2021, 1)).alias("recent"),
        F.countDistinct("landcover").alias("n_lc"), F.countDistinct(F.when(F.col("quality_ct") > 0, F.col("croptype"))).alias("n_ct"),
    )


@query("cell_summary", "samples", sql=f"WITH {_CELLS} SELECT * FROM summary")
def q_cell_summary(samples: DataFrame) -> DataFrame:
    return cell_summary(cells_of(samples))


@query("crop_counts_pivot", "samples", sql="""SELECT landcover, count(*) FILTER (extract = 0) AS e0, count(*) FILTER (extract = 1) AS e1, count(*) FILTER (extract = 2) AS e2 FROM samples GROUP BY landcover""")
def crop_counts_pivot(samples: DataFrame) -> DataFrame:
    wide = samples.groupBy("landcover").pivot("extract", [0, 1, 2]).count().fillna(0)
    return wide.select("landcover", *(F.col(str(k)).alias(f"e{k}") for k in range(3)))


@query("collection_stats_json", "events_", sql="""SELECT event_type AS topic, sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS total, count(*) AS n FROM events_ GROUP BY event_type""")
def collection_stats_json(events: DataFrame) -> DataFrame:
    """Numbers inside a JSON column, summed by topic."""
    parsed = F.from_json("props", "k bigint")
    return events.groupBy(F.col("event_type").alias("topic")).agg(F.sum(parsed["k"]).alias("total"), F.count("*").alias("n"))


@query("melt_class_mappings", "legend", sql="""SELECT name, count(*) AS n_codes, max(label) AS last_label FROM (SELECT ewoc_code, name, label FROM legend UNPIVOT (label FOR name IN (level_1, level_2, level_3))) WHERE label <> '' GROUP BY name""")
def melt_class_mappings(legend: DataFrame) -> DataFrame:
    """Class columns of the legend as one map of code to label each; blanks are skipped."""
    long = legend.unpivot(["ewoc_code"], ["level_1", "level_2", "level_3"], "name", "label").where("label <> ''")
    maps = long.groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("ewoc_code", "label"))).alias("m"))
    return maps.select("name", F.size("m").cast("long").alias("n_codes"), F.array_max(F.map_values("m")).alias("last_label"))


@query("remove_small_classes", "samples", sql="SELECT sample_id, croptype FROM (SELECT *, count(*) OVER (PARTITION BY croptype) AS n FROM samples) WHERE n >= 15")
def remove_small_classes(samples: DataFrame, least: int = 15) -> DataFrame:
    """Rows of classes with enough of them; the counts are aggregated first, so a large class is no single task."""
    large = samples.groupBy("croptype").count().where(F.col("count") >= least).select("croptype")
    return samples.join(large, "croptype", "left_semi").select("sample_id", "croptype")


@query("legend_rollup", "samples", "legend", sql="""SELECT level_1, level_2, level_3, count(*) AS n FROM samples JOIN legend USING (ewoc_code) GROUP BY ROLLUP (level_1, level_2, level_3) HAVING count(*) >= 5""")
def legend_rollup(samples: DataFrame, legend: DataFrame, least: int = 5) -> DataFrame:
    """Counts over the label hierarchy, nodes below the threshold left out."""
    joined = samples.join(small(legend), "ewoc_code")
    return joined.rollup("level_1", "level_2", "level_3").agg(F.count("*").alias("n")).where(F.col("n") >= least)


@query("apply_class_selection", "samples", "legend", sql="SELECT sample_id, CASE WHEN level_2 IN ('L2-1', 'L2-2') THEN level_2 ELSE 'other' END AS label FROM samples JOIN legend USING (ewoc_code) WHERE level_3 <> 'L3-7'")
def apply_class_selection(samples: DataFrame, legend: DataFrame, included=("L2-1", "L2-2"), excluded=("L3-7",)) -> DataFrame:
    joined = samples.join(small(legend), "ewoc_code").where(~F.col("level_3").isin(*excluded))
    return joined.select("sample_id", F.when(F.col("level_2").isin(*included), F.col("level_2")).otherwise("other").alias("label"))


@query("combine_drop_classes", "samples", sql="SELECT sample_id, CASE WHEN landcover IN ('Brand#11', 'Brand#12') THEN 'merged' ELSE landcover END AS label FROM samples WHERE landcover <> 'Brand#55'")
def combine_drop_classes(samples: DataFrame) -> DataFrame:
    kept = samples.where("landcover <> 'Brand#55'")
    return kept.select("sample_id", F.when(F.col("landcover").isin("Brand#11", "Brand#12"), "merged").otherwise(F.col("landcover")).alias("label"))


@query("other_class_composition", "samples", "legend", sql="SELECT ewoc_code, coalesce(max(label_full), 'Unknown') AS label_full, count(*) AS n FROM samples LEFT JOIN legend USING (ewoc_code) WHERE extract = 2 GROUP BY ewoc_code")
def other_class_composition(samples: DataFrame, legend: DataFrame) -> DataFrame:
    counts = samples.where("extract = 2").groupBy("ewoc_code").agg(F.count("*").alias("n"))
    return counts.join(small(legend.select("ewoc_code", "label_full")), "ewoc_code", "left").fillna("Unknown", ["label_full"])


@query("dataset_extent", "samples", sql="SELECT ref_id, min(lon) AS w, max(lon) AS e, min(lat) AS s, max(lat) AS n FROM samples GROUP BY ref_id")
def dataset_extent(samples: DataFrame) -> DataFrame:
    return samples.groupBy("ref_id").agg(F.min("lon").alias("w"), F.max("lon").alias("e"), F.min("lat").alias("s"), F.max("lat").alias("n"))


@query("content_report", "samples", sql="SELECT ref_id, landcover, count(DISTINCT sample_id) AS n, min(valid_time) AS first_date, max(valid_time) AS last_date FROM samples GROUP BY ref_id, landcover")
def content_report(samples: DataFrame) -> DataFrame:
    return samples.groupBy("ref_id", "landcover").agg(F.countDistinct("sample_id").alias("n"), F.min("valid_time").alias("first_date"), F.max("valid_time").alias("last_date"))


@query("status_histogram", "jobs", sql="SELECT status, count(*) AS n FROM jobs GROUP BY status")
def status_histogram(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("status").agg(F.count("*").alias("n")).orderBy(F.desc("n"))


@query("succeeded_job_report", "jobs", sql="SELECT epsg, count(*) AS n, round(sum(CAST(regexp_extract(duration, '^([0-9]+)s$', 1) AS INTEGER)) / 60e0, 6) AS minutes, round(avg(cost), 4) AS mean_cost FROM jobs WHERE status = 'finished' GROUP BY epsg")
def succeeded_job_report(jobs: DataFrame) -> DataFrame:
    seconds = F.regexp_extract("duration", r"^([0-9]+)s$", 1).cast("int")
    done = jobs.where("status = 'finished'").groupBy("epsg")
    return done.agg(F.count("*").alias("n"), F.round(F.sum(seconds) / 60, 6).alias("minutes"), F.round(F.avg("cost"), 4).alias("mean_cost"))


@query("period_extent_by_projection", "jobs", sql="""SELECT epsg, CAST(date_trunc('month', min(start_date)) AS DATE) AS start_date, least(last_day(max(end_date)), DATE '2001-06-30') AS end_date FROM jobs WHERE epsg <> 32610 GROUP BY epsg""")
def period_extent_by_projection(jobs: DataFrame, skipped: int = 32610, last_full: str = "2001-06-30") -> DataFrame:
    """Period of each projection in whole months, up to the last full month."""
    spans = jobs.where(F.col("epsg") != skipped).groupBy("epsg").agg(F.min("start_date").alias("a"), F.max("end_date").alias("b"))
    return spans.select("epsg", F.trunc("a", "month").alias("start_date"), F.least(F.last_day("b"), F.to_date(F.lit(last_full))).alias("end_date"))


@query("tile_area_range", "regions", sql="SELECT region, round(min((e - w) * (n - s)), 6) AS smallest, round(max((e - w) * (n - s)), 6) AS largest FROM regions GROUP BY region")
def tile_area_range(regions: DataFrame) -> DataFrame:
    area = (F.col("e") - F.col("w")) * (F.col("n") - F.col("s"))
    return regions.groupBy("region").agg(F.round(F.min(area), 6).alias("smallest"), F.round(F.max(area), 6).alias("largest"))


@query("bin_class_grid", "samples", sql="""SELECT landcover, sum(n) AS n, count(*) AS bins, round(min(w), 4) AS low, round(max(w), 4) AS high, round(median(w), 4) AS middle
  FROM (SELECT landcover, floor((lat + 90) / 10) AS cy, floor((lon + 180) / 10) AS cx, count(*) AS n, avg(weight) AS w FROM samples GROUP BY ALL) GROUP BY landcover""")
def bin_class_grid(samples: DataFrame) -> DataFrame:
    """Mean weight by bin and class, then its spread over the bins of each class."""
    bins = samples.groupBy("landcover", F.floor((F.col("lat") + 90) / 10).alias("cy"), F.floor((F.col("lon") + 180) / 10).alias("cx")).agg(F.count("*").alias("n"), F.avg("weight").alias("w"))
    stats = {"low": F.min("w"), "high": F.max("w"), "middle": F.median("w")}
    return bins.groupBy("landcover").agg(F.sum("n").alias("n"), F.count("*").alias("bins"), *(F.round(c, 4).alias(k) for k, c in stats.items()))


@query("drop_counts_report", "samples", sql="SELECT ref_id, count(DISTINCT sample_id) FILTER (quality_ct = 0) AS no_quality, count(DISTINCT sample_id) FILTER (extract = 0) AS not_flagged FROM samples GROUP BY ref_id")
def drop_counts_report(samples: DataFrame) -> DataFrame:
    filters = {"no_quality": F.col("quality_ct") == 0, "not_flagged": F.col("extract") == 0}
    return samples.groupBy("ref_id").agg(*(F.countDistinct(F.when(c, F.col("sample_id"))).alias(n) for n, c in filters.items()))


# rankings and sets


@query("seed_cell_ranking", "samples", sql=f"""WITH {_CELLS} SELECT cell, parent, CASE r WHEN 1 THEN 'test' ELSE 'val' END AS split FROM (SELECT *, count(*) OVER (PARTITION BY parent) AS k,
  row_number() OVER (PARTITION BY parent ORDER BY n_lc DESC, n_ct DESC, recent DESC, n DESC, cell) AS r FROM summary) WHERE k >= 2 AND r <= 2""")
def seed_cell_ranking(samples: DataFrame) -> DataFrame:
    """The richest cell of each parent goes to test, the second to validation; single cells are skipped."""
    parent = Window.partitionBy("parent")
    order = parent.orderBy(F.desc("n_lc"), F.desc("n_ct"), F.desc("recent"), F.desc("n"), "cell")
    ranked = cell_summary(cells_of(samples)).withColumn("k", F.count("*").over(parent)).withColumn("r", F.row_number().over(order))
    return ranked.where("k >= 2 and r <= 2").select("cell", "parent", F.when(F.col("r") == 1, "test").otherwise("val").alias("split"))


@query("topk_labels", "samples", sql="SELECT croptype, max(weight) AS top FROM samples GROUP BY croptype ORDER BY top DESC, croptype LIMIT 15")
def topk_labels(samples: DataFrame, k: int = 15) -> DataFrame:
    return samples.groupBy("croptype").agg(F.max("weight").alias("top")).orderBy(F.desc("top"), "croptype").limit(k)


@query("group_percentile", "samples", sql="SELECT sample_id, ref_id, round(quantile_cont(weight, 0.2) OVER (PARTITION BY ref_id), 6) AS p20 FROM samples")
def group_percentile(samples: DataFrame, share: float = 0.2) -> DataFrame:
    """The linear percentile of a dataset's weights beside each row (aggregated, then joined)."""
    p = samples.groupBy("ref_id").agg(F.round(F.percentile("weight", F.lit(share)), 6).alias("p20"))
    return samples.select("sample_id", "ref_id").join(p, "ref_id")


@query("largest_remainder_allocation", "predictions", sql="""WITH c AS (SELECT target, count(*) * 100e0 / sum(count(*)) OVER () AS q FROM predictions GROUP BY target),
  r AS (SELECT target, CAST(floor(q) AS BIGINT) AS f, row_number() OVER (ORDER BY round(q - floor(q), 9) DESC, target) AS k, 100 - sum(floor(q)) OVER () AS left_over FROM c)
  SELECT target, CAST(f + CASE WHEN k <= left_over THEN 1 ELSE 0 END AS BIGINT) AS n FROM r""")
def largest_remainder_allocation(predictions: DataFrame, size: int = 100) -> DataFrame:
    """A batch shared among classes in proportion: whole parts, then the largest remainders. Windows run over classes only."""
    whole = Window.partitionBy(F.lit(1))
    counts = predictions.groupBy("target").agg(F.count("*").alias("c")).withColumn("q", F.col("c") * size / F.sum("c").over(whole))
    ranked = counts.withColumn("f", F.floor("q")).withColumn("k", F.row_number().over(whole.orderBy(F.desc(F.round(F.col("q") - F.col("f"), 9)), "target")))
    extra = F.when(F.col("k") <= size - F.sum("f").over(whole), 1).otherwise(0)
    return ranked.select("target", (F.col("f") + extra).alias("n"))


@query("union_all_sources", "samples", sql="SELECT sample_id, 'public' AS source, ref_id FROM samples WHERE extract > 0 UNION ALL SELECT sample_id, 'private', NULL FROM samples WHERE extract = 0")
def union_all_sources(samples: DataFrame) -> DataFrame:
    public = samples.where("extract > 0").select("sample_id", F.lit("public").alias("source"), "ref_id")
    private = samples.where("extract = 0").select("sample_id", F.lit("private").alias("source"))
    return public.unionByName(private, allowMissingColumns=True)


@query("distinct_samples", "obs", sql="SELECT DISTINCT ref_id, sample_id FROM obs")
def distinct_samples(obs: DataFrame) -> DataFrame:
    return obs.select("ref_id", "sample_id").distinct()


@query("missing_classes", "samples", sql="SELECT DISTINCT croptype FROM samples WHERE extract = 0 EXCEPT SELECT DISTINCT croptype FROM samples WHERE extract = 1 AND quality_ct > 4")
def missing_classes(samples: DataFrame) -> DataFrame:
    covered = samples.where("extract = 1 AND quality_ct > 4").select("croptype").distinct()
    return samples.where("extract = 0").select("croptype").distinct().join(covered, "croptype", "left_anti")
