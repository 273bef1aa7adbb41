"""Scans and sinks. Writers go to the path they are given; readers leave pruning to Spark."""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from agrispark.functions.bands import NODATA
from agrispark.operators.geometry import utm_sql
from agrispark.operators.polygons import inset
from agrispark.registry import query
from agrispark.storage import scratch

#: Columns that files may lack, and what stands for them: no penalty, nothing flagged.
OPTIONAL = {"outlier_score_lc": 1.0, "outlier_score_ct": 1.0, "outlier_flag_lc": "normal", "outlier_flag_ct": "normal"}


def ref_id_of(path: Column) -> Column:
    """Dataset id of a file path: a ``ref_id=`` segment, else a ``YYYY_`` folder, else the file's stem."""
    found = [F.nullif(F.regexp_extract(path, p, 1), F.lit("")) for p in (r"ref_id=([^/]+)/", r"/(\d{4}_[^/]+)/", r"([^/]+?)(?:\.[^./]*)?$")]
    return F.coalesce(*found)


def scan_long_observations(spark: SparkSession, *paths: str, columns: list[str] | None = None) -> DataFrame:
    """Long observation files with their dataset id; optional columns that a file lacks get defaults."""
    df = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(*paths)
    df = df.withColumn("ref_id", ref_id_of(F.col("_metadata.file_path"))) if "ref_id" not in df.columns else df
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v) for c, v in OPTIONAL.items()})
    return df.select(*columns) if columns else df


def list_partition_files(spark: SparkSession, path: str) -> DataFrame:
    """The leaf files under a path, as rows."""
    return spark.read.option("recursiveFileLookup", True).format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", "length").distinct()


def merge_partitioned_sink(df: DataFrame, path: str) -> None:
    """Replace only the dataset partitions that ``df`` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ref_id").parquet(path)


def write_wide_sorted(df: DataFrame, path: str, rows_a_file: int = 2_000_000) -> None:
    """Files in order of dataset, snappy, each of a bounded number of rows; equal datasets may span tasks."""
    df.repartitionByRange("ref_id", "sample_id").sortWithinPartitions("ref_id", "sample_id").write.mode("overwrite").option("maxRecordsPerFile", rows_a_file).option("compression", "snappy").parquet(path)


def write_split_files(df: DataFrame, path: str) -> None:
    """The sample-to-split table as Parquet and one CSV folder a split."""
    df.write.mode("overwrite").parquet(f"{path}/splits")
    df.write.mode("overwrite").partitionBy("split").csv(f"{path}/csv", header=True)


def schema_evolving_append(tables: list[DataFrame]) -> DataFrame:
    """Union by name; columns that a table lacks are nodata for numbers, false for booleans, null otherwise."""
    types = {f.name: f.dataType for t in tables for f in t.schema.fields}

    def default(kind) -> Column:
        if isinstance(kind, NumericType):
            return F.lit(NODATA).cast(kind)
        return F.lit(False) if kind.simpleString() == "boolean" else F.lit(None).cast(kind)

    full = [t.withColumns({c: default(k) for c, k in types.items() if c not in t.columns}).select(*types) for t in tables]
    out = full[0]
    for t in full[1:]:
        out = out.unionByName(t)
    return out


def load_legend_csv(spark: SparkSession, path: str, fill_across: list[str] | None = None) -> DataFrame:
    """Semicolon-separated legend; codes lose their dashes; empty levels take the last one to their left."""
    df = spark.read.csv(path, sep=";", header=True).withColumn("ewoc_code", F.regexp_replace("ewoc_code", "-", "").cast("long"))
    for k in range(1, len(fill_across or [])):
        df = df.withColumn(fill_across[k], F.coalesce(*(F.col(c) for c in reversed(fill_across[: k + 1]))))
    return df


def job_tracking_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True)


@query("scan_long_observations", "obs", sql="""SELECT sample_id, ts, ref_id, b02, CASE WHEN ref_id LIKE '2018%' THEN b02 / 100e0 ELSE 1e0 END AS outlier_score_lc, 1e0 AS outlier_score_ct,
  CASE WHEN ref_id LIKE '2018%' THEN 'suspect' ELSE 'normal' END AS outlier_flag_lc, 'normal' AS outlier_flag_ct FROM obs""")
def q_scan(obs: DataFrame) -> DataFrame:
    """Observations written as a tree of files by dataset, those of one year with two of the optional columns, and scanned."""
    path = scratch(obs.sparkSession, "long")
    marked = F.col("ref_id").startswith("2018")
    rows = obs.select("sample_id", "ts", "ref_id", "b02")
    rows.where(~marked).write.partitionBy("ref_id").parquet(path)
    rows.where(marked).withColumns({"outlier_score_lc": F.col("b02") / 100, "outlier_flag_lc": F.lit("suspect")}).write.mode("append").partitionBy("ref_id").parquet(path)
    return scan_long_observations(obs.sparkSession, path, columns=["sample_id", "ts", "ref_id", "b02", *OPTIONAL])


@query("ref_id_from_path", "samples", sql="""SELECT sample_id, CASE WHEN extract = 0 THEN ref_id WHEN extract = 1 THEN ref_id ELSE sample_id END AS found FROM samples""")
def q_ref_id(samples: DataFrame) -> DataFrame:
    path = (
        F.when(F.col("extract") == 0, F.concat(F.lit("/data/ref_id="), "ref_id", F.lit("/part-0.parquet")))
        .when(F.col("extract") == 1, F.concat(F.lit("/data/"), "ref_id", F.lit("/x.parquet"))).otherwise(F.concat(F.lit("/data/"), "sample_id", F.lit(".parquet")))
    )
    return samples.select("sample_id", ref_id_of(path).alias("found"))


def buffered(bbox: tuple[float, float, float, float], metres: float) -> tuple[float, float, float, float]:
    """A box (west, south, east, north) widened by a square buffer in web Mercator."""
    across = math.degrees(metres / EARTH)

    def moved(lat: float, by: float) -> float:
        y = math.log(math.tan(math.pi / 4 + math.radians(lat) / 2)) * EARTH + by
        return math.degrees(2 * math.atan(math.exp(y / EARTH)) - math.pi / 2)

    w, s, e, n = bbox
    return w - across, moved(s, -metres), e + across, moved(n, metres)


def query_samples(samples: DataFrame, bbox=None, ref_ids=None, buffer: float = 250_000.0, cropland: bool = True, crop_types=None, least_flag: int | None = None) -> DataFrame:
    """Samples by buffered box, cropland code range, list of codes, datasets and least extract flag; one of box and datasets is needed."""
    if bbox is None and not ref_ids:
        raise ValueError("give a box or dataset ids")
    out = samples
    if ref_ids:
        out = out.where(F.col("ref_id").isin(*ref_ids))
    if bbox is not None:
        w, s, e, n = buffered(bbox, buffer)
        out = out.where(F.col("lon").between(w, e) & F.col("lat").between(s, n))
    if cropland:
        out = out.where((F.col("ewoc_code") > 1100000000) & (F.col("ewoc_code") < 1115000000))
    if crop_types is not None:
        out = out.where(F.col("ewoc_code").isin(*crop_types))
    return out if least_flag is None else out.where(F.col("extract") >= least_flag)


def query_public_samples(samples: DataFrame, bbox=None, ref_ids=None, buffer: float = 250_000.0, cropland: bool = True, crop_types=None, collateral: bool = True) -> DataFrame:
    """Public samples; collateral ones (flag 0) only where they are wanted."""
    return query_samples(samples, bbox, ref_ids, buffer, cropland, crop_types, 0 if collateral else 1)


def query_private_samples(spark: SparkSession, path: str, bbox=None, ref_ids=None, buffer: float = 250_000.0, cropland: bool = True, crop_types=None) -> DataFrame:
    """The same over a tree of folders by dataset, whatever the flags; a path without files gives no rows."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException as e:
        if (e.getCondition() or "").split(".")[0] not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], SAMPLE_SCHEMA)
    return query_samples(found, bbox, ref_ids, buffer, cropland, crop_types)


def query_samples_union(public: DataFrame, private: DataFrame, legend: DataFrame) -> DataFrame:
    """Public and private samples with their labels, without helper columns; an error when there are none."""
    both = public.withColumn("source", F.lit("public")).unionByName(private.withColumn("source", F.lit("private")), allowMissingColumns=True).drop("feature_index")
    if both.isEmpty():
        raise ValueError("no samples found")
    labels = legend.select("ewoc_code", "label_full", "sampling_label")
    known = F.broadcast(labels) if labels.limit(100_001).count() <= 100_000 else labels
    return both.join(known, "ewoc_code", "left").fillna("Unknown", ["label_full", "sampling_label"])


def sample_totals(samples: DataFrame) -> DataFrame:
    """Samples and crop types by source and dataset, by source, and of all (null for what is summed over)."""
    return samples.rollup("source", "ref_id").agg(F.countDistinct("sample_id").alias("n"), F.countDistinct("label_full").alias("n_types"))


EARTH = 6378137.0
SAMPLE_SCHEMA = "sample_id string, lat double, lon double, ewoc_code bigint, extract int, valid_time date, ref_id string"
BOX = (-110.0, -35.0, 50.0, 35.0)
CODES = tuple(1100000000 + k * 500000 + m * 1000 for k in range(2, 30, 3) for m in range(1, 6))
_W, _S, _E, _N = buffered(BOX, 250_000.0)
_BOX = f"lon BETWEEN {_W!r}e0 AND {_E!r}e0 AND lat BETWEEN {_S!r}e0 AND {_N!r}e0 AND ewoc_code > 1100000000 AND ewoc_code < 1115000000"
_CODES = f"ewoc_code IN ({', '.join(map(str, CODES))})"


def private_tree(samples: DataFrame) -> str:
    """The samples written as folders by dataset."""
    path = scratch(samples.sparkSession, "private")
    samples.select(*(c.split()[0] for c in SAMPLE_SCHEMA.split(", "))).write.partitionBy("ref_id").parquet(path)
    return path


@query("query_public_samples", "samples", sql=f"""SELECT sample_id, ref_id, true AS collateral FROM samples WHERE {_BOX} AND {_CODES} AND extract >= 0
  UNION ALL SELECT sample_id, ref_id, false FROM samples WHERE {_BOX} AND extract >= 1""")
def q_public(samples: DataFrame) -> DataFrame:
    listed = query_public_samples(samples, BOX, crop_types=CODES).select("sample_id", "ref_id", F.lit(True).alias("collateral"))
    return listed.unionByName(query_public_samples(samples, BOX, collateral=False).select("sample_id", "ref_id", F.lit(False).alias("collateral")))


@query("query_private_samples", "samples", sql=f"SELECT sample_id, ref_id FROM samples WHERE {_BOX} AND {_CODES}")
def q_private(samples: DataFrame) -> DataFrame:
    spark = samples.sparkSession
    found = query_private_samples(spark, private_tree(samples), BOX, crop_types=CODES)
    return found.select("sample_id", "ref_id").unionByName(query_private_samples(spark, scratch(spark, "nothing"), BOX).select("sample_id", "ref_id"))


@query("query_samples_union", "samples", "legend", sql=f"""SELECT source, ref_id, count(DISTINCT sample_id) AS n, count(DISTINCT coalesce(label_full, 'Unknown')) AS n_types FROM (SELECT *, 'public' AS source FROM samples WHERE {_BOX} AND extract >= 0
  UNION ALL SELECT *, 'private' FROM samples WHERE {_BOX}) LEFT JOIN legend USING (ewoc_code) GROUP BY ROLLUP (source, ref_id)""")
def q_samples_union(samples: DataFrame, legend: DataFrame) -> DataFrame:
    private = query_private_samples(samples.sparkSession, private_tree(samples), BOX)
    return sample_totals(query_samples_union(query_public_samples(samples, BOX), private, legend))


def _utm(lon: str, lat: str, x: str, y: str, source: str) -> str:
    """SQL of ``source`` (with zone and south) and the UTM coordinates of a point of it."""
    inner = f"(SELECT *, {lon} AS lon_, {lat} AS lat_ FROM ({source}))"
    text = utm_sql("zone", "south").format(inner).replace("radians(lat)", "radians(lat_)").replace("radians(lon -", "radians(lon_ -")
    return f"SELECT * EXCLUDE (x, y, lon_, lat_), x AS {x}, y AS {y} FROM ({text})"


_PIECES = "SELECT iso3, lon AS a0, lat AS b0, lead(lon) OVER (PARTITION BY iso3, ring ORDER BY k) AS a1, lead(lat) OVER (PARTITION BY iso3, ring ORDER BY k) AS b1 FROM outlines"
_MIDDLES = "SELECT iso3, CAST(floor(((min(lon) + max(lon)) / 2 + 180) / 6) + 1 AS INTEGER) AS zone, min(lat) + max(lat) < 0 AS south FROM outlines GROUP BY iso3"
_WELL = f"""pc AS (SELECT * FROM ({_PIECES}) WHERE a1 IS NOT NULL), inn AS (SELECT sample_id, any_value(lon) AS plon, any_value(lat) AS plat, iso3 FROM samples, pc WHERE (b0 > lat) <> (b1 > lat) AND lon < (a1 - a0) * (lat - b0) / (b1 - b0) + a0 GROUP BY sample_id, iso3 HAVING count(*) % 2 = 1),
  ut AS ({_utm('plon', 'plat', 'px', 'py', f'SELECT * FROM inn JOIN ({_MIDDLES}) USING (iso3)')}),
  ue AS ({_utm('a1', 'b1', 'x1', 'y1', _utm('a0', 'b0', 'x0', 'y0', f'SELECT * FROM pc JOIN ({_MIDDLES}) USING (iso3)'))}),
  well AS (SELECT sample_id FROM (SELECT sample_id, iso3, min(sqrt((px - x0 - t * (x1 - x0)) ** 2 + (py - y0 - t * (y1 - y0)) ** 2)) AS d FROM
    (SELECT sample_id, ut.iso3 AS iso3, px, py, x0, y0, x1, y1, least(greatest(((px - x0) * (x1 - x0) + (py - y0) * (y1 - y0)) / ((x1 - x0) ** 2 + (y1 - y0) ** 2), 0), 1) AS t FROM ut JOIN ue USING (iso3)) GROUP BY 1, 2) WHERE d >= 50000)"""


@query("get_reference_samples", "samples", "outlines", sql=f"""WITH {_WELL} SELECT sample_id, ref_id, valid_time FROM samples WHERE sample_id IN (SELECT sample_id FROM well)
  AND valid_time BETWEEN DATE '2020-06-01' AND DATE '2021-06-01' AND {_CODES} AND quality_lc >= 20 AND quality_ct >= 2 AND extract > 0""")
def q_reference_samples(samples: DataFrame, outlines: DataFrame) -> DataFrame:
    """An inset of 50 km, so that it shows among few samples."""
    years = [samples.where(F.col("ref_id").startswith(str(y))) for y in range(2017, 2025)]
    return get_reference_samples(years, outlines, ("2020-06-01", "2021-06-01"), CODES, (20, 2), subset=True, metres=50_000.0).select("sample_id", "ref_id", "valid_time")


def get_reference_samples(datasets: list[DataFrame], extent: DataFrame | None, period=None, codes=None, quality=(0, 0), subset: bool = False, metres: float = 20.0, keys=("iso3",)) -> DataFrame:
    """Union of datasets of points, cut to an extent, by period, codes, least qualities and (``subset``) extract flag.

    The extent is a table of polygons by vertex, ``(keys, ring, k, lon, lat)``, taken in by ``metres`` in UTM; its box
    reaches the scans. Without one, nothing is cut.
    """
    kept = (F.col("quality_lc") >= quality[0]) & (F.col("quality_ct") >= quality[1])
    if extent is not None:
        box = extent.agg(*(f(c).alias(f"{n}_{c}") for c in ("lon", "lat") for n, f in (("a", F.min), ("b", F.max)))).first()
        kept = kept & F.col("lon").between(box["a_lon"], box["b_lon"]) & F.col("lat").between(box["a_lat"], box["b_lat"])
    if period:
        kept = kept & F.col("valid_time").between(*(F.to_date(F.lit(p)) for p in period))
    if codes is not None:
        kept = kept & F.col("ewoc_code").isin(*codes)
    if subset:
        kept = kept & (F.col("extract") > 0)
    out = datasets[0].where(kept)
    for d in datasets[1:]:
        out = out.unionByName(d.where(kept), allowMissingColumns=True)
    return out if extent is None else inset(out, extent, metres, keys)


@query("load_samples_for_extraction", "samples", sql="SELECT sample_id, lat, lon, ref_id FROM samples WHERE extract >= 2")
def load_samples_for_extraction(samples: DataFrame, least: int = 2) -> DataFrame:
    return samples.where(F.col("extract") >= least).select("sample_id", "lat", "lon", "ref_id")


def load_point_extractions(spark: SparkSession, path: str, first_only: bool = False) -> DataFrame:
    """All files of a tree, or the first of them by name."""
    df = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(path)
    if not first_only:
        return df
    first = list_partition_files(spark, path).agg(F.min("path")).first()[0]
    return spark.read.parquet(first)


@query("load_point_extractions", "obs", sql="SELECT sample_id, ts, b02, true AS first FROM obs WHERE ref_id = (SELECT min(ref_id) FROM obs) UNION ALL SELECT sample_id, ts, b02, false FROM obs")
def q_point_extractions(obs: DataFrame) -> DataFrame:
    """One file a dataset, read as a whole and the first alone."""
    path, spark = scratch(obs.sparkSession, "points"), obs.sparkSession
    obs.repartition(F.col("ref_id")).write.partitionBy("ref_id").parquet(path)
    every, first = (load_point_extractions(spark, path, x).select("sample_id", "ts", "b02", F.lit(x).alias("first")) for x in (False, True))
    return first.unionByName(every)


@query("merge_patch_files", "obs_raw", sql="""SELECT DISTINCT sample_id, ts, b02 FROM (SELECT *, dense_rank() OVER (PARTITION BY sample_id ORDER BY line) AS r FROM obs_raw) WHERE r = 1""")
def merge_patch_files(raw: DataFrame) -> DataFrame:
    """Of samples that several files hold, the rows of the earliest file, without repeats (the line number stands for the file)."""
    first = raw.groupBy("sample_id").agg(F.min("line").alias("line"))
    return raw.join(first, ["sample_id", "line"]).select("sample_id", "ts", "b02").distinct()


@query("schema_evolving_append", "obs", "obs_dekad", sql="SELECT sample_id, ts, b02, 65535 AS b04 FROM obs_dekad UNION ALL SELECT sample_id, ts, b02, b04 FROM obs")
def q_append(obs: DataFrame, dekads: DataFrame) -> DataFrame:
    return schema_evolving_append([obs.select("sample_id", "ts", "b02", "b04"), dekads])


@query("load_legend_csv", "legend", sql="SELECT ewoc_code, level_1, level_2, coalesce(nullif(level_3, 'L3-1'), level_2) AS level_3 FROM legend")
def q_legend(legend: DataFrame) -> DataFrame:
    """The legend written with dashes in its codes and gaps in its last level, and loaded."""
    path, code = scratch(legend.sparkSession, "legend"), F.col("ewoc_code").cast("string")
    dashed = F.concat_ws("-", F.substring(code, 1, 2), F.substring(code, 3, 2), F.expr("substr(CAST(ewoc_code AS STRING), 5)"))
    legend.select(dashed.alias("ewoc_code"), "level_1", "level_2", F.nullif("level_3", F.lit("L3-1")).alias("level_3")).write.csv(path, sep=";", header=True)
    levels = ["level_1", "level_2", "level_3"]
    return load_legend_csv(legend.sparkSession, path, levels).select("ewoc_code", *levels)


@query("job_tracking_csv", "jobs", sql="SELECT job, status, duration FROM jobs")
def q_jobs(jobs: DataFrame) -> DataFrame:
    """The tracking columns written as CSV and read."""
    path = scratch(jobs.sparkSession, "jobs")
    jobs.select("job", "status", "duration").write.csv(path, header=True)
    return job_tracking_csv(jobs.sparkSession, path)


@query("merge_partitioned_sink", "obs", sql="SELECT ref_id, count(*) AS n, max(b02) AS top FROM (SELECT ref_id, CASE WHEN ref_id LIKE '2018%' THEN 0 ELSE b02 END AS b02 FROM obs) GROUP BY ref_id")
def q_merge_sink(obs: DataFrame) -> DataFrame:
    """All datasets written, those of one year written again with other values: only their partitions change."""
    path = scratch(obs.sparkSession, "merged")
    merge_partitioned_sink(obs, path)
    merge_partitioned_sink(obs.where(F.col("ref_id").startswith("2018")).withColumn("b02", F.lit(0)), path)
    return obs.sparkSession.read.parquet(path).groupBy("ref_id").agg(F.count("*").alias("n"), F.max("b02").alias("top"))


@query("write_wide_sorted", "obs", sql="SELECT sample_id, ref_id, count(*) AS n FROM obs GROUP BY sample_id, ref_id")
def q_wide(obs: DataFrame) -> DataFrame:
    path = scratch(obs.sparkSession, "wide")
    write_wide_sorted(obs.groupBy("sample_id", "ref_id").agg(F.count("*").alias("n")), path)
    return obs.sparkSession.read.parquet(path)


@query("write_split_files", "samples", sql="SELECT CASE WHEN extract = 0 THEN 'train' ELSE 'test' END AS split, count(*) AS n FROM samples GROUP BY 1")
def q_split_files(samples: DataFrame) -> DataFrame:
    path = scratch(samples.sparkSession, "splits")
    write_split_files(samples.select("sample_id", F.when(F.col("extract") == 0, "train").otherwise("test").alias("split")), path)
    return samples.sparkSession.read.csv(f"{path}/csv", header=True).groupBy("split").agg(F.count("*").alias("n"))


@query("list_partition_files", "obs", sql="SELECT DISTINCT ref_id FROM obs")
def q_list_files(obs: DataFrame) -> DataFrame:
    """The datasets whose leaf files are found under a partitioned tree."""
    path = scratch(obs.sparkSession, "tree")
    merge_partitioned_sink(obs, path)
    return list_partition_files(obs.sparkSession, path).select(ref_id_of(F.col("path")).alias("ref_id")).distinct()
