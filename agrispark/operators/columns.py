"""Projection, standardisation and validation of columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agrispark.functions.bands import BAND_NAMES, NODATA
from agrispark.functions.dates import align_to_composite
from agrispark.registry import query

EXTRACTED = {"b02": "S2-L2A-B02", "b04": "S2-L2A-B04", "b08": "S2-L2A-B08", "vv": "S1-SIGMA0-VV", "vh": "S1-SIGMA0-VH"}


class MissingColumns(ValueError):
    """A table lacks columns that an operator needs."""


def require_columns(df: DataFrame, needed: list[str]) -> DataFrame:
    """The table itself; an error that names the missing columns otherwise. Looks at the schema only."""
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise MissingColumns(", ".join(missing))
    return df


@query("require_columns", "obs", sql="SELECT sample_id, ts FROM obs")
def q_require(obs: DataFrame) -> DataFrame:
    return require_columns(obs, ["sample_id", "ts", "valid_time"]).select("sample_id", "ts")


@query("rename_bands", "obs", sql="""SELECT sample_id, ts, b02 AS "OPTICAL-B02", b04 AS "OPTICAL-B04", b08 AS "OPTICAL-B08", vv AS "SAR-VV", vh AS "SAR-VH" FROM obs""")
def q_rename(obs: DataFrame) -> DataFrame:
    return rename_bands(obs.withColumnsRenamed(EXTRACTED)).drop("valid_time", "ref_id")


def rename_bands(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(BAND_NAMES)


@query("init_missing_features", "obs", sql="SELECT sample_id, ts, b02, 65535 AS b8a FROM obs")
def q_missing(obs: DataFrame) -> DataFrame:
    return init_missing_features(obs, ["b02", "b8a"]).select("sample_id", "ts", "b02", "b8a")


def init_missing_features(df: DataFrame, features: list[str]) -> DataFrame:
    return df.withColumns({c: F.lit(NODATA) for c in features if c not in df.columns})


@query("sar_zero_to_nodata", "obs", sql="""SELECT sample_id, ts, CASE WHEN vv = 0 THEN 65535 ELSE vv END AS vv, CASE WHEN vh = 0 THEN 65535 ELSE vh END AS vh,
  count(*) FILTER (vv = 0) OVER (PARTITION BY sample_id) AS vv_zero FROM obs""")
def sar_zero_to_nodata(obs: DataFrame) -> DataFrame:
    """Zero radar values are nodata; how many a sample had is kept beside them."""
    zeros = F.count(F.when(F.col("vv") == 0, 1)).over(Window.partitionBy("sample_id"))
    fixed = {c: F.when(F.col(c) == 0, NODATA).otherwise(F.col(c)) for c in ("vv", "vh")}
    return obs.withColumn("vv_zero", zeros).withColumns(fixed).select("sample_id", "ts", "vv", "vh", "vv_zero")


@query("split_index_columns", "obs", sql="SELECT sample_id, ts, ref_id, valid_time FROM obs")
def split_index_columns(obs: DataFrame, features=("b02", "b04", "b08", "vv", "vh")) -> DataFrame:
    """The index columns: all but features that take no more distinct values than there are samples (one aggregation)."""
    index = [c for c in obs.columns if c not in (*features, "ts", "sample_id")]
    n = obs.agg(F.countDistinct("sample_id").alias("_n"), *(F.countDistinct(c).alias(c) for c in index)).first()
    return obs.select("sample_id", "ts", *(c for c in index if n[c] <= n["_n"]))


@query("normalise_timestamps", "events_", sql="SELECT event_id, CAST(ts AS DATE) AS ts, CAST(ts AS TIMESTAMP) AS valid_time FROM events_")
def normalise_timestamps(events: DataFrame) -> DataFrame:
    """Dates floored to the day; validity times keep their time of day, without a zone."""
    return events.select("event_id", F.to_date("ts").alias("ts"), F.col("ts").cast("timestamp_ntz").alias("valid_time"))


@query("validate_composite_dates", "obs_raw", sql="SELECT sample_id, count(*) AS n_off, min(ts) AS first_off FROM obs_raw WHERE day(ts) NOT IN (1, 11, 21) GROUP BY sample_id")
def validate_composite_dates(raw: DataFrame, freq: str = "dekad") -> DataFrame:
    """Violations: dates that aren't the start of a composite, by sample."""
    off = raw.where(F.col("ts") != align_to_composite(F.col("ts"), freq))
    return off.groupBy("sample_id").agg(F.count("*").alias("n_off"), F.min("ts").alias("first_off"))


@query("infer_dataset_name", "obs", sql="SELECT DISTINCT sample_id, regexp_extract(sample_id, '^(.*)_[^_]*$', 1) AS dataset FROM obs")
def infer_dataset_name(obs: DataFrame) -> DataFrame:
    """The sample id without its last part."""
    return obs.select("sample_id", F.regexp_extract("sample_id", r"^(.*)_[^_]*$", 1).alias("dataset")).distinct()


@query("post_extract_normalise", "obs", sql="""SELECT sample_id, ts, CAST(substr(ref_id, 1, 4) AS INTEGER) AS year, coalesce(nullif(b02, 0), 65535) AS b02, 65535 AS b8a
  FROM (SELECT *, bool_and(vv = 0 AND b02 < 5) OVER (PARTITION BY sample_id) AS empty FROM obs) WHERE NOT empty""")
def post_extract_normalise(obs: DataFrame) -> DataFrame:
    """Absent bands and nulls are nodata; samples without any value go; the year comes from the dataset id."""
    empty = F.bool_and((F.col("vv") == 0) & (F.col("b02") < 5)).over(Window.partitionBy("sample_id"))
    kept = obs.withColumn("_e", empty).where(~F.col("_e"))
    return init_missing_features(kept, ["b8a"]).select(
        "sample_id", "ts", F.substring("ref_id", 1, 4).cast("int").alias("year"), F.coalesce(F.nullif("b02", F.lit(0)), F.lit(NODATA)).alias("b02"), "b8a"
    )


@query("validate_temporal_context", "jobs", sql="""SELECT job, CAST(date_trunc('month', start_date) AS DATE) AS snapped_start, last_day(end_date) AS snapped_end,
  day(start_date) = 1 AND end_date = last_day(end_date) AND end_date - start_date <= 365 AS ok FROM jobs""")
def validate_temporal_context(jobs: DataFrame) -> DataFrame:
    """Whether a period starts on day 1, ends on a month's end and spans 365 days at most, and the period snapped to months."""
    good = (F.dayofmonth("start_date") == 1) & (F.col("end_date") == F.last_day("end_date")) & (F.datediff("end_date", "start_date") <= 365)
    return jobs.select("job", F.trunc("start_date", "month").alias("snapped_start"), F.last_day("end_date").alias("snapped_end"), good.alias("ok"))


@query("validate_s1_range", "obs", sql="SELECT min(vv) AS low, max(vv) AS high, min(vv) >= 1 AND max(vv) <= 65535 AS ok FROM obs WHERE vv <> 65535")
def validate_s1_range(obs: DataFrame) -> DataFrame:
    return obs.where(F.col("vv") != NODATA).agg(F.min("vv").alias("low"), F.max("vv").alias("high")).withColumn("ok", F.expr("low >= 1 AND high <= 65535"))


@query("mask_band_nodata", "obs", sql="SELECT sample_id, ts, b02, 65535 AS b08, true AS masked FROM obs UNION ALL SELECT sample_id, ts, b02, b08, false FROM obs")
def q_mask_band_nodata(obs: DataFrame) -> DataFrame:
    rows = obs.select("sample_id", "ts", "b02", "b08")
    return mask_band_nodata(rows).withColumn("masked", F.lit(True)).unionByName(mask_band_nodata(rows, enabled=False).withColumn("masked", F.lit(False)))


def mask_band_nodata(obs: DataFrame, band: str = "b08", enabled: bool = True) -> DataFrame:
    """The band as nodata throughout, where that is switched on."""
    return obs.withColumn(band, F.lit(NODATA)) if enabled else obs


@query("normalise_label_columns", "samples", sql="""SELECT sample_id, landcover AS finetune_class, landcover AS downstream_class,
  CAST(dense_rank() OVER (ORDER BY landcover) - 1 AS INTEGER) AS class_index FROM samples""")
def normalise_label_columns(samples: DataFrame) -> DataFrame:
    """The two class columns mirror one another; classes are numbered in sorted order.

    The order is taken over the distinct classes, a table of a few rows, not over the samples.
    """
    names = samples.select("landcover").distinct()
    ranks = names.select("landcover", (F.row_number().over(Window.orderBy("landcover")) - 1).alias("class_index"))
    label = F.coalesce("landcover")
    return samples.join(F.broadcast(ranks) if ranks.count() <= 10_000 else ranks, "landcover").select(
        "sample_id", label.alias("finetune_class"), label.alias("downstream_class"), "class_index"
    )


@query("drop_removed_and_off_season", "samples", sql="""SELECT sample_id, landcover FROM (SELECT *, month(valid_time) BETWEEN 4 AND 9 AS f FROM samples WHERE landcover <> 'Brand#11')
  WHERE f OR NOT (SELECT bool_or(month(valid_time) BETWEEN 4 AND 9) FROM samples WHERE landcover <> 'Brand#11')""")
def drop_removed_and_off_season(samples: DataFrame, removed: str = "Brand#11") -> DataFrame:
    """Rows of the removed class go; if any row is in season, the others go too."""
    flagged = samples.where(F.col("landcover") != removed).withColumn("f", F.month("valid_time").between(4, 9))
    if flagged.where("f").isEmpty():
        return flagged.select("sample_id", "landcover")
    return flagged.where("f").select("sample_id", "landcover")


@query("season_columns_to_json", "jobs", sql="""SELECT job, 's1' AS season_ids, concat('{"s1":["', CAST(start_date AS VARCHAR), '","', CAST(end_date AS VARCHAR), '"]}') AS season_windows FROM jobs""")
def season_columns_to_json(jobs: DataFrame, seasons: tuple[str, ...] = ("s1",)) -> DataFrame:
    """Start and end columns of each season as a JSON object of windows; incomplete pairs are left out."""
    entries = F.array(*(F.struct(F.lit(s).alias("k"), F.array(F.col("start_date").cast("string"), F.col("end_date").cast("string")).alias("v")) for s in seasons))
    windows = F.map_filter(F.map_from_entries(entries), lambda k, v: ~F.exists(v, lambda x: x.isNull()))
    return jobs.select("job", F.array_join(F.map_keys(windows), ",").alias("season_ids"), F.to_json(windows).alias("season_windows"))


@query("validate_work_table", "jobs", sql="""SELECT job, start_date > end_date AS reversed, count(*) OVER (PARTITION BY job) > 1 AS repeated,
  k = 0 OR (k = 1 AND start_date < end_date) OR (k > 1 AND start_date > end_date) AS bad_json FROM (SELECT *, CAST(substr(job, 2) AS BIGINT) % 7 AS k FROM jobs)""")
def q_validate_work_table(jobs: DataFrame) -> DataFrame:
    """A seventh of the rows has windows that don't parse, a seventh has them turned round."""
    k = F.expr("substr(job, 2)").cast("long") % 7
    a, b = F.col("start_date").cast("string"), F.col("end_date").cast("string")
    text = F.when(k == 0, "{broken").when(k == 1, F.to_json(F.create_map(F.lit("s1"), F.array(b, a)))).otherwise(F.to_json(F.create_map(F.lit("s1"), F.array(a, b))))
    return validate_work_table(jobs.withColumn("season_windows", text))


def validate_work_table(jobs: DataFrame) -> DataFrame:
    """Violations of each row: reversed dates, repeated names, season windows that don't parse or whose dates are not two in order."""
    missing = {"job", "start_date", "end_date", "season_windows"} - set(jobs.columns)
    if missing:
        raise ValueError(f"columns are missing: {sorted(missing)}")
    windows = F.map_values(F.from_json("season_windows", "map<string,array<string>>"))
    wrong = F.exists(windows, lambda w: F.coalesce((F.size(w) != 2) | (F.try_to_date(F.get(w, 0)) > F.try_to_date(F.get(w, 1))), F.lit(True)))
    return jobs.select(
        "job", (F.col("start_date") > F.col("end_date")).alias("reversed"),
        (F.count("*").over(Window.partitionBy("job")) > 1).alias("repeated"), F.coalesce(wrong, F.lit(True)).alias("bad_json"),
    )


@query("resolve_temporal_and_seasons", "jobs", sql="""SELECT job, CASE WHEN status = 'finished' THEN start_date ELSE DATE '1999-01-01' END AS start_date,
  CASE WHEN status = 'finished' THEN end_date ELSE DATE '1999-12-31' END AS end_date, CASE WHEN status = 'finished' THEN 'grid' ELSE 'user' END AS origin FROM jobs""")
def resolve_temporal_and_seasons(jobs: DataFrame, user: tuple[str, str] = ("1999-01-01", "1999-12-31")) -> DataFrame:
    """The period of the grid row where it has one, else the user's."""
    own = F.col("status") == "finished"
    a, b = (F.to_date(F.lit(x)) for x in user)
    return jobs.select(
        "job", F.when(own, F.col("start_date")).otherwise(a).alias("start_date"), F.when(own, F.col("end_date")).otherwise(b).alias("end_date"),
        F.when(own, "grid").otherwise("user").alias("origin"),
    )


@query("filter_extract_flag", "samples", sql="SELECT ref_id, count(*) AS n FROM samples WHERE extract = 1 GROUP BY ref_id")
def filter_extract_flag(samples: DataFrame, value: int = 1) -> DataFrame:
    """Features with the exact flag, counted by dataset."""
    return samples.where(F.col("extract") == value).groupBy("ref_id").agg(F.count("*").alias("n"))


@query("sample_attributes", "samples", sql="""SELECT sample_id, nullif(trim(croptype), '') AS croptype, CASE WHEN extract = 1 THEN landcover ELSE 'unknown' END AS region, valid_time AS label_date,
  nullif(CAST(quality_lc AS INTEGER), 65535) AS quality, CASE WHEN p IS NOT NULL AND p - greatest(0, least(p - 6, 9)) < 12 THEN p - greatest(0, least(p - 6, 9)) END AS valid_position
  FROM (SELECT *, CASE WHEN extract < 2 THEN CAST(quality_ct AS INTEGER) * 4 END AS p FROM samples)""")
def q_sample_attributes(samples: DataFrame) -> DataFrame:
    """Only samples of one flag have a region, others have blanks or none; windows of 12 of 21 steps, with positions before, in and behind them."""
    region = F.when(F.col("extract") == 1, F.col("landcover")).when(F.col("extract") == 0, F.lit("  "))
    position = F.when(F.col("extract") < 2, F.col("quality_ct").cast("int") * 4)
    start = F.greatest(F.lit(0), F.least(position - 6, F.lit(9)))
    return sample_attributes(samples.withColumns({"region": region, "label_date": F.lit(None).cast("date"), "valid_position": position, "window_start": start}), 12)


def sample_attributes(samples: DataFrame, steps: int) -> DataFrame:
    """Known attributes with missing values (blank, nodata) as null, a default region, the first label date there is, and the valid position.

    The position counts from ``window_start``, the first of the sample's ``steps`` steps; one outside the window is null.
    """
    known = lambda c: F.nullif(F.trim(c), F.lit(""))
    at = F.col("valid_position") - F.col("window_start")
    return samples.select(
        "sample_id", known("croptype").alias("croptype"), F.coalesce(known("region"), F.lit("unknown")).alias("region"),
        F.coalesce("label_date", "valid_time").alias("label_date"), F.nullif(F.col("quality_lc").cast("int"), F.lit(NODATA)).alias("quality"),
        F.when(at.between(0, steps - 1), at).alias("valid_position"),
    )


@query("ordered_dedupe", "obs", sql="""SELECT sample_id, string_agg(CAST(b02 AS VARCHAR), ',' ORDER BY ts) AS values_in_order
  FROM (SELECT sample_id, b02, min(ts) AS ts FROM obs GROUP BY sample_id, b02) GROUP BY sample_id""")
def ordered_dedupe(obs: DataFrame) -> DataFrame:
    """Distinct values in order of first appearance."""
    rows = F.array_sort(F.collect_list(F.struct("ts", "b02")))
    values = F.array_distinct(F.transform(rows, lambda r: r["b02"].cast("string")))
    return obs.groupBy("sample_id").agg(F.array_join(values, ",").alias("values_in_order"))
