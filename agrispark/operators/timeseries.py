"""Time series keyed by sample and date: cleaning, gap filling, positions, trimming, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from agrispark.functions import dates
from agrispark.functions.bands import NODATA, RESOLUTION, ndvi, ndvi_scaled, scaled, valid
from agrispark.registry import query
from agrispark.storage import dealt

BANDS = ("b02", "b04", "b08", "vv", "vh")
CADENCE_DAYS = {"month": 31, "dekad": 10}


def by_sample() -> WindowSpec:
    return Window.partitionBy("sample_id")


def in_order() -> WindowSpec:
    return by_sample().orderBy("ts")


@query("dedupe_sample_timestamp", "obs_raw", sql="""
  SELECT sample_id, ts, seq, line, b02, copies FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, ts ORDER BY seq, line) AS r,
    count(*) OVER (PARTITION BY sample_id, ts) AS copies FROM obs_raw) WHERE r = 1""")
def q_dedupe(raw: DataFrame) -> DataFrame:
    return dedupe_sample_timestamp(raw, ["seq", "line"]).select("sample_id", "ts", "seq", "line", "b02", "copies")


def dedupe_sample_timestamp(df: DataFrame, order: list[str]) -> DataFrame:
    """The first row of each (sample, date) in the given order, with the number of copies."""
    key = Window.partitionBy("sample_id", "ts")
    return (
        df.withColumn("_r", F.row_number().over(key.orderBy(*order))).withColumn("copies", F.count("*").over(key))
        .where("_r = 1").drop("_r")
    )


def lag_gap(df: DataFrame) -> DataFrame:
    """Days since the sample's date before."""
    return df.withColumn("gap", F.datediff("ts", F.lag("ts").over(in_order())))


@query("lag_gap", "obs", sql="SELECT sample_id, ts, CAST(ts - lag(ts) OVER (PARTITION BY sample_id ORDER BY ts) AS INTEGER) AS gap FROM obs")
def q_lag_gap(obs: DataFrame) -> DataFrame:
    return lag_gap(obs).select("sample_id", "ts", "gap")


def median_cadence_filter(df: DataFrame, freq: str = "month", tolerance: int = 2) -> DataFrame:
    """Samples whose median gap, cut to whole days, is within the tolerance of the cadence; single rows count as 0."""
    good = (
        lag_gap(df).groupBy("sample_id").agg(F.coalesce(F.median("gap"), F.lit(0)).cast("int").alias("m"))
        .where(F.abs(F.col("m") - CADENCE_DAYS[freq]) <= tolerance)
    )
    return df.join(good.select("sample_id"), "sample_id", "left_semi")


@query("median_cadence_filter", "obs", sql="""
  WITH g AS (SELECT sample_id, ts - lag(ts) OVER (PARTITION BY sample_id ORDER BY ts) AS gap FROM obs),
  good AS (SELECT sample_id FROM g GROUP BY sample_id HAVING abs(trunc(coalesce(median(gap), 0)) - 31) <= 2)
  SELECT sample_id, ts, b02 FROM obs WHERE sample_id IN (SELECT sample_id FROM good)""")
def q_cadence(obs: DataFrame) -> DataFrame:
    return median_cadence_filter(obs).select("sample_id", "ts", "b02")


def series_bounds(df: DataFrame) -> DataFrame:
    return df.withColumn("start_date", F.min("ts").over(by_sample())).withColumn("end_date", F.max("ts").over(by_sample()))


@query("series_bounds", "obs", sql="""SELECT sample_id, ts, min(ts) OVER (PARTITION BY sample_id) AS start_date,
  max(ts) OVER (PARTITION BY sample_id) AS end_date FROM obs""")
def q_bounds(obs: DataFrame) -> DataFrame:
    return series_bounds(obs).select("sample_id", "ts", "start_date", "end_date")


@query("expected_dates", "obs", sql="""
  SELECT sample_id, CAST(unnest(generate_series(min(ts), max(ts), INTERVAL 1 MONTH)) AS DATE) AS ts FROM obs GROUP BY sample_id""")
def expected_dates(obs: DataFrame, freq: str = "month") -> DataFrame:
    """One row for each slot between a sample's first and last date."""
    spans = obs.groupBy("sample_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return spans.select("sample_id", F.explode(dates.enumerate_slots(F.col("a"), F.col("b"), freq)).alias("ts"))


def gap_fill(df: DataFrame, freq: str, features: tuple[str, ...], carried: tuple[str, ...]) -> DataFrame:
    """Every expected slot within a sample's own span; missing features are nodata, carried columns are the sample's least.

    Dates are those of slots. One shuffle by sample: each row fills the slots up to the next one of its sample.
    """
    of_sample = Window.partitionBy("sample_id")
    following = F.lead("ts").over(of_sample.orderBy("ts"))
    rows = df.select("sample_id", "ts", *features, following.alias("_next"), *(F.min(c).over(of_sample).alias(c) for c in carried))
    gap = F.filter(dates.enumerate_slots(F.col("ts"), F.col("_next"), freq), lambda t: (t > F.col("ts")) & (t < F.col("_next")))
    slots = F.concat(F.array("ts"), F.coalesce(F.when(F.col("_next") > F.col("ts"), gap), F.array().cast("array<date>")))
    filled_ = rows.withColumn("_slot", F.explode(slots))
    return filled_.select(
        "sample_id", F.col("_slot").alias("ts"), *carried,
        *(F.when(F.col("_slot") == F.col("ts"), F.coalesce(c, F.lit(NODATA))).otherwise(NODATA).alias(c) for c in features),
    )


def filled(obs: DataFrame) -> DataFrame:
    return gap_fill(dealt(obs, "sample_id"), "month", BANDS, ("valid_time", "ref_id"))


_FILLED = """filled AS (SELECT e.sample_id, e.ts, e.valid_time, e.ref_id, coalesce(b02, 65535) AS b02, coalesce(b04, 65535) AS b04,
    coalesce(b08, 65535) AS b08, coalesce(vv, 65535) AS vv, coalesce(vh, 65535) AS vh
  FROM (SELECT sample_id, any_value(valid_time) AS valid_time, any_value(ref_id) AS ref_id,
        CAST(unnest(generate_series(min(ts), max(ts), INTERVAL 1 MONTH)) AS DATE) AS ts FROM obs GROUP BY sample_id) e
  LEFT JOIN obs o ON o.sample_id = e.sample_id AND o.ts = e.ts)"""


@query("gap_fill", "obs", sql=f"WITH {_FILLED} SELECT * FROM filled")
def q_gap_fill(obs: DataFrame) -> DataFrame:
    return filled(obs)


def timestamp_index(df: DataFrame) -> DataFrame:
    return df.withColumn("ind", F.row_number().over(in_order()) - 1)


@query("timestamp_index", "obs", sql=f"""WITH {_FILLED} SELECT sample_id, ts,
  CAST(row_number() OVER (PARTITION BY sample_id ORDER BY ts) - 1 AS INTEGER) AS ind FROM filled""")
def q_index(obs: DataFrame) -> DataFrame:
    return timestamp_index(filled(obs)).select("sample_id", "ts", "ind")


def valid_position(df: DataFrame) -> DataFrame:
    """Index of the date nearest to the validity date (the lowest of ties), and the position relative to it."""
    near = F.struct(F.abs(F.datediff("valid_time", "ts")), "ind")
    return df.withColumn("valid_position", F.min_by("ind", near).over(by_sample())).withColumn(
        "valid_position_diff", F.col("ind") - F.col("valid_position")
    )


_IND = _FILLED + """, indexed AS (SELECT *, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY ts) - 1 AS INTEGER) AS ind FROM filled),
  placed AS (SELECT *, first_value(ind) OVER (PARTITION BY sample_id ORDER BY abs(valid_time - ts), ind) AS valid_position FROM indexed)"""


def placed(obs: DataFrame) -> DataFrame:
    return valid_position(timestamp_index(filled(obs)))


@query("valid_position", "obs", sql=f"WITH {_IND} SELECT sample_id, ts, ind, valid_position, ind - valid_position AS valid_position_diff FROM placed")
def q_valid_position(obs: DataFrame) -> DataFrame:
    return placed(obs).select("sample_id", "ts", "ind", "valid_position", "valid_position_diff")


def edge_buffer_filter(df: DataFrame, buffer: int) -> DataFrame:
    """Samples whose valid position is at least ``buffer`` steps from both ends."""
    last = F.max("ind").over(by_sample())
    return df.withColumn("_last", last).where((F.col("_last") - F.col("valid_position") >= buffer) & (F.col("valid_position") >= buffer)).drop("_last")


@query("edge_buffer_filter", "obs", sql=f"""WITH {_IND} SELECT sample_id, ts, ind FROM (SELECT *, max(ind) OVER (PARTITION BY sample_id) AS l FROM placed)
  WHERE l - valid_position >= 4 AND valid_position >= 4""")
def q_edge(obs: DataFrame) -> DataFrame:
    return edge_buffer_filter(placed(obs), 4).select("sample_id", "ts", "ind")


def trim_series(df: DataFrame, steps: int | str | tuple, buffer: int = 2, least_steps: int = 12, use_valid_time: bool = True) -> DataFrame:
    """A window of each series: ``auto`` (least steps plus both buffers), a number of steps, or a (start, end) date range.

    A window of steps is centred on the valid position (or the middle) and shifted inward at the edges. A range drops
    samples valid outside it and those left with fewer than the least steps. Indexes and positions are made anew.
    """
    if isinstance(steps, tuple):
        a, b = (F.to_date(F.lit(x)) for x in steps)
        out = df.where(F.col("ts").between(a, b))
        if use_valid_time:
            out = out.where(F.col("valid_time").between(a, b))
        out = out.withColumn("_n", F.count("*").over(by_sample())).where(F.col("_n") >= least_steps).drop("_n")
    else:
        size = least_steps + 2 * buffer if steps == "auto" else steps
        n = F.count("*").over(by_sample())
        centre = F.col("valid_position") if use_valid_time else F.floor(F.col("_n") / 2)
        left = F.greatest(F.lit(0), F.least(centre - size // 2, F.col("_n") - size))
        out = df.withColumn("_n", n).where((F.col("ind") >= left) & (F.col("ind") < left + size)).drop("_n")
    return valid_position(timestamp_index(out.drop("valid_position", "valid_position_diff", "ind")))


@query("trim_series", "obs", sql=f"""WITH {_IND}, cut AS (SELECT *, count(*) OVER (PARTITION BY sample_id) AS n FROM placed)
  SELECT sample_id, ts, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY ts) - 1 AS INTEGER) AS ind FROM cut
  WHERE ind >= greatest(0, least(valid_position - 8, n - 16)) AND ind < greatest(0, least(valid_position - 8, n - 16)) + 16""")
def q_trim(obs: DataFrame) -> DataFrame:
    return trim_series(placed(obs), "auto").select("sample_id", "ts", "ind")


def faulty_center_filter(spans: DataFrame, buffer: int, steps: int) -> DataFrame:
    """Rows whose validity date is within the span and that admit a centre for a window of ``steps``."""
    half = steps // 2
    low = F.greatest(F.lit(half), F.col("valid_position") + buffer - half)
    high = F.least(F.col("n") - half, F.col("valid_position") - buffer + half)
    return spans.where(F.col("valid_time").between(F.col("start_date"), F.col("end_date")) & (low <= high))


def spans_of(df: DataFrame) -> DataFrame:
    return df.groupBy("sample_id").agg(
        F.min("ts").alias("start_date"), F.max("ts").alias("end_date"), F.count("*").alias("n"),
        F.min("valid_time").alias("valid_time"), F.min("valid_position").alias("valid_position"), F.min("ref_id").alias("ref_id"),
    )


_SPANS = _IND + """, spans AS (SELECT sample_id, min(ts) AS start_date, max(ts) AS end_date, count(*) AS n, any_value(valid_time) AS valid_time,
  any_value(valid_position) AS valid_position, any_value(ref_id) AS ref_id FROM placed GROUP BY sample_id)"""


@query("faulty_center_filter", "obs", sql=f"""WITH {_SPANS} SELECT sample_id, n, valid_position FROM spans WHERE valid_time BETWEEN start_date AND end_date
  AND greatest(6, valid_position + 2 - 6) <= least(n - 6, valid_position - 2 + 6)""")
def q_faulty(obs: DataFrame) -> DataFrame:
    return faulty_center_filter(spans_of(placed(obs)), 2, 12).select("sample_id", "n", "valid_position")


def min_timesteps_filter(spans: DataFrame, least: int) -> DataFrame:
    return spans.where(F.col("n") >= least)


@query("min_timesteps_filter", "obs", sql=f"WITH {_SPANS} SELECT sample_id, n FROM spans WHERE n >= 36")
def q_min_steps(obs: DataFrame) -> DataFrame:
    return min_timesteps_filter(spans_of(placed(obs)), 36).select("sample_id", "n")


def pivot_long_to_wide(df: DataFrame, features: tuple[str, ...], steps: int) -> DataFrame:
    """One row a sample with ``<band>-ts<i>-<resolution>m`` columns, nodata where a step is missing.

    A series of more than ``steps`` goes on in further rows; ``first_step`` is the index of their ``ts0``. Pivot values
    are given, so no extra job looks for them.
    """
    at = F.col("ind") % steps
    rows = df.withColumns({"first_step": (F.col("ind") - at).cast("int"), "_step": at})
    wide = rows.groupBy("sample_id", "start_date", "first_step").pivot("_step", list(range(steps))).agg(*(F.first(f).alias(f) for f in features))
    return wide.select(
        "sample_id", F.col("start_date").cast("string").alias("start_date"), F.year("start_date").alias("year"), "first_step",
        *(F.coalesce(F.col(f"{i}_{f}"), F.lit(NODATA)).alias(f"{f}-ts{i}-{RESOLUTION[f]}m") for i in range(steps) for f in features),
    )


#: Months in a row of the wide table: the seven years that the tables' dates span.
WIDE_STEPS = 84


@query("pivot_long_to_wide", "obs", sql=f"""WITH {_IND}, started AS (SELECT *, min(ts) OVER (PARTITION BY sample_id) AS start_date, CAST(ind // {WIDE_STEPS} * {WIDE_STEPS} AS INTEGER) AS first_step FROM placed)
  SELECT sample_id, CAST(start_date AS VARCHAR) AS start_date, CAST(year(start_date) AS INTEGER) AS year, first_step,
  {", ".join(f'coalesce(max({b}) FILTER (ind - first_step = {i}), 65535) AS "{b}-ts{i}-{RESOLUTION[b]}m"' for i in range(WIDE_STEPS) for b in BANDS)}
  FROM started GROUP BY sample_id, start_date, first_step""")
def q_pivot(obs: DataFrame) -> DataFrame:
    return pivot_long_to_wide(series_bounds(placed(obs)), BANDS, WIDE_STEPS)


@query("band_resolution_suffix", "obs", sql="""SELECT sample_id, ts, b02 AS "b02-10m", b04 AS "b04-10m", b08 AS "b08-10m", vv AS "vv-20m", vh AS "vh-20m" FROM obs""")
def band_resolution_suffix(obs: DataFrame) -> DataFrame:
    return obs.select("sample_id", "ts", *(F.col(b).alias(f"{b}-{RESOLUTION[b]}m") for b in BANDS))


@query("step_index_arithmetic", "obs_raw", sql="""SELECT sample_id, ts, seq, line, CAST(year(ts) * 12 + month(ts) - 1 AS INTEGER) AS month_step,
  CAST((year(ts) * 12 + month(ts) - 1) * 3 + least(2, (day(ts) - 1) // 10) AS INTEGER) AS dekad_step,
  CAST(((year(ts) * 12 + month(ts) - 1) * 3 + least(2, (day(ts) - 1) // 10)) % 36 AS INTEGER) AS dekad_in_year FROM obs_raw""")
def step_index_arithmetic(raw: DataFrame) -> DataFrame:
    ts = F.col("ts")
    return raw.select(
        "sample_id", "ts", "seq", "line", dates.step_ordinal(ts).cast("int").alias("month_step"),
        dates.step_ordinal(ts, "dekad").cast("int").alias("dekad_step"), dates.step_in_year(ts, "dekad").cast("int").alias("dekad_in_year"),
    )


def best_valid_time(valid: Column, start: Column, end: Column, forward: Column, backward: Column, buffer: int, steps: int, freq: str = "month") -> Column:
    """The validity date moved forward or backward so that a window of ``steps`` round it lies in the series.

    A shift is possible when the moved date keeps half a window and the buffer inside the span. When both are, the
    backward one is taken if it is longer by no more than the edge.
    """
    edge = steps // 2
    at, a, b = (dates.step_ordinal(c, freq) for c in (valid, start, end))

    def fits(moved: Column) -> Column:
        return (moved - edge + buffer >= a) & (moved + edge - buffer <= b)

    ahead, behind = at + forward, at - backward
    chosen = F.when(
        fits(ahead) & fits(behind), F.when(backward - forward <= edge, behind).otherwise(ahead)
    ).when(fits(ahead), ahead).when(fits(behind), behind)
    return dates.step_date(chosen, freq)


_BEST = """SELECT sample_id, ref_id, valid_time, start_date, end_date,
  year(valid_time) * 12 + month(valid_time) - 1 AS pos, year(start_date) * 12 + month(start_date) - 1 AS a, year(end_date) * 12 + month(end_date) - 1 AS b,
  (7 - month(valid_time) + 12) % 12 AS f, (month(valid_time) - 7 + 12) % 12 AS w FROM spans"""
_BEST_CASE = """CASE WHEN pos + f - 5 >= a AND pos + f + 5 <= b AND pos - w - 5 >= a AND pos - w + 5 <= b THEN CASE WHEN w - f <= 6 THEN pos - w ELSE pos + f END
  WHEN pos + f - 5 >= a AND pos + f + 5 <= b THEN pos + f WHEN pos - w - 5 >= a AND pos - w + 5 <= b THEN pos - w END"""


def with_best_valid_time(spans: DataFrame, middle_month: int, buffer: int, steps: int) -> DataFrame:
    forward = F.pmod(F.lit(middle_month) - F.month("valid_time"), F.lit(12))
    backward = F.pmod(F.month("valid_time") - middle_month, F.lit(12))
    cols = (F.col(c) for c in ("valid_time", "start_date", "end_date"))
    return spans.withColumn("best_valid_time", best_valid_time(*cols, forward, backward, buffer, steps))


@query("best_valid_time", "obs", sql=f"""WITH {_SPANS}, o AS ({_BEST}), k AS (SELECT *, {_BEST_CASE} AS c FROM o)
  SELECT sample_id, valid_time, make_date(c // 12, c % 12 + 1, 1) AS best_valid_time FROM k""")
def q_best(obs: DataFrame) -> DataFrame:
    return with_best_valid_time(spans_of(placed(obs)), 7, 1, 12).select("sample_id", "valid_time", "best_valid_time")


def align_to_processing_period(obs: DataFrame, middle_month: int, buffer: int = 1, steps: int = 12) -> DataFrame:
    """Series cut to ``steps`` round the best validity date; samples that none fits are dropped."""
    p = placed(obs)
    best = with_best_valid_time(spans_of(p), middle_month, buffer, steps).where("best_valid_time is not null")
    joined = p.join(best.select("sample_id", F.col("best_valid_time").alias("_best")), "sample_id")
    moved = joined.withColumn("true_valid_time", F.col("valid_time")).withColumn("valid_time", F.col("_best")).drop("_best")
    out = trim_series(valid_position(moved), steps)
    return out.withColumn("valid_time", F.col("true_valid_time")).drop("true_valid_time")


_ALIGNED = f"""{_SPANS}, o AS ({_BEST}), k AS (SELECT *, {_BEST_CASE} AS c FROM o),
  moved AS (SELECT p.* EXCLUDE (valid_position), k.c, p.ind AS i, count(*) OVER (PARTITION BY p.sample_id) AS cnt,
    first_value(p.ind) OVER (PARTITION BY p.sample_id ORDER BY abs(make_date(k.c // 12, k.c % 12 + 1, 1) - p.ts), p.ind) AS vp
    FROM placed p JOIN k ON k.sample_id = p.sample_id WHERE k.c IS NOT NULL),
  aligned AS (SELECT * FROM moved WHERE i >= greatest(0, least(vp - 6, cnt - 12)) AND i < greatest(0, least(vp - 6, cnt - 12)) + 12)"""


@query("align_to_processing_period", "obs", sql=f"WITH {_ALIGNED} SELECT sample_id, ts, valid_time, b02 FROM aligned")
def q_align(obs: DataFrame) -> DataFrame:
    return align_to_processing_period(obs, 7).select("sample_id", "ts", "valid_time", "b02")


@query("align_to_season", "obs", sql=f"""WITH {_ALIGNED} SELECT sample_id, ts, CAST(substr(ref_id, 1, 4) AS INTEGER) AS year, b02 FROM aligned
  WHERE month(valid_time) BETWEEN 4 AND 9""")
def align_to_season(obs: DataFrame, first_month: int = 4, last_month: int = 9) -> DataFrame:
    """The aligned series of samples valid within the season's months, with the dataset's year."""
    out = align_to_processing_period(obs, 7).where(F.month("valid_time").between(first_month, last_month))
    return out.select("sample_id", "ts", F.substring("ref_id", 1, 4).cast("int").alias("year"), "b02")


def temporal_subset(df: DataFrame, start: str, end: str, least_coverage: float, features: tuple[str, ...]) -> DataFrame:
    """The season's slots of each sample with a large enough share present; missing slots are nodata."""
    slots = dates.enumerate_slots(F.to_date(F.lit(start)), F.to_date(F.lit(end)))
    wanted = df.select("sample_id").distinct().select("sample_id", F.explode(slots).alias("ts"))
    joined = wanted.join(df.select("sample_id", "ts", *features), ["sample_id", "ts"], "left")
    share = F.count(features[0]).over(by_sample()) / F.count("*").over(by_sample())
    return joined.withColumn("coverage", F.round(share, 6)).where(F.col("coverage") >= least_coverage).select(
        "sample_id", "ts", "coverage", *(F.coalesce(f, F.lit(NODATA)).alias(f) for f in features)
    )


@query("temporal_subset", "obs", sql="""WITH w AS (SELECT DISTINCT sample_id, CAST(t AS DATE) AS ts FROM obs,
    (SELECT unnest(generate_series(DATE '1998-01-01', DATE '1998-12-01', INTERVAL 1 MONTH)) AS t)),
  j AS (SELECT w.sample_id, w.ts, b02, round(count(b02) OVER (PARTITION BY w.sample_id) * 1e0 / count(*) OVER (PARTITION BY w.sample_id), 6) AS coverage
    FROM w LEFT JOIN obs o ON o.sample_id = w.sample_id AND o.ts = w.ts)
  SELECT sample_id, ts, coverage, coalesce(b02, 65535) AS b02 FROM j WHERE coverage >= 0.6""")
def q_subset(obs: DataFrame) -> DataFrame:
    return temporal_subset(obs, "1998-01-01", "1998-12-31", 0.6, ("b02",))


@query("season_union_and_clamp", "jobs", "obs", sql="""SELECT j.epsg, greatest(j.a, o.a) AS start_date, least(j.b, o.b) AS end_date
  FROM (SELECT epsg, min(start_date) AS a, max(end_date) AS b FROM jobs GROUP BY epsg) j, (SELECT min(ts) AS a, max(ts) AS b FROM obs) o
  WHERE greatest(j.a, o.a) <= least(j.b, o.b)""")
def season_union_and_clamp(windows: DataFrame, data: DataFrame) -> DataFrame:
    """Union of the windows of a key, cut to the range of the data (one row, a scalar subquery); disjoint ones go."""
    span = data.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    a, b = F.lit(span["a"]), F.lit(span["b"])
    union = windows.groupBy("epsg").agg(F.min("start_date").alias("s"), F.max("end_date").alias("e"))
    return union.select("epsg", F.greatest("s", a).alias("start_date"), F.least("e", b).alias("end_date")).where("start_date <= end_date")


@query("timestep_components", "obs", sql="""SELECT sample_id, CAST(day(ts) AS INTEGER) AS day, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year FROM
  (SELECT sample_id, CAST(unnest(generate_series(min(ts), max(ts), INTERVAL 1 MONTH)) AS DATE) AS ts FROM obs GROUP BY sample_id)""")
def timestep_components(obs: DataFrame) -> DataFrame:
    e = expected_dates(obs)
    return e.select("sample_id", F.dayofmonth("ts").alias("day"), F.month("ts").alias("month"), F.year("ts").alias("year"))


@query("select_timestep", "obs", sql="""SELECT sample_id, arg_min(ts, abs(ts - DATE '1998-06-15') * 100000 + (ts - DATE '1970-01-01')) AS ts FROM obs
  GROUP BY sample_id HAVING min(ts) <= DATE '1998-06-15' AND max(ts) >= DATE '1998-06-15'""")
def select_timestep(obs: DataFrame, target: str = "1998-06-15") -> DataFrame:
    """The step nearest to a target date that lies within the series."""
    t = F.to_date(F.lit(target))
    return (
        obs.groupBy("sample_id").agg(F.min_by("ts", F.struct(F.abs(F.datediff("ts", t)), "ts")).alias("ts"), F.min("ts").alias("a"), F.max("ts").alias("b"))
        .where((F.col("a") <= t) & (F.col("b") >= t)).select("sample_id", "ts")
    )


@query("band_scaling", "obs", sql=f"""WITH {_FILLED} SELECT sample_id, ts, CASE WHEN b04 = 65535 THEN 65535e0 ELSE round(b04 / 10000e0, 6) END AS b04,
  CASE WHEN vv = 65535 THEN 65535e0 WHEN vv > 0 THEN round(20 * log10(vv) - 83, 6) END AS vv FROM filled""")
def band_scaling(obs: DataFrame) -> DataFrame:
    return filled(obs).select("sample_id", "ts", F.round(scaled(F.col("b04"), "optical"), 6).alias("b04"), F.round(scaled(F.col("vv"), "sar"), 6).alias("vv"))


@query("band_statistics", "obs", sql=f"""WITH {_FILLED}, u AS (SELECT band, v FROM (SELECT b02, b04, b08 FROM filled) UNPIVOT (v FOR band IN (b02, b04, b08)))
  SELECT band, round(avg(CASE WHEN v = 65535 THEN 100e0 ELSE 0e0 END), 6) AS nodata_percent, round(min(nullif(v, 65535) / 10000e0), 6) AS low,
  round(max(nullif(v, 65535) / 10000e0), 6) AS high, round(avg(nullif(v, 65535) / 10000e0), 6) AS mean, round(stddev_pop(nullif(v, 65535) / 10000e0), 6) AS std FROM u GROUP BY band""")
def band_statistics(obs: DataFrame) -> DataFrame:
    rows = filled(obs).select("b02", "b04", "b08").unpivot([], ["b02", "b04", "b08"], "band", "v")
    x = valid(F.col("v")) / 10000
    stats = {"low": F.min(x), "high": F.max(x), "mean": F.avg(x), "std": F.stddev_pop(x)}
    return rows.groupBy("band").agg(
        F.round(F.avg(F.when(F.col("v") == NODATA, 100.0).otherwise(0.0)), 6).alias("nodata_percent"), *(F.round(c, 6).alias(n) for n, c in stats.items())
    )


@query("ndvi", "obs", sql="""SELECT sample_id, ts, round((b08 - b04) * 1e0 / nullif(b08 + b04, 0), 6) AS ndvi,
  round((least(greatest((b08 - b04) * 1e0 / nullif(b08 + b04, 0), -0.08e0), 0.92e0) + 0.08e0) / 0.004e0, 4) AS ndvi_scaled FROM obs""")
def q_ndvi(obs: DataFrame) -> DataFrame:
    nir, red = F.col("b08"), F.col("b04")
    return obs.select("sample_id", "ts", F.round(ndvi(nir, red), 6).alias("ndvi"), F.round(ndvi_scaled(nir, red), 4).alias("ndvi_scaled"))


@query("sample_series_for_plot", "obs")
def sample_series_for_plot(obs: DataFrame, n: int = 12, seed: int = 42) -> DataFrame:
    """Whole series of ``n`` samples: one of each dataset first, then others, in hash order (a report, limited by design)."""
    ids = obs.select("ref_id", "sample_id").distinct().withColumn("_h", F.xxhash64("sample_id", F.lit(seed)))
    first = F.row_number().over(Window.partitionBy("ref_id").orderBy("_h", "sample_id"))
    chosen = ids.withColumn("_r", first).orderBy(F.col("_r") > 1, "_h", "sample_id").limit(n).select("sample_id")
    return obs.join(chosen, "sample_id", "left_semi").select("sample_id", "ref_id", "ts", "b02")


@query("cumulative_gdd", "obs_dekad", sql="""SELECT sample_id, ts, round(sum(greatest(b02 / 20e0 - 10, 0)) OVER (PARTITION BY sample_id ORDER BY ts), 6) AS gdd FROM obs_dekad""")
def cumulative_gdd(weather: DataFrame, base: float = 10.0) -> DataFrame:
    """Running sum of degrees above the base."""
    daily = F.greatest(F.col("b02") / 20 - base, F.lit(0.0))
    return weather.select("sample_id", "ts", F.round(F.sum(daily).over(in_order().rowsBetween(Window.unboundedPreceding, 0)), 6).alias("gdd"))


@query("latest_per_key", "obs", sql="SELECT sample_id, max(ts) AS ts, arg_max(b02, ts) AS b02 FROM obs GROUP BY sample_id")
def latest_per_key(obs: DataFrame) -> DataFrame:
    return obs.groupBy("sample_id").agg(F.max("ts").alias("ts"), F.max_by("b02", "ts").alias("b02"))
