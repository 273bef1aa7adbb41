"""Seasons and crop calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrispark.functions import dates
from agrispark.registry import query
from agrispark.storage import kept, small

S1 = ((11, 1), (4, 30), 1)
S2 = ((4, 1), (9, 30), 0)


@query("align_to_composite", "obs_raw", sql="""SELECT sample_id, ts, seq, line, CAST(date_trunc('month', ts) AS DATE) AS month,
  CAST(date_trunc('month', ts) AS DATE) + CAST(CASE WHEN day(ts) <= 10 THEN 0 WHEN day(ts) <= 20 THEN 10 ELSE 20 END AS INTEGER) AS dekad FROM obs_raw""")
def align_to_composite(raw: DataFrame) -> DataFrame:
    ts = F.col("ts")
    return raw.select("sample_id", "ts", "seq", "line", dates.align_to_composite(ts).alias("month"), dates.align_to_composite(ts, "dekad").alias("dekad"))


@query("advance_slot", "obs_raw", sql="""SELECT sample_id, ts, seq, line, CASE WHEN day(ts) <= 10 THEN CAST(date_trunc('month', ts) AS DATE) + 10
    WHEN day(ts) <= 20 THEN CAST(date_trunc('month', ts) AS DATE) + 20 ELSE last_day(ts) + 1 END AS next_slot, last_day(ts) AS month_end FROM obs_raw""")
def advance_slot(raw: DataFrame) -> DataFrame:
    ts = F.col("ts")
    return raw.select("sample_id", "ts", "seq", "line", dates.advance_slot(ts, "dekad").alias("next_slot"), dates.slot_end(ts).alias("month_end"))


@query("slot_end", "obs_raw", sql="""SELECT sample_id, ts, seq, line, CASE WHEN day(ts) <= 10 THEN CAST(date_trunc('month', ts) AS DATE) + 9
    WHEN day(ts) <= 20 THEN CAST(date_trunc('month', ts) AS DATE) + 19 ELSE last_day(ts) END AS last_day FROM obs_raw""")
def slot_end(raw: DataFrame) -> DataFrame:
    return raw.select("sample_id", "ts", "seq", "line", dates.slot_end(F.col("ts"), "dekad").alias("last_day"))


@query("enumerate_slots", "jobs", sql="""SELECT job, len(generate_series(date_trunc('month', start_date), date_trunc('month', end_date), INTERVAL 1 MONTH)) AS n_slots,
  CAST(date_trunc('month', end_date) AS DATE) AS last_slot FROM jobs""")
def enumerate_slots(jobs: DataFrame) -> DataFrame:
    slots = dates.enumerate_slots(F.col("start_date"), F.col("end_date"))
    return jobs.select("job", F.size(slots).alias("n_slots"), F.element_at(slots, -1).alias("last_slot"))


@query("season_window", "jobs", sql="""SELECT job, CAST(month(start_date) AS INTEGER) AS start_month, CAST(day(start_date) AS INTEGER) AS start_day,
  CAST(month(end_date) AS INTEGER) AS end_month, CAST(day(end_date) AS INTEGER) AS end_day, CAST(year(end_date) - year(start_date) AS INTEGER) AS year_offset FROM jobs""")
def season_window(jobs: DataFrame) -> DataFrame:
    """Month and day window of two dates, ending in the same year or the next."""
    parts = {"start_month": F.month("start_date"), "start_day": F.dayofmonth("start_date"), "end_month": F.month("end_date"), "end_day": F.dayofmonth("end_date")}
    return jobs.select("job", *(c.alias(n) for n, c in parts.items()), (F.year("end_date") - F.year("start_date")).alias("year_offset"))


_S1 = """make_date(CAST(year({d}) + CASE WHEN month({d}) > 4 THEN 1 ELSE 0 END - 1 AS BIGINT), 11, 1)""", """make_date(CAST(year({d}) + CASE WHEN month({d}) > 4 THEN 1 ELSE 0 END AS BIGINT), 4, 30)"""


@query("resolve_season_bounds", "samples", sql=f"SELECT sample_id, {_S1[0].format(d='valid_time')} AS season_start, {_S1[1].format(d='valid_time')} AS season_end FROM samples")
def resolve_season_bounds(samples: DataFrame) -> DataFrame:
    a, b = dates.resolve_season_bounds(F.col("valid_time"), *S1)
    return samples.select("sample_id", a.alias("season_start"), b.alias("season_end"))


@query("in_season", "samples", sql="SELECT sample_id, month(valid_time) >= 11 OR month(valid_time) <= 4 AS in_s1, month(valid_time) BETWEEN 4 AND 9 AS in_s2 FROM samples")
def in_season(samples: DataFrame) -> DataFrame:
    d = F.col("valid_time")
    tests = [dates.in_season(d, *dates.resolve_season_bounds(d, *w), "month").alias(n) for n, w in (("in_s1", S1), ("in_s2", S2))]
    return samples.select("sample_id", *tests)


@query("filter_by_windows", "samples", sql="SELECT sample_id, valid_time FROM samples WHERE month(valid_time) BETWEEN 4 AND 9")
def filter_by_windows(samples: DataFrame, windows=(S2,)) -> DataFrame:
    """Rows whose label date lies in any of the windows."""
    d = F.coalesce("valid_time")
    any_of = F.lit(False)
    for w in windows:
        any_of = any_of | dates.in_season(d, *dates.resolve_season_bounds(d, *w), "month")
    return samples.where(any_of).select("sample_id", "valid_time")


def season_mask(df: DataFrame, window, coverage: float) -> DataFrame:
    """Per row whether it lies in a yearly cycle of the window of which at least max(1, round(slots * coverage)) steps are present."""
    a, b = dates.resolve_season_bounds(F.col("ts"), *window)
    cycle = df.withColumn("cycle", b).withColumn("_in", F.col("ts").between(dates.align_to_composite(a), b))
    slots = F.size(dates.enumerate_slots(a, b))
    present = F.count(F.when(F.col("_in"), 1)).over(Window.partitionBy("sample_id", "cycle"))
    return cycle.withColumn("mask", F.col("_in") & (present >= F.greatest(F.lit(1), F.rint(slots * coverage)))).drop("_in")


_MASK = """SELECT sample_id, ts, month(ts) BETWEEN 4 AND 9 AND count(*) FILTER (month(ts) BETWEEN 4 AND 9) OVER (PARTITION BY sample_id, year(ts) + CASE WHEN month(ts) > 9 THEN 1 ELSE 0 END) >= {n} AS mask FROM obs"""


@query("season_mask_window", "obs", sql=_MASK.format(n=5))
def season_mask_window(obs: DataFrame) -> DataFrame:
    return season_mask(obs, S2, 0.8).select("sample_id", "ts", "mask")


@query("season_mask_calendar", "obs", "calendar", sql=f"""WITH k AS (SELECT min(s1_sos) AS sos, max(s1_eos) AS eos FROM calendar)
  SELECT sample_id, ts, ts BETWEEN date_trunc('month', make_date(1998, 1, 1) + k.eos - CASE WHEN k.eos > k.sos THEN k.eos - k.sos ELSE 365 - k.sos + k.eos END)
    AND make_date(1998, 1, 1) + k.eos AS mask FROM obs, k""")
def season_mask_calendar(obs: DataFrame, calendar: DataFrame, year: int = 1998) -> DataFrame:
    """Mask of the season that the calendar gives for a target year (one row, looked up first)."""
    k = calendar.agg(F.min("s1_sos").alias("sos"), F.max("s1_eos").alias("eos")).first()
    a, b = dates.doy_season_dates(F.lit(k["sos"]), F.lit(k["eos"]), F.lit(year))
    return obs.select("sample_id", "ts", F.col("ts").between(dates.align_to_composite(a), b).alias("mask"))


@query("season_metadata", "obs", sql=f"""WITH m AS ({_MASK.format(n=3)}) SELECT m.sample_id, m.ts, CASE WHEN regexp_matches(o.ref_id, '_10[01]$') THEN true ELSE m.mask END AS s2_mask
  FROM m JOIN obs o ON o.sample_id = m.sample_id AND o.ts = m.ts""")
def season_metadata(obs: DataFrame) -> DataFrame:
    """Season mask per step; datasets of land cover only are in season throughout."""
    only_landcover = F.col("ref_id").rlike("_10[01]$")
    return season_mask(obs, S2, 0.5).select("sample_id", "ts", F.when(only_landcover, True).otherwise(F.col("mask")).alias("s2_mask"))


@query("uniform_or_given_masks", "obs", sql="""SELECT sample_id, count(*) AS n, repeat('1', CAST(count(*) AS INTEGER)) AS mask, string_agg(CASE WHEN month(ts) BETWEEN 4 AND 9 THEN '1' ELSE '0' END, '' ORDER BY ts) AS given,
  min(ts) <= DATE '1995-04-01' AND max(ts) >= DATE '1995-09-30' AS covered FROM obs GROUP BY sample_id""")
def q_uniform_or_given_masks(obs: DataFrame) -> DataFrame:
    """A given mask of the months April to September, with one window of 1995, beside the uniform one."""
    given = obs.select(F.month("ts").alias("month"), F.month("ts").between(4, 9).alias("keep")).distinct()
    return uniform_or_given_masks(obs, given, ("1995-04-01", "1995-09-30"))


def uniform_or_given_masks(obs: DataFrame, given: DataFrame, window: tuple[str, str]) -> DataFrame:
    """Masks in order of time: true at every step, and as ``given`` (month, keep; twelve rows, broadcast) to all samples; whether the steps cover the window."""
    steps = obs.join(F.broadcast(given), F.month("ts") == F.col("month"), "left")
    ordered = F.array_sort(F.collect_list(F.struct("ts", F.coalesce("keep", F.lit(False)).cast("int").cast("string").alias("k"))))
    a, b = (F.to_date(F.lit(x)) for x in window)
    sums = steps.groupBy("sample_id").agg(F.count("*").alias("n"), ordered.alias("o"), ((F.min("ts") <= a) & (F.max("ts") >= b)).alias("covered"))
    return sums.select(
        "sample_id", "n", F.array_join(F.transform("o", lambda x: F.lit("1")), "").alias("mask"), F.array_join(F.transform("o", lambda x: x["k"]), "").alias("given"), "covered"
    )


def snapped(x: Column) -> Column:
    """Centre of the half-degree cell."""
    return F.floor(x * 2) / 2 + 0.25


def near_points(samples: DataFrame) -> DataFrame:
    """Sample coordinates moved near the calendar's area, some outside it."""
    return samples.select("sample_id", (F.pmod(F.col("lat"), F.lit(8.0)) + 10).alias("lat"), (F.pmod(F.col("lon"), F.lit(7.0)) + 19).alias("lon"))


def calendar_lookup(points: DataFrame, calendar: DataFrame, most_degrees: float = 5.0, values=("s1_sos", "s1_eos")) -> DataFrame:
    """Values of each point's half-degree cell, or of the nearest cell within ``most_degrees``.

    What holds for a point holds for its whole half-degree cell, so cells that hold points are looked up, each once
    however many points it has, and points are joined with what was found. Cells are matched by an equi-join. Only what
    is left looks for the nearest: it is sent to the 10 x 10 degree blocks that its search square touches, and meets
    the cells of those blocks.
    """
    cells = calendar.select("lat", "lon", *values)
    keyed = points.withColumn("_la", snapped(F.col("lat"))).withColumn("_lo", snapped(F.col("lon")))
    held = keyed.select("_la", "_lo").distinct()
    named = cells.select(F.col("lat").alias("_la"), F.col("lon").alias("_lo"), *values)
    exact = held.join(named, ["_la", "_lo"])
    rest = held.join(named, ["_la", "_lo"], "left_anti")
    size = 2 * most_degrees

    def block(x: Column, shift: float) -> Column:
        return F.floor((x + shift) / size)

    spread = rest.withColumn("_bla", F.explode(F.array_distinct(F.array(block(F.col("_la"), -most_degrees), block(F.col("_la"), most_degrees))))).withColumn(
        "_blo", F.explode(F.array_distinct(F.array(block(F.col("_lo"), -most_degrees), block(F.col("_lo"), most_degrees))))
    )
    boxed = cells.select(block(F.col("lat"), 0).alias("_bla"), block(F.col("lon"), 0).alias("_blo"), F.struct("lat", "lon", *values).alias("c"))
    distance = (F.col("c.lat") - F.col("_la")) ** 2 + (F.col("c.lon") - F.col("_lo")) ** 2
    nearest = (
        spread.join(boxed, ["_bla", "_blo"]).withColumn("_d", distance).where(F.col("_d") <= most_degrees**2)
        .groupBy("_la", "_lo").agg(F.min_by("c", F.struct("_d", "c.lat", "c.lon")).alias("c"))
        .select("_la", "_lo", *(f"c.{v}" for v in values), F.lit(True).alias("fallback"))
    )
    found = kept(exact.select("_la", "_lo", *values, F.lit(False).alias("fallback")).unionByName(nearest), "found")
    return keyed.join(small(found), ["_la", "_lo"]).select("sample_id", *values, "fallback")


_POINTS = "p AS (SELECT sample_id, ((lat % 8 + 8) % 8) + 10 AS lat, ((lon % 7 + 7) % 7) + 19 AS lon FROM samples), q AS (SELECT *, floor(lat * 2) / 2 + 0.25e0 AS la, floor(lon * 2) / 2 + 0.25e0 AS lo FROM p)"


@query("calendar_lookup_point", "samples", "calendar", sql=f"""WITH {_POINTS}, d AS (SELECT sample_id, s1_sos, s1_eos, (c.lat - la) * (c.lat - la) + (c.lon - lo) * (c.lon - lo) AS d, c.lat, c.lon FROM q, calendar c)
  SELECT sample_id, s1_sos, s1_eos, d > 0 AS fallback FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY d, lat, lon) AS r FROM d WHERE d <= 25) WHERE r = 1""")
def q_lookup(samples: DataFrame, calendar: DataFrame) -> DataFrame:
    return calendar_lookup(near_points(samples), calendar)


@query("calendar_equi_join", "samples", "calendar", sql=f"WITH {_POINTS} SELECT sample_id, s1_sos, s2_eos FROM q JOIN calendar c ON c.lat = la AND c.lon = lo")
def calendar_equi_join(samples: DataFrame, calendar: DataFrame) -> DataFrame:
    keyed = near_points(samples).select("sample_id", snapped(F.col("lat")).alias("lat"), snapped(F.col("lon")).alias("lon"))
    return keyed.join(calendar, ["lat", "lon"]).select("sample_id", "s1_sos", "s2_eos")


def wrapped(lon: Column) -> Column:
    """Longitude brought to -180 to 180."""
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def extents(collections: DataFrame) -> DataFrame:
    """Boxes about the calendar's area moved to the dateline; some lie south of all cells, some too far from any."""
    number = F.length("ref_id") + F.col("n").cast("int")
    south = F.when(number % 5 == 0, 6.0).when(number % 5 == 1, 40.0).otherwise(10.0)
    west = F.pmod(F.col("w"), F.lit(4.0)) + 177.5
    return collections.select("ref_id", wrapped(west).alias("w"), wrapped(west + 2).alias("e"), south.alias("s"), (south + 1 + F.pmod(F.col("n"), F.lit(3.0))).alias("n"))


def at_dateline(calendar: DataFrame) -> DataFrame:
    return calendar.withColumn("lon", wrapped(F.col("lon") + 157.5))


_EXT = """x AS (SELECT ref_id, CASE WHEN w0 >= 180 THEN w0 - 360 ELSE w0 END AS w, CASE WHEN w0 + 2 >= 180 THEN w0 - 358 ELSE w0 + 2 END AS e, s, s + 1 + n3 AS n FROM (SELECT ref_id, ((w % 4 + 4) % 4) + 177.5e0 AS w0, ((n % 3 + 3) % 3) AS n3,
  CASE WHEN (length(ref_id) + CAST(trunc(n) AS INTEGER)) % 5 = 0 THEN 6e0 WHEN (length(ref_id) + CAST(trunc(n) AS INTEGER)) % 5 = 1 THEN 40e0 ELSE 10e0 END AS s FROM collections)),
  cal AS (SELECT lat, CASE WHEN lon + 157.5e0 >= 180 THEN lon - 202.5e0 ELSE lon + 157.5e0 END AS lon, sos_dekad, eos_dekad FROM calendar)"""


def extent_median(extents_: DataFrame, calendar: DataFrame, most_degrees: float = 5.0) -> DataFrame:
    """Median start and end dekads of the valid cells (1 to 108) in each extent, joined by whole-degree blocks that it covers.

    An extent whose west is greater than its east goes over the dateline. Without a valid cell inside, the cell of the
    centre counts, or the nearest one within ``most_degrees`` (``fallback``); without one, or if that isn't valid, the
    medians are null.
    """
    good = lambda c: F.col(c).between(1, 108)
    west, east = F.floor("w").cast("int"), F.floor("e").cast("int")
    across = F.col("w") > F.col("e")
    columns = F.when(across, F.concat(F.sequence(west, F.lit(180)), F.sequence(F.lit(-180), east))).otherwise(F.sequence(F.least(west, east), F.greatest(west, east)))
    blocks = extents_.withColumn("_bla", F.explode(F.sequence(F.floor("s").cast("int"), F.floor("n").cast("int")))).withColumn("_blo", F.explode(columns))
    cells = calendar.where(good("sos_dekad") & good("eos_dekad")).select("lat", "lon", "sos_dekad", "eos_dekad", F.floor("lat").cast("int").alias("_bla"), F.floor("lon").cast("int").alias("_blo"))
    within = F.when(across, (F.col("lon") >= F.col("w")) | (F.col("lon") <= F.col("e"))).otherwise(F.col("lon").between(F.col("w"), F.col("e")))
    inside = blocks.join(cells, ["_bla", "_blo"]).where(F.col("lat").between(F.col("s"), F.col("n")) & within)
    found = inside.groupBy("ref_id").agg(
        F.rint(F.median("sos_dekad")).cast("int").alias("sos_dekad"), F.rint(F.median("eos_dekad")).cast("int").alias("eos_dekad"),
        (F.max("sos_dekad") - F.min("sos_dekad") > 7).alias("wide_spread"),
    )
    middle = F.when(across, wrapped(F.col("w") + (F.col("e") + 360 - F.col("w")) / 2)).otherwise((F.col("w") + F.col("e")) / 2)
    rest = extents_.join(found, "ref_id", "left_anti").select(F.col("ref_id").alias("sample_id"), ((F.col("s") + F.col("n")) / 2).alias("lat"), middle.alias("lon"))
    near = calendar_lookup(rest, calendar, most_degrees, ("sos_dekad", "eos_dekad")).where(good("sos_dekad") & good("eos_dekad"))
    near = rest.select("sample_id").join(near, "sample_id", "left").select(F.col("sample_id").alias("ref_id"), F.col("sos_dekad").cast("int"), F.col("eos_dekad").cast("int"), F.lit(False).alias("wide_spread"), F.lit(True).alias("fallback"))
    return found.withColumn("fallback", F.lit(False)).unionByName(near)


_EXTM = f"""{_EXT}, f AS (SELECT ref_id, CAST(round_even(median(sos_dekad), 0) AS INTEGER) AS sos_dekad, CAST(round_even(median(eos_dekad), 0) AS INTEGER) AS eos_dekad, max(sos_dekad) - min(sos_dekad) > 7 AS wide_spread
    FROM x JOIN cal c ON c.lat BETWEEN x.s AND x.n AND CASE WHEN x.w > x.e THEN c.lon >= x.w OR c.lon <= x.e ELSE c.lon BETWEEN x.w AND x.e END WHERE sos_dekad BETWEEN 1 AND 108 AND eos_dekad BETWEEN 1 AND 108 GROUP BY ref_id),
  o AS (SELECT ref_id, floor((s + n) / 2 * 2) / 2 + 0.25e0 AS la, floor(CASE WHEN mid >= 180 THEN mid - 360 ELSE mid END * 2) / 2 + 0.25e0 AS lo FROM (SELECT *, CASE WHEN w > e THEN w + (e + 360 - w) / 2 ELSE (w + e) / 2 END AS mid FROM x) WHERE ref_id NOT IN (SELECT ref_id FROM f)),
  k1 AS (SELECT ref_id, arg_min({{'a': sos_dekad, 'b': eos_dekad}}, {{'d': (lat - la) * (lat - la) + (lon - lo) * (lon - lo), 'lat': lat, 'lon': lon}}) AS v FROM o, cal WHERE (lat - la) * (lat - la) + (lon - lo) * (lon - lo) <= 25 GROUP BY ref_id),
  m AS (SELECT *, false AS fallback FROM f UNION ALL SELECT o.ref_id, CASE WHEN v.a BETWEEN 1 AND 108 AND v.b BETWEEN 1 AND 108 THEN CAST(v.a AS INTEGER) END, CASE WHEN v.a BETWEEN 1 AND 108 AND v.b BETWEEN 1 AND 108 THEN CAST(v.b AS INTEGER) END, false, true FROM o LEFT JOIN k1 USING (ref_id))"""


@query("calendar_extent_median", "collections", "calendar", sql=f"WITH {_EXTM} SELECT * FROM m")
def q_extent_median(collections: DataFrame, calendar: DataFrame) -> DataFrame:
    return extent_median(extents(collections), at_dateline(calendar))


@query("season_dates_for_extent", "collections", "calendar", sql=f"""WITH {_EXTM}, k AS (SELECT ref_id, 2023 * 12 + (sos_dekad - 1) // 3 + CASE WHEN (sos_dekad - 1) % 3 = 2 THEN 1 ELSE 0 END AS a,
    2023 * 12 + (eos_dekad - 1) // 3 - CASE WHEN (eos_dekad - 1) % 3 = 0 THEN 1 ELSE 0 END AS b FROM m)
  SELECT ref_id, make_date(a // 12, a % 12 + 1, 1) AS season_start, last_day(make_date(b // 12, b % 12 + 1, 1)) AS season_end FROM k""")
def season_dates_for_extent(collections: DataFrame, calendar: DataFrame, year: int = 2024) -> DataFrame:
    m = extent_median(extents(collections), at_dateline(calendar))
    y = F.lit(year)
    return m.select(
        "ref_id", dates.dekad_date(F.col("sos_dekad"), y, "first").alias("season_start"), dates.dekad_date(F.col("eos_dekad"), y, "last").alias("season_end")
    )


_DOY = "CASE WHEN eos > sos THEN eos - sos ELSE 365 - sos + eos END"


@query("doy_season_dates", "calendar", sql=f"""SELECT lat, lon, DATE '2020-01-01' + CAST(eos - {_DOY} AS INTEGER) AS season_start, DATE '2020-01-01' + CAST(eos AS INTEGER) AS season_end
  FROM (SELECT lat, lon, s1_sos AS sos, s1_eos AS eos FROM calendar)""")
def doy_season_dates(calendar: DataFrame) -> DataFrame:
    a, b = dates.doy_season_dates(F.col("s1_sos"), F.col("s1_eos"), F.lit(2020))
    return calendar.select("lat", "lon", a.alias("season_start"), b.alias("season_end"))


@query("enrich_grid_with_calendar", "collections", "calendar", sql=f"""WITH {_EXTM}, k AS (SELECT ref_id, 2023 * 12 + (sos_dekad - 1) // 3 + CASE WHEN (sos_dekad - 1) % 3 = 2 THEN 1 ELSE 0 END AS a FROM m)
  SELECT ref_id, coalesce('{{"s1":"' || CAST(make_date(a // 12, a % 12 + 1, 1) AS VARCHAR) || '"}}', '{{}}') AS season_windows FROM k""")
def enrich_grid_with_calendar(collections: DataFrame, calendar: DataFrame, year: int = 2024) -> DataFrame:
    """Each tile with its season start as JSON."""
    m = extent_median(extents(collections), at_dateline(calendar))
    start = dates.dekad_date(F.col("sos_dekad"), F.lit(year), "first").cast("string")
    return m.select("ref_id", F.to_json(F.struct(start.alias("s1"))).alias("season_windows"))


@query("build_calendar_lookup", "pixels", sql="""SELECT y, x, 89.75e0 - y * 0.5e0 AS lat, -179.75e0 + x * 0.5e0 AS lon, max(CASE WHEN tile = 0 THEN scl ELSE 0 END) AS s1_sos, max(CASE WHEN tile = 1 THEN scl ELSE 0 END) AS s1_eos
  FROM pixels GROUP BY y, x HAVING max(CASE WHEN tile < 2 THEN scl ELSE 0 END) <> 0""")
def build_calendar_lookup(pixels: DataFrame) -> DataFrame:
    """One row a half-degree pixel with the value of each layer, where any isn't zero."""
    layers = {"s1_sos": 0, "s1_eos": 1}
    rows = pixels.groupBy("y", "x").agg(*(F.max(F.when(F.col("tile") == t, F.col("scl")).otherwise(0)).alias(n) for n, t in layers.items()))
    return rows.where(F.greatest(*layers) != 0).select("y", "x", (89.75 - F.col("y") * 0.5).alias("lat"), (-179.75 + F.col("x") * 0.5).alias("lon"), *layers)


@query("annual_season", "calendar", sql="""SELECT lat, lon, greatest(s1_eos, s2_eos) AS annual_eos, CASE WHEN greatest(s1_eos, s2_eos) = 0 THEN 0 WHEN greatest(s1_eos, s2_eos) - 364 <= 0 THEN greatest(s1_eos, s2_eos) + 1 ELSE greatest(s1_eos, s2_eos) - 364 END AS annual_sos FROM calendar""")
def annual_season(calendar: DataFrame) -> DataFrame:
    """End: the later of both seasons; start: 364 days before, wrapped into the year; zeros stay zero."""
    end = F.greatest("s1_eos", "s2_eos")
    start = F.when(end == 0, 0).when(end - 364 <= 0, end + 1).otherwise(end - 364)
    return calendar.select("lat", "lon", end.alias("annual_eos"), start.alias("annual_sos"))


@query("clamp_calendars", "calendar", sql=f"""WITH s AS (SELECT lat, lon, s1_sos, s2_sos, s1_eos, s2_eos, s1_eos - s1_sos AS l1, CASE WHEN s2_eos > s2_sos THEN s2_eos - s2_sos ELSE 365 - s2_sos + s2_eos END AS l2 FROM calendar)
  SELECT lat, lon, greatest(s1_eos, s2_eos) - least(s1_eos - l1, s2_eos - l2) AS span, CASE WHEN greatest(s1_eos, s2_eos) - least(s1_eos - l1, s2_eos - l2) > 365 THEN
    CASE WHEN s1_eos >= s2_eos THEN 1 ELSE s2_sos END ELSE s2_sos END AS s2_sos FROM s""")
def clamp_calendars(calendar: DataFrame) -> DataFrame:
    """Days that both seasons span together; beyond 365 the season that doesn't end last starts on day 1."""
    def length(a, b):
        return F.when(F.col(b) > F.col(a), F.col(b) - F.col(a)).otherwise(365 - F.col(a) + F.col(b))
    first = F.least(F.col("s1_eos") - length("s1_sos", "s1_eos"), F.col("s2_eos") - length("s2_sos", "s2_eos"))
    span = F.greatest("s1_eos", "s2_eos") - first
    return calendar.select("lat", "lon", span.alias("span"), F.when((span > 365) & (F.col("s1_eos") >= F.col("s2_eos")), 1).otherwise(F.col("s2_sos")).alias("s2_sos"))


@query("valid_time_distribution", "samples", sql="""SELECT CAST(m AS INTEGER) AS month, count(DISTINCT sample_id) AS n FROM range(1, 13) r(m) LEFT JOIN samples ON month(valid_time) = m GROUP BY m""")
def valid_time_distribution(samples: DataFrame) -> DataFrame:
    """Unique samples in each of the twelve months."""
    months = samples.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("month"))
    counts = samples.groupBy(F.month("valid_time").alias("month")).agg(F.countDistinct("sample_id").alias("n"))
    return months.join(counts, "month", "left").select("month", F.coalesce("n", F.lit(0)).alias("n"))
