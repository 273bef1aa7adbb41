"""Samples far enough apart with few of each class, and draws in proportion to weights."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrispark.operators.geometry import TILES_SQL, tiles, to_web_mercator
from agrispark.operators.hexes import with_hexes
from agrispark.operators.relations import tile_assignment_join
from agrispark.operators.splits import SEED, _chance, chance
from agrispark.registry import query
from agrispark.storage import dropped, kept, small

#: Sampling labels that count as land cover (fixed values); all others are crop types.
LAND_COVER = (
    "cropland_unspecified", "temporary_crops", "non_cropland_incl_perennial", "non_cropland_excl_perennial", "herbaceous_vegetation", "grasslands",
    "wetlands", "non_cropland_mixed", "shrubland", "trees_unspecified", "trees_broadleaved", "trees_coniferous", "trees_mixed",
    "bare_sparsely_vegetated", "built_up", "open_water",
)
#: Parts of the hash range that ranks are counted in, so that a group of any size is ranked by many tasks.
PARTS = 64
#: Rows of a class and coarse cell that one step looks at (Spark limits groups before the shuffle up to 1,000).
SEEN = 500
#: Rows in a shard of a draw.
SHARD = 100_000


def ranked(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with their number from 1 within a group by ``order``, whose first column lies in [0, 1).

    The range of that column is cut into parts: a row's number is its number inside its part and what the parts before hold.
    """
    cut = rows.withColumn("_part", F.floor(F.col(order[0]) * PARTS))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = cut.groupBy(*group, "_part").agg(F.count("*").alias("_k")).withColumn("_base", F.coalesce(F.sum("_k").over(before), F.lit(0))).drop("_k")
    inside = F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order))
    return cut.withColumn("_rank", inside).join(base, [*group, "_part"]).withColumn(name, F.col("_base") + F.col("_rank")).drop("_part", "_rank", "_base")


def apart(samples: DataFrame, metres: float, most: int | None = None) -> DataFrame:
    """Samples ``(sample_id, lat, lon, class, cap, coarse, fine)`` drawn one after the other within each coarse cell.

    The order is that of the rarest class of the coarse cell first, then rounds over the fine cells (the first of each by
    hash, the second of each, ...). A sample is drawn unless one drawn before it in its coarse cell lies within
    ``metres`` of web Mercator, or its class has ``cap`` samples there. Rows without coordinates or class are not drawn.

    What that order decides is found in rounds. The first ``SEEN`` rows left of each class and coarse cell (more where caps
    are large) are taken in order, cell by cell, up to the first class that has neither all it may have nor all its rows
    among them. Then classes that are full and the neighbours of what was drawn leave. No task sees more of a coarse cell
    than those first rows; neighbours are found by squares of the distance.
    """
    x, y = to_web_mercator(F.col("lon"), F.greatest(F.lit(-89.9), F.least(F.lit(89.9), F.col("lat"))))
    d = samples.where("lat is not null and lon is not null and class is not null and coarse is not null and fine is not null")
    d = d.select("sample_id", "lat", "lon", "class", "cap", "coarse", "fine", x.alias("x"), y.alias("y"), chance("sample_id").alias("_c"))
    size = max(metres, 1e-9)
    d = kept(d.withColumns({"gx": F.floor(F.col("x") / size), "gy": F.floor(F.col("y") / size)}), "placed")
    kind = ["coarse", "class"]
    turns = ranked(d, [*kind, "fine"], ["_c", "sample_id"], "turn")
    count = d.groupBy(*kind).agg(F.count("*").alias("n"), F.max("cap").alias("top"))
    order = F.struct("n", "class", "turn", "fine", "_c", "sample_id")
    left = kept(turns.join(count, kind).where("cap > 0").withColumn("o", order).drop("turn", "_c"), "left")
    dropped(d)
    most = most or (left.agg(F.max("cap")).first()[0] or 0)
    seen = max(SEEN, 2 * most)
    first = F.row_number().over(Window.partitionBy(*kind).orderBy("o"))
    own = ["sample_id", "lat", "lon", "class", "cap", "coarse", "fine", "x", "y", "gx", "gy"]
    decide, drawn, have = in_turn(seen, metres, own), None, None
    while True:
        front = left.select(*own, "n", "top", "o").withColumn("k", first).where(F.col("k") <= seen + 1).drop("o")
        front = front.withColumn("have", F.lit(0).cast("long")) if have is None else front.join(have, kind, "left").fillna(0, ["have"])
        step = kept(front.groupBy("coarse").applyInArrow(decide, left.select(*own).schema), "step")
        if step.isEmpty():
            return (left.where("false") if drawn is None else drawn).select("sample_id", "lat", "lon", "class", "coarse", "fine")
        drawn = step if drawn is None else drawn.unionByName(step)
        have = small(drawn.groupBy(*kind).agg(F.count("*").alias("have")))
        rest = left.join(have, kind, "left").where("have is null or have < cap").drop("have")
        before, left = left, kept(_far(rest, step, size, metres), "left")
        dropped(before)


def in_turn(seen: int, metres: float, columns: list[str]):
    """A function of the first rows of a coarse cell: of each class ``seen`` in order (``k``), one more if it has more rows."""

    def run(cell: pa.Table) -> pa.Table:
        cell = cell.sort_by([("n", "ascending"), ("class", "ascending"), ("k", "ascending")])
        x, y, k, cap, top, had = (cell[c].to_numpy() for c in ("x", "y", "k", "cap", "top", "have"))
        near, drawn = np.zeros(len(k), bool), []
        starts = np.flatnonzero(k == 1).tolist()
        for a, b in zip(starts, [*starts[1:], len(k)], strict=True):
            have, more = had[a], k[b - 1] > seen
            for i in range(a, b - 1 if more else b):
                if not near[i] and have < cap[i]:
                    drawn.append(i)
                    have += 1
                    near |= (x - x[i]) ** 2 + (y - y[i]) ** 2 <= metres**2
                    near[i] = True
                elif have >= top[a]:
                    break
            if more and have < top[a]:
                break  # rows not seen come before the classes that follow
        return cell.select(columns).take(pa.array(drawn, pa.int64()))

    return run


def _far(left: DataFrame, few: DataFrame, size: float, metres: float) -> DataFrame:
    """Rows of ``left`` that are neither among ``few`` nor within the distance of one of them in the same coarse cell."""
    around = lambda c: F.explode(F.sequence(F.col(c) - 1, F.col(c) + 1)).alias(f"_{c}")
    sent = few.select(F.col("coarse").alias("_coarse"), "gy", F.col("x").alias("_x"), F.col("y").alias("_y"), around("gx"))
    sent = sent.select("_coarse", "_gx", "_x", "_y", around("gy"))
    square = (F.col("coarse") == F.col("_coarse")) & (F.col("gx") == F.col("_gx")) & (F.col("gy") == F.col("_gy"))
    within = (F.col("x") - F.col("_x")) ** 2 + (F.col("y") - F.col("_y")) ** 2 <= metres**2
    return left.join(small(few.select("sample_id")), "sample_id", "left_anti").join(small(sent), square & within, "left_anti")


def in_cells(samples: DataFrame, coarse: int, fine: int) -> DataFrame:
    """Samples with the names of their hexagonal cells of two levels; the coarse cell is the ancestor of the fine one."""
    return with_hexes(samples, {"fine": fine, "coarse": coarse})


def distance_class_samples(samples: DataFrame, cap: Column, metres: float, coarse: int = 3, fine: int | None = None) -> DataFrame:
    """Draws of ``apart`` among samples of a known class (``sampling_label``) and of some quality in both respects."""
    good = samples.where("sampling_label is not null and sampling_label <> 'unknown' and quality_ct > 0 and quality_lc > 0")
    capped = good.withColumnRenamed("sampling_label", "class").withColumn("cap", cap)
    if fine:
        return apart(in_cells(capped, coarse, fine), metres)
    most = capped.agg(F.max("cap")).first()[0] or 0
    return apart(in_cells(capped, coarse, 5 if most <= 50 else 6), metres, most)


def run_sampling(samples: DataFrame, legend: DataFrame, most_lc: int = 30, most_ct: int = 30, metres: float = 1500.0, land_cover=LAND_COVER, coarse: int = 3, fine: int | None = None) -> DataFrame:
    """``samples`` with ``sampling_label`` from the legend and ``extract`` anew: 1 where drawn, else 0.

    Classes of land cover and crop types have caps of their own. A code without a label is an error, and so is a draw
    of nothing.
    """
    labelled = samples.drop("sampling_label").join(small(legend.select("ewoc_code", "sampling_label")), "ewoc_code", "left")
    if missing := labelled.where("sampling_label is null").select("ewoc_code").distinct().limit(5).collect():
        raise ValueError(f"codes without a sampling label: {sorted(r[0] for r in missing if r[0] is not None)}")
    cap = F.when(F.col("class").isin(*land_cover), most_lc).otherwise(most_ct)
    drawn = kept(distance_class_samples(labelled, cap, metres, coarse, fine).select("sample_id", F.lit(1).alias("_drawn")), "drawn")
    if drawn.isEmpty():
        raise ValueError("no sample was drawn")
    return labelled.drop("extract").join(drawn, "sample_id", "left").withColumn("extract", F.coalesce("_drawn", F.lit(0))).drop("_drawn")


@query("distance_class_sampling", "samples")
def distance_class_sampling(samples: DataFrame) -> DataFrame:
    """At most three of each crop type in a cell of level 0, no two within 150 km."""
    named = samples.withColumn("sampling_label", F.col("croptype"))
    return distance_class_samples(named, F.lit(3), 150_000.0, coarse=0, fine=2).select("sample_id", "lat", "lon", F.col("class").alias("croptype"), "coarse")


@query("run_sampling", "samples", "legend")
def q_run_sampling(samples: DataFrame, legend: DataFrame) -> DataFrame:
    """All samples of known codes with their new extract flag; two of the five groups count as land cover."""
    known = samples.join(small(legend.select("ewoc_code")), "ewoc_code", "left_semi")
    return run_sampling(known, legend, 4, 2, 150_000.0, ("group 0", "group 1"), coarse=0, fine=2).select("sample_id", "sampling_label", "extract")


# draws


def draws(pool: DataFrame, n: int, seed: int = SEED) -> DataFrame:
    """``(id, position)``: ``n`` draws with replacement from ``(id, weight)`` in proportion to weight, positions 0 to n - 1 in random order.

    Rows are dealt to shards by hash, as many as their number asks for. A multinomial draw over the shards' weights (the
    driver holds one number a shard) says how many draws each makes, one inside each shard how often a row is drawn.
    Chance comes from the seed and the shard, so reruns agree. Null and negative weights count as zero; without a
    positive weight there are no draws.
    """
    kind = pool.schema["id"].dataType.simpleString()
    weighed = pool.select("id", F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("weight")).where("weight > 0")
    shards = 1 + weighed.count() // SHARD
    dealt = weighed.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(shards)))
    # rounded, so that the order of addition does not decide
    parts = sorted((r["shard"], float(np.float32(r["w"]))) for r in dealt.groupBy("shard").agg(F.sum("weight").alias("w")).collect())
    if not parts or n <= 0:
        return pool.sparkSession.createDataFrame([], f"id {kind}, position bigint")
    shares = np.array([w for _, w in parts])
    each = dict(zip((s for s, _ in parts), np.random.default_rng([seed, 1]).multinomial(n, shares / shares.sum()).tolist(), strict=True))

    def run(group: pa.Table) -> pa.Table:
        own = group.sort_by([("id", "ascending"), ("weight", "ascending")])
        shard = own["shard"][0].as_py()
        w = own["weight"].to_numpy()
        times = np.random.default_rng([seed, 2, shard]).multinomial(each[shard], w / w.sum())
        return pa.table({"id": own["id"], "row": pa.array(range(len(w)), pa.int64()), "shard": own["shard"], "times": pa.array(times, pa.int64())}).filter(pa.array(times > 0))

    drawn = dealt.groupBy("shard").applyInArrow(run, f"id {kind}, row bigint, shard bigint, times bigint")
    copies = drawn.select("id", "row", "shard", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy")).withColumn("_c", chance("shard", "row", "copy", seed=seed))
    return ranked(kept(copies.withColumn("_all", F.lit(0)), "draws"), ["_all"], ["_c", "shard", "row", "copy"], "position").select("id", (F.col("position") - 1).alias("position"))


def task_counts(size: int, shares: Mapping[str, float]) -> dict[str, int]:
    """Draws of each task in a batch: whole parts, the rest by largest remainder; of two equal shares the later gets the odd one."""
    if size <= 0 or not shares or any(s < 0 for s in shares.values()) or sum(shares.values()) <= 0:
        raise ValueError("a batch needs a positive size and shares of which one is positive and none negative")
    whole = {t: size * s / sum(shares.values()) for t, s in shares.items()}
    counts = {t: int(w) for t, w in whole.items()}
    late = list(shares) if len(set(shares.values())) > 1 else list(shares)[::-1]
    for t in sorted(late, key=lambda t: counts[t] - whole[t])[: size - sum(counts.values())]:
        counts[t] += 1
    return counts


def mixed_batches(pools: Mapping[str, DataFrame], shares: Mapping[str, float], size: int, batches: int, seed: int = SEED) -> DataFrame:
    """``(batch, slot, task, id)``: batches that hold each task's share of draws from its pool ``(id, weight)``, in random order."""
    counts, out = task_counts(size, shares), None
    for k, task in enumerate(shares):
        if not counts[task]:
            continue
        own = draws(pools[task], counts[task] * batches, seed + k)
        own = own.select(F.floor(F.col("position") / counts[task]).alias("batch"), F.lit(task).alias("task"), F.col("position"), "id")
        out = own if out is None else out.unionByName(own)
    mixed = Window.partitionBy("batch").orderBy("_c", "task", "position")
    return out.withColumn("_c", chance("batch", "task", "position", seed=seed)).withColumn("slot", F.row_number().over(mixed) - 1).select("batch", "slot", "task", "id")


@query("weighted_draw", "samples")
def weighted_draw(samples: DataFrame, size: int = 32, seed: int = SEED) -> DataFrame:
    """As many draws as there are samples, in batches that mix land cover (all samples) and crop types (those to extract) half and half."""
    pool = samples.select(F.col("sample_id").alias("id"), "weight", "extract")
    batches = -(-samples.count() // size)
    out = mixed_batches({"landcover": pool.select("id", "weight"), "croptype": pool.where("extract = 1").select("id", "weight")}, {"landcover": 0.5, "croptype": 0.5}, size, batches, seed)
    return out.withColumnRenamed("id", "sample_id")


# units of extraction


_UNIT = f"""{TILES_SQL}, tl AS (SELECT sample_id, min(tile_name) AS tile FROM samples LEFT JOIN t ON lon BETWEEN x0 AND x1 AND lat BETWEEN y0 AND y1 GROUP BY sample_id),
  u AS (SELECT *, CAST(year(valid_time) AS INTEGER) AS year, (row_number() OVER (PARTITION BY year(valid_time), tile ORDER BY {_chance('sample_id')}, sample_id) - 1) // 10 AS k FROM samples JOIN tl USING (sample_id)),
  w AS (SELECT *, CAST(date_trunc('month', greatest(min(valid_time) OVER p - 275, DATE '2017-01-01')) AS DATE) AS start_date, last_day(least(max(valid_time) OVER p + 275, DATE '2021-12-31')) AS end_date FROM u WINDOW p AS (PARTITION BY year, tile, k))"""
_FEATURE = """'{"type":"Feature","geometry":{"type":"Point","coordinates":[' || CAST(CAST(lon AS DECIMAL(10,5)) AS VARCHAR) || ',' || CAST(CAST(lat AS DECIMAL(10,5)) AS VARCHAR) || ']},"properties":{"sample_id":"' || sample_id || '","ref_id":"' || ref_id || '","valid_time":"' || CAST(valid_time AS VARCHAR) || '","start_date":"' || CAST(start_date AS VARCHAR) || '","end_date":"' || CAST(end_date AS VARCHAR) || '"}}'"""


@query("plan_extraction_units", "samples", "regions", sql=f"""WITH {_UNIT} SELECT year, tile, CAST(k AS INTEGER) AS unit, count(*) AS n, start_date, end_date,
  '{{"type":"FeatureCollection","features":[' || string_agg({_FEATURE}, ',' ORDER BY sample_id) || ']}}' AS geometry FROM w GROUP BY year, tile, k, start_date, end_date""")
def q_extraction_units(samples: DataFrame, regions: DataFrame) -> DataFrame:
    tiled = tile_assignment_join(samples, tiles(regions, 7.0)).join(samples, "sample_id")
    return plan_extraction_units(tiled, 10)


def plan_extraction_units(samples: DataFrame, most: int = 500, reach: int = 275, first: str = "2017-01-01", last: str = "2021-12-31") -> DataFrame:
    """Units of at most ``most`` samples of a year and tile, with their period in whole months and their points as GeoJSON.

    The period reaches ``reach`` days before the first and after the last validity date, within ``first`` and ``last``.
    Samples are dealt to units in hash order; those without a tile are units of their own, without a date none.
    """
    dated = samples.where("valid_time is not null").withColumn("year", F.year("valid_time")).withColumn("_c", chance("sample_id"))
    # null tiles take part in the joins of the ranking under an empty name
    named = dated.withColumn("_tile", F.coalesce("tile", F.lit("")))
    u = ranked(named, ["year", "_tile"], ["_c", "sample_id"], "_k").withColumn("unit", F.floor((F.col("_k") - 1) / most).cast("int"))
    start = F.trunc(F.greatest(F.date_sub(F.min("valid_time"), reach), F.to_date(F.lit(first))), "month")
    end = F.last_day(F.least(F.date_add(F.max("valid_time"), reach), F.to_date(F.lit(last))))
    points = F.array_sort(F.collect_list(F.struct("sample_id", "ref_id", "valid_time", F.col("lon").cast("decimal(10,5)").alias("lon"), F.col("lat").cast("decimal(10,5)").alias("lat"))))
    units = u.groupBy("year", "_tile", "unit").agg(F.first("tile").alias("tile"), F.count("*").alias("n"), start.alias("start_date"), end.alias("end_date"), points.alias("points"))

    def feature(p: Column) -> Column:
        properties = F.struct(p["sample_id"].alias("sample_id"), p["ref_id"].alias("ref_id"), p["valid_time"].cast("string").alias("valid_time"), F.col("start_date").cast("string").alias("start_date"), F.col("end_date").cast("string").alias("end_date"))
        place = F.struct(F.lit("Point").alias("type"), F.array(p["lon"], p["lat"]).alias("coordinates"))
        return F.struct(F.lit("Feature").alias("type"), place.alias("geometry"), properties.alias("properties"))

    collection = F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.transform("points", feature).alias("features")))
    return units.select("year", "tile", "unit", "n", "start_date", "end_date", collection.alias("geometry"))
