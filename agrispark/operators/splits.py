"""Train, validation and test splits, sampling, weights and quality filters. Chance comes from hashes of keys and a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrispark.functions.bands import NODATA
from agrispark.operators.relations import _CELLS, cells_of
from agrispark.registry import query
from agrispark.storage import dealt, scratch

SEED = 42


def chance(*key: str, seed: int = SEED) -> Column:
    """A number in [0, 1) decided by the key and the seed; md5, so other engines can repeat it."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in key)).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 2**32


def _chance(key: str, seed: int = SEED) -> str:
    return f"CAST('0x' || substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296e0"


@query("split_by_ids_countries_years", "samples", sql="""SELECT sample_id, CASE WHEN extract = 0 THEN 'train' WHEN year(valid_time) >= 2021 OR landcover = 'Brand#11' THEN 'val' ELSE 'train' END AS split FROM samples""")
def split_by_ids_countries_years(samples: DataFrame) -> DataFrame:
    """Validation by year or group; train-only samples never leave training."""
    val = (F.year("valid_time") >= 2021) | (F.col("landcover") == "Brand#11")
    return samples.select("sample_id", F.when(F.col("extract") == 0, "train").when(val, "val").otherwise("train").alias("split"))


@query("stratified_split", "samples", sql=f"""WITH h AS (SELECT sample_id, landcover, row_number() OVER (PARTITION BY landcover ORDER BY {_chance('sample_id')}, sample_id) AS r, count(*) OVER (PARTITION BY landcover) AS n FROM samples)
  SELECT sample_id, CASE WHEN r <= floor(n * 0.15e0) THEN 'test' WHEN r <= 2 * floor(n * 0.15e0) THEN 'val' ELSE 'train' END AS split FROM h WHERE n >= 5""")
def stratified_split(samples: DataFrame, share: float = 0.15, least: int = 5) -> DataFrame:
    """Test and validation shares of each class in hash order; small classes go."""
    by_class = Window.partitionBy("landcover")
    h = samples.withColumn("_c", chance("sample_id"))
    ranked = h.withColumn("r", F.row_number().over(by_class.orderBy("_c", "sample_id"))).withColumn("n", F.count("*").over(by_class))
    cut = F.floor(F.col("n") * share)
    return ranked.where(F.col("n") >= least).select("sample_id", F.when(F.col("r") <= cut, "test").when(F.col("r") <= 2 * cut, "val").otherwise("train").alias("split"))


@query("spatial_bin_split", "samples", sql=f"""WITH b AS (SELECT sample_id, extract, concat_ws('_', CAST(floor((lat + 90) / 5) AS BIGINT), CAST(floor((lon + 180) / 5) AS BIGINT)) AS bin FROM samples),
  m AS (SELECT bin, arg_min(extract, (-k) * 1000 + extract) AS major FROM (SELECT bin, extract, count(*) AS k FROM b GROUP BY ALL) GROUP BY bin),
  r AS (SELECT bin, row_number() OVER (PARTITION BY major ORDER BY {_chance('bin')}, bin) AS r, count(*) OVER (PARTITION BY major) AS n FROM m)
  SELECT sample_id, CASE WHEN r.r <= greatest(1, floor(n * 0.15e0)) THEN 'test' WHEN r.r <= 2 * greatest(1, floor(n * 0.15e0)) THEN 'val' ELSE 'train' END AS split FROM b JOIN r USING (bin)""")
def spatial_bin_split(samples: DataFrame, size: float = 5.0, share: float = 0.15) -> DataFrame:
    """Whole bins are dealt: those of each majority class in hash order, at least one to test and one to validation."""
    bins = samples.withColumn("bin", lat_lon_bin(size))
    counts = bins.groupBy("bin", "extract").agg(F.count("*").alias("k"))
    major = counts.groupBy("bin").agg(F.min_by("extract", F.struct(-F.col("k"), F.col("extract"))).alias("major")).withColumn("_c", chance("bin"))
    by_class = Window.partitionBy("major")
    ranked = major.withColumn("r", F.row_number().over(by_class.orderBy("_c", "bin"))).withColumn("n", F.count("*").over(by_class))
    cut = F.greatest(F.lit(1), F.floor(F.col("n") * share))
    dealt = ranked.select("bin", F.when(F.col("r") <= cut, "test").when(F.col("r") <= 2 * cut, "val").otherwise("train").alias("split"))
    return bins.join(dealt, "bin").select("sample_id", "split")


def lat_lon_bin(size: float) -> Column:
    return F.concat_ws("_", F.floor((F.col("lat") + 90) / size).cast("string"), F.floor((F.col("lon") + 180) / size).cast("string"))


def cell_classes(samples: DataFrame) -> DataFrame:
    """One row a cell: its region, size and set of classes. The greedy steps below work on this table alone."""
    c = cells_of(samples)
    return c.groupBy("cell").agg(
        F.min("parent").alias("region"), F.count("*").alias("n"), F.array_sort(F.collect_set("landcover")).alias("classes"),
        F.count(F.when(F.year("valid_time") >= 2021, 1)).alias("recent"),
    )


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and checkpointed to shared storage, so that loops don't grow its plan and lost executors cost no work."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch(df.sparkSession, "checkpoints"))
    kept = df.persist()
    out = kept.checkpoint()
    kept.unpersist()
    return out


def first_split(samples: DataFrame) -> DataFrame:
    """Cells with a split: hash shares of 15 % test and 15 % validation."""
    c = cell_classes(samples).withColumn("_c", chance("cell"))
    return c.withColumn("split", F.when(F.col("_c") < 0.15, "test").when(F.col("_c") < 0.3, "val").otherwise("train")).drop("_c")


_SPLIT = f"""{_CELLS}, cs AS (SELECT cell, any_value(parent) AS region, count(*) AS n, count(*) FILTER (year(valid_time) >= 2021) AS recent FROM cells GROUP BY cell),
  sp AS (SELECT *, CASE WHEN {_chance('cell')} < 0.15e0 THEN 'test' WHEN {_chance('cell')} < 0.3e0 THEN 'val' ELSE 'train' END AS split FROM cs)"""


@query("restore_train_coverage", "samples", sql=f"""WITH {_SPLIT}, k AS (SELECT DISTINCT sp.cell, sp.split, c.landcover FROM cells c JOIN sp ON sp.cell = c.cell),
  lost AS (SELECT landcover FROM k GROUP BY landcover HAVING count(*) FILTER (split = 'train') = 0)
  SELECT sp.cell, CASE WHEN EXISTS (SELECT 1 FROM k WHERE k.cell = sp.cell AND k.landcover IN (SELECT landcover FROM lost)) THEN 'train' ELSE sp.split END AS split FROM sp""")
def restore_train_coverage(samples: DataFrame) -> DataFrame:
    """Cells that hold a class training lost go back to training."""
    cells = first_split(samples)
    classes = cells.select("cell", "split", F.explode("classes").alias("class"))
    lost = classes.groupBy("class").agg(F.count(F.when(F.col("split") == "train", 1)).alias("k")).where("k = 0").select("class")
    back = classes.join(lost, "class", "left_semi").select("cell").distinct().withColumn("back", F.lit(True))
    return cells.join(back, "cell", "left").select("cell", F.when(F.col("back"), "train").otherwise(F.col("split")).alias("split"))


@query("ensure_recent_years", "samples", sql=f"""WITH {_SPLIT}, r AS (SELECT *, coalesce(sum(recent) OVER (ORDER BY recent DESC, cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sp WHERE split = 'train')
  SELECT sp.cell, CASE WHEN r.recent > 0 AND r.before < 30 - (SELECT sum(recent) FROM sp WHERE split = 'test') THEN 'test' ELSE sp.split END AS split FROM sp LEFT JOIN r ON r.cell = sp.cell""")
def ensure_recent_years(samples: DataFrame, least: int = 30) -> DataFrame:
    """The training cells richest in recent samples move to test until it has enough (a running sum over cells)."""
    cells = first_split(samples)
    have = cells.where("split = 'test'").agg(F.coalesce(F.sum("recent"), F.lit(0)).alias("n")).first()["n"]
    before = F.coalesce(F.sum("recent").over(Window.orderBy(F.desc("recent"), "cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    moved = cells.where("split = 'train'").withColumn("before", before).where((F.col("recent") > 0) & (F.col("before") < least - have))
    return cells.join(moved.select("cell", F.lit("test").alias("to")), "cell", "left").select("cell", F.coalesce("to", "split").alias("split"))


@query("correct_split_budget", "samples")
def correct_split_budget(samples: DataFrame) -> DataFrame:
    return balanced(first_split(samples)).select("cell", "n", "split")


def balanced(cells: DataFrame, shares=(0.7, 0.15, 0.15), tolerance: float = 0.02, most_moves: int = 200, least_recent: int = 1) -> DataFrame:
    """Cells (cell, region, n, classes, recent, split) moved one by one towards the shares of train, val and test.

    A move goes from a split above its share by more than the tolerance to one below; of the cells that may leave, that
    whose move brings the two nearest to their shares (the first by name of ties). A cell may not leave that alone holds
    a class of its split (in val and test: of its region there), nor one whose recent samples test needs. It ends when
    no such pair or move is left. A move is one aggregation over the cells; the driver holds totals and the moves only.
    """
    cells = settled(cells)
    names = ("train", "val", "test")
    have = {r["split"]: r for r in cells.groupBy("split").agg(F.sum("n").alias("n"), F.sum("recent").alias("recent")).collect()}
    held = {k: have[k]["n"] if k in have else 0 for k in names}
    recent = have["test"]["recent"] if "test" in have else 0
    total = sum(held.values())
    wanted = {k: total * share for k, share in zip(names, shares, strict=True)}
    moves: dict[str, str] = {}

    def placed() -> DataFrame:
        if not moves:
            return cells
        to = F.create_map(*(F.lit(x) for move in moves.items() for x in move))
        return cells.withColumn("split", F.coalesce(F.try_element_at(to, F.col("cell")), F.col("split")))

    while len(moves) < most_moves:
        gap = {k: held[k] - wanted[k] for k in names}
        over = sorted((k for k in names if gap[k] > tolerance * total), key=lambda k: -gap[k])
        under = sorted((k for k in names if gap[k] < -tolerance * total), key=lambda k: gap[k])
        pairs = [(a, b) for a in over for b in under]
        if not pairs:
            break
        now = placed().where(F.col("split").isin(over))
        place = F.when(F.col("split") != "train", F.col("region"))
        alone = now.select("cell", "split", place.alias("place"), F.explode("classes").alias("class")).groupBy("split", "place", "class").agg(
            F.count("*").alias("k"), F.min("cell").alias("cell")
        ).where("k = 1").select("cell").distinct()
        free = now.join(alone, "cell", "left_anti").where((F.col("split") != "test") | (F.lit(recent) - F.col("recent") >= least_recent))
        to = F.array(*(F.struct(F.lit(k).alias("rank"), F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(gap[a]).alias("more"), F.lit(gap[b]).alias("less")) for k, (a, b) in enumerate(pairs)))
        tried = free.where("n > 0").select("cell", "n", "recent", "split", F.explode(to).alias("p")).where("split = p.a")
        tried = tried.withColumn("score", F.abs(F.col("p.more") - F.col("n")) + F.abs(F.col("p.less") + F.col("n")))
        better = tried.where(F.col("score") < F.abs("p.more") + F.abs("p.less"))
        best = better.agg(F.min_by(F.struct("cell", "n", "recent", "p.a", "p.b"), F.struct("p.rank", "score", "cell")).alias("m")).first()["m"]
        if best is None:
            break
        moves[best["cell"]] = best["b"]
        held[best["a"]] -= best["n"]
        held[best["b"]] += best["n"]
        recent += best["recent"] * ((best["b"] == "test") - (best["a"] == "test"))
    return placed()


@query("split_distribution", "samples", sql=f"WITH {_SPLIT} SELECT split, count(*) AS n_cells, sum(n) AS n, round(sum(n) * 1e0 / sum(sum(n)) OVER (), 6) AS share FROM sp GROUP BY split")
def split_distribution(samples: DataFrame) -> DataFrame:
    counts = first_split(samples).groupBy("split").agg(F.count("*").alias("n_cells"), F.sum("n").alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))), 6))


@query("assign_sample_splits", "samples", sql=f"""WITH {_SPLIT} SELECT sample_id, CASE WHEN quality_lc = 0 AND quality_ct = 0 THEN 'ignore' WHEN sp.cell IS NULL THEN 'train' WHEN extract = 0 AND split IN ('val', 'test') THEN 'ignore' ELSE split END AS split
  FROM cells LEFT JOIN sp USING (cell)""")
def assign_sample_splits(samples: DataFrame) -> DataFrame:
    """A sample's split is its cell's; unlabelled ones and train-only ones in held-out cells are ignored."""
    joined = cells_of(samples).join(first_split(samples).select("cell", "split"), "cell", "left")
    none = (F.col("quality_lc") == 0) & (F.col("quality_ct") == 0)
    held = (F.col("extract") == 0) & F.col("split").isin("val", "test")
    return joined.select("sample_id", F.when(none, "ignore").when(F.col("split").isNull(), "train").when(held, "ignore").otherwise(F.col("split")).alias("split"))


@query("sample_per_dataset_class", "samples", sql=f"""SELECT ref_id, landcover, sample_id FROM (SELECT *, row_number() OVER (PARTITION BY ref_id, landcover ORDER BY {_chance('sample_id')}, sample_id) AS r FROM samples) WHERE r <= 3""")
def sample_per_dataset_class(samples: DataFrame, size: int = 3) -> DataFrame:
    drawn = samples.withColumn("_c", chance("sample_id")).withColumn("r", F.row_number().over(Window.partitionBy("ref_id", "landcover").orderBy("_c", "sample_id")))
    return drawn.where(F.col("r") <= size).select("ref_id", "landcover", "sample_id")


@query("subsample_class", "samples", sql=f"""WITH c AS (SELECT ref_id, count(*) * 20e0 / sum(count(*)) OVER () AS q FROM samples WHERE extract = 1 GROUP BY ref_id),
  a AS (SELECT ref_id, floor(q) + CASE WHEN row_number() OVER (ORDER BY round(q - floor(q), 9) DESC, ref_id) <= 20 - sum(floor(q)) OVER () THEN 1 ELSE 0 END AS n FROM c),
  r AS (SELECT *, row_number() OVER (PARTITION BY ref_id ORDER BY {_chance('sample_id')}, sample_id) AS r FROM samples WHERE extract = 1)
  SELECT sample_id FROM r JOIN a USING (ref_id) WHERE r <= n UNION ALL SELECT sample_id FROM samples WHERE extract <> 1""")
def subsample_class(samples: DataFrame, size: int = 20) -> DataFrame:
    """One class cut to a size, shared among datasets by largest remainder; other classes untouched."""
    one = samples.where("extract = 1").withColumn("_c", chance("sample_id"))
    whole = Window.partitionBy(F.lit(1))
    q = one.groupBy("ref_id").agg(F.count("*").alias("c")).withColumn("q", F.col("c") * size / F.sum("c").over(whole)).withColumn("f", F.floor("q"))
    k = F.row_number().over(whole.orderBy(F.desc(F.round(F.col("q") - F.col("f"), 9)), "ref_id"))
    quota = q.withColumn("k", k).withColumn("n", F.col("f") + F.when(F.col("k") <= size - F.sum("f").over(whole), 1).otherwise(0)).select("ref_id", "n")
    ranked = one.withColumn("r", F.row_number().over(Window.partitionBy("ref_id").orderBy("_c", "sample_id"))).join(quota, "ref_id")
    return ranked.where("r <= n").select("sample_id").unionByName(samples.where("extract <> 1").select("sample_id"))


@query("select_window_start", "samples", sql="SELECT sample_id, greatest(0, least(CAST(quality_ct AS INTEGER) * 4 - 6, 24 - 12)) AS window_start FROM samples")
def select_window_start(samples: DataFrame, steps: int = 12, available: int = 24) -> DataFrame:
    """First of ``steps`` steps round the valid position, kept within what is available."""
    position = F.col("quality_ct").cast("int") * 4
    return samples.select("sample_id", F.greatest(F.lit(0), F.least(position - steps // 2, F.lit(available - steps))).alias("window_start"))


@query("window_with_data", "obs", sql="""SELECT sample_id, min(ind) AS window_start FROM (SELECT sample_id, row_number() OVER (PARTITION BY sample_id ORDER BY ts) - 1 AS ind,
  count(*) FILTER (vv > 5) OVER (PARTITION BY sample_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS k FROM obs) WHERE k = 3 GROUP BY sample_id""")
def window_with_data(obs: DataFrame, steps: int = 3) -> DataFrame:
    """The first window of steps that all hold radar data; samples without one go."""
    order = Window.partitionBy("sample_id").orderBy("ts")
    full = F.count(F.when(F.col("vv") > 5, 1)).over(order.rowsBetween(0, steps - 1))
    at = obs.withColumn("ind", F.row_number().over(order) - 1).withColumn("k", full).where(F.col("k") == steps)
    return at.groupBy("sample_id").agg(F.min("ind").alias("window_start"))


_STEP = "concat(sample_id, '|', CAST(ts AS VARCHAR))"


@query("sensor_masking", "obs", sql=f"""WITH o AS (SELECT *, CAST(split_part(sample_id, '_', 1) AS INTEGER) AS elevation, row_number() OVER (PARTITION BY sample_id ORDER BY ts) - 1 AS i, count(*) OVER (PARTITION BY sample_id) AS t FROM obs),
  k AS (SELECT *, 2 + CAST(floor({_chance('sample_id', 3)} * 4) AS INTEGER) AS len FROM o), b AS (SELECT *, CAST(floor({_chance('sample_id', 4)} * (t - len + 1)) AS INTEGER) AS start FROM k),
  d AS (SELECT *, {_chance('sample_id', 1)} < 0.1e0 OR {_chance(_STEP, 2)} < 0.1e0 AS rd, ({_chance('sample_id', 5)} < 0.3e0 AND (len >= t OR i BETWEEN start AND start + len - 1)) OR {_chance(_STEP, 6)} < 0.2e0 AS od, vv = 65535 AND vh = 65535 AS rm, b02 = 65535 AND b04 = 65535 AS om FROM b),
  g AS (SELECT *, count(*) FILTER (NOT (rd OR rm)) OVER s = 0 AND count(*) FILTER (NOT (od OR om)) OVER s = 0 AS lost, count(*) FILTER (od AND NOT om) OVER s AS ok, count(*) FILTER (rd AND NOT rm) OVER s AS rk,
    row_number() OVER (s ORDER BY CASE WHEN od AND NOT om THEN 0 ELSE 1 END, {_chance(_STEP, 7)}, ts) AS first_o, row_number() OVER (s ORDER BY CASE WHEN rd AND NOT rm THEN 0 ELSE 1 END, {_chance(_STEP, 7)}, ts) AS first_r FROM d WINDOW s AS (PARTITION BY sample_id)),
  m AS (SELECT *, od AND NOT (lost AND ok > 0 AND first_o = 1) AS od2, rd AND NOT (lost AND ok = 0 AND rk > 0 AND first_r = 1) AS rd2 FROM g)
  SELECT sample_id, ts, CASE WHEN od2 THEN 65535 ELSE b02 END AS b02, CASE WHEN od2 THEN 65535 ELSE b04 END AS b04, CASE WHEN rd2 THEN 65535 ELSE vv END AS vv, CASE WHEN rd2 THEN 65535 ELSE vh END AS vh,
  CASE WHEN {_chance(_STEP, 8)} < 0.1e0 THEN 65535 ELSE b08 END AS b08, CASE WHEN {_chance('sample_id', 9)} < 0.05e0 THEN 65535 ELSE elevation END AS elevation FROM m""")
def q_sensor_masking(obs: DataFrame) -> DataFrame:
    """b08 stands for a weather band, the first part of the id for a height."""
    bands = {"optical": ("b02", "b04"), "radar": ("vv", "vh"), "meteo": ("b08",), "dem": ("elevation",)}
    whole = obs.withColumn("elevation", F.split_part("sample_id", F.lit("_"), F.lit(1)).cast("int"))
    masked = sensor_masking(whole, bands, radar_full=0.1, radar_step=0.1, cloud_block=0.3, cloud_step=0.2, meteo_step=0.1, dem_all=0.05)
    return masked.select("sample_id", "ts", *(b for family in bands.values() for b in family))


def sensor_masking(
    obs: DataFrame, bands: dict[str, tuple[str, ...]], radar_full=0.0, radar_step=0.0, cloud_block=0.0, cloud_step=0.0, meteo_step=0.0, dem_all=0.0, block=(2, 5),
) -> DataFrame:
    """Seeded loss of sensors: radar by series or step, optical by a block of steps or by step, weather by step, heights by series.

    Where that, with what is missing already, would leave a sample without any radar and optical step, one lost optical
    step stays (if it has none, a radar one), unless the loss of that sensor is certain. All windows are by sample: one shuffle.
    """
    shares = {"radar_full": radar_full, "radar_step": radar_step, "cloud_block": cloud_block, "cloud_step": cloud_step, "meteo_step": meteo_step, "dem_all": dem_all}
    if wrong := [k for k, v in shares.items() if not 0 <= v <= 1]:
        raise ValueError(f"not in [0, 1]: {', '.join(wrong)}")
    if block[0] > block[1]:
        raise ValueError("the least block is longer than the longest")
    if radar_full >= 1 and cloud_step >= 1:
        raise ValueError("both sensors would be lost in every sample")

    def gone(family: str) -> Column:
        return F.array_min(F.array(*(F.col(b) == NODATA for b in bands[family])))

    sample, step = ("sample_id",), ("sample_id", "ts")
    by = Window.partitionBy("sample_id")
    o = dealt(obs, "sample_id").withColumn("_i", F.row_number().over(by.orderBy("ts")) - 1).withColumn("_t", F.count("*").over(by))
    o = o.withColumn("_len", block[0] + F.floor(chance(*sample, seed=3) * (block[1] - block[0] + 1)))
    start = F.floor(chance(*sample, seed=4) * (F.col("_t") - F.col("_len") + 1))
    in_block = (F.col("_len") >= F.col("_t")) | F.col("_i").between(start, start + F.col("_len") - 1)
    o = o.withColumn("_rd", (chance(*sample, seed=1) < radar_full) | (chance(*step, seed=2) < radar_step))
    o = o.withColumn("_od", ((chance(*sample, seed=5) < cloud_block) & in_block) | (chance(*step, seed=6) < cloud_step))
    o = o.withColumn("_rm", gone("radar")).withColumn("_om", gone("optical"))
    left = [F.count(F.when(~(F.col(d) | F.col(m)), 1)).over(by) for d, m in (("_rd", "_rm"), ("_od", "_om"))]
    back = {"o": F.col("_od") & ~F.col("_om"), "r": F.col("_rd") & ~F.col("_rm")}
    o = o.withColumn("_lost", (left[0] == 0) & (left[1] == 0)).withColumn("_h", chance(*step, seed=7))
    for k, c in back.items():
        o = o.withColumn(f"_{k}n", F.count(F.when(c, 1)).over(by)).withColumn(f"_{k}1", F.row_number().over(by.orderBy(F.when(c, 0).otherwise(1), "_h", "ts")) == 1)
    optical_back = F.col("_lost") & (F.col("_on") > 0) & F.lit(cloud_step < 1)
    radar_back = F.col("_lost") & ~((F.col("_on") > 0) & F.lit(cloud_step < 1)) & (F.col("_rn") > 0) & F.lit(radar_full < 1)
    lost = {
        "optical": F.col("_od") & ~(optical_back & F.col("_o1")), "radar": F.col("_rd") & ~(radar_back & F.col("_r1")),
        "meteo": chance(*step, seed=8) < meteo_step, "dem": chance(*sample, seed=9) < dem_all,
    }
    masked = {b: F.when(lost[family], NODATA).otherwise(F.col(b)) for family, names in bands.items() for b in names}
    return o.select(*(masked[c].alias(c) if c in masked else F.col(c) for c in obs.columns))


@query("repeat_samples", "samples", sql="SELECT sample_id, CAST(k AS INTEGER) AS copy FROM samples, range(1, 4) r(k)")
def repeat_samples(samples: DataFrame, times: int = 3) -> DataFrame:
    return samples.select("sample_id", F.explode(F.sequence(F.lit(1), F.lit(times))).alias("copy"))


@query("time_explicit_label", "samples", sql="SELECT sample_id, concat(repeat('0', CAST(greatest(quality_ct - 1, 0) AS INTEGER)), repeat('1', CAST(quality_ct + 2 - greatest(quality_ct - 1, 0) AS INTEGER)), repeat('0', CAST(10 - quality_ct AS INTEGER))) AS labels FROM samples")
def time_explicit_label(samples: DataFrame, steps: int = 12, reach: int = 1) -> DataFrame:
    """The label at each step within reach of the valid position, written as digits."""
    at = F.col("quality_ct").cast("int")
    label = F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda i: F.when(F.abs(i - at) <= reach, "1").otherwise("0"))
    return samples.select("sample_id", F.array_join(label, "").alias("labels"))


# weights and quality


def class_weights(counts: DataFrame, method: str, low: float = 0.1, high: float = 10.0) -> DataFrame:
    """Weight of each class from its count ``n``: mean 1 over classes, then clipped."""
    total, k = F.sum("n").over(Window.partitionBy(F.lit(1))), F.count("*").over(Window.partitionBy(F.lit(1)))
    raw = {"balanced": total / (k * F.col("n")), "log": F.log1p(total / F.col("n")), "effective": 0.01 / (1 - F.pow(F.lit(0.99), F.col("n"))), "none": F.lit(1.0)}[method]
    w = counts.withColumn("w", raw)
    mean = F.avg("w").over(Window.partitionBy(F.lit(1)))
    return w.withColumn("w", F.least(F.greatest(F.col("w") / mean, F.lit(low)), F.lit(high)))


@query("class_weights", "samples", sql="""WITH c AS (SELECT landcover, count(*) AS n FROM samples GROUP BY 1), r AS (SELECT landcover, n, ln(1 + sum(n) OVER () * 1e0 / n) AS w FROM c)
  SELECT landcover, n, round(least(greatest(w / avg(w) OVER (), 0.1e0), 10e0), 6) AS w FROM r""")
def q_class_weights(samples: DataFrame) -> DataFrame:
    return class_weights(samples.groupBy("landcover").agg(F.count("*").alias("n")), "log").withColumn("w", F.round("w", 6))


_BIN = "concat_ws('_', CAST(floor((lat + 90) / 20) AS BIGINT), CAST(floor((lon + 180) / 20) AS BIGINT))"


@query("spatial_density_weights", "samples", sql=f"""WITH c AS (SELECT {_BIN} AS bin, count(*) AS n FROM samples GROUP BY 1), r AS (SELECT bin, n, sum(n) OVER () * 1e0 / (count(*) OVER () * n) AS w FROM c), m AS (SELECT bin, n, w / avg(w) OVER () AS w FROM r)
  SELECT bin, n, CASE WHEN n < 3 THEN 1e0 ELSE round(least(greatest(w, 0.1e0), 10e0), 6) END AS w FROM m""")
def spatial_density_weights(samples: DataFrame, least: int = 3) -> DataFrame:
    """Weight of each bin; bins with few samples count 1."""
    counts = samples.groupBy(lat_lon_bin(20.0).alias("bin")).agg(F.count("*").alias("n"))
    return class_weights(counts, "balanced").withColumn("w", F.when(F.col("n") < least, 1.0).otherwise(F.round("w", 6)))


def bin_class_weights(samples: DataFrame, size: float, least: int) -> DataFrame:
    """Class weights inside each bin with a pseudo-count, over the bin's sample mean; sparse bins use the global ones; global mean 1."""
    pseudo = max(1, least // 10)
    counts = samples.groupBy(lat_lon_bin(size).alias("bin"), "extract").agg(F.count("*").alias("n"))
    by_bin, whole = Window.partitionBy("bin"), Window.partitionBy(F.lit(1))
    local = counts.withColumn("bn", F.sum("n").over(by_bin)).withColumn("raw", F.col("bn") / (F.col("n") + pseudo))
    local = local.withColumn("local", F.col("raw") / (F.sum(F.col("raw") * F.col("n")).over(by_bin) / F.col("bn")))
    by_class = Window.partitionBy("extract")
    overall = F.sum("n").over(whole) / F.sum("n").over(by_class)
    w = local.withColumn("g", overall).withColumn("w", F.when(F.col("bn") < least, F.col("g")).otherwise(F.col("local")))
    mean = F.sum(F.col("w") * F.col("n")).over(whole) / F.sum("n").over(whole)
    return w.withColumn("w", F.least(F.greatest(F.col("w") / mean, F.lit(0.1)), F.lit(10.0))).select("bin", "extract", "n", "w")


_BCW = f"""k AS (SELECT {_BIN} AS bin, extract, count(*) AS n FROM samples GROUP BY 1, 2), l AS (SELECT *, sum(n) OVER (PARTITION BY bin) AS bn, sum(n) OVER () * 1e0 / sum(n) OVER (PARTITION BY extract) AS g FROM k),
  l2 AS (SELECT *, bn * 1e0 / (n + 1) AS raw FROM l), l3 AS (SELECT *, raw / (sum(raw * n) OVER (PARTITION BY bin) / bn) AS loc FROM l2), l4 AS (SELECT *, CASE WHEN bn < 4 THEN g ELSE loc END AS w0 FROM l3),
  bcw AS (SELECT bin, extract, n, least(greatest(w0 / (sum(w0 * n) OVER () / sum(n) OVER ()), 0.1e0), 10e0) AS w FROM l4)"""


@query("per_bin_class_weights", "samples", sql=f"WITH {_BCW} SELECT bin, extract, n, round(w, 6) AS w FROM bcw")
def per_bin_class_weights(samples: DataFrame) -> DataFrame:
    return bin_class_weights(samples, 20.0, 4).withColumn("w", F.round("w", 6))


@query("bilinear_bin_weights", "samples", sql=f"""WITH {_BCW}, p AS (SELECT sample_id, extract, (lat + 90) / 20 - 0.5e0 AS fy, (lon + 180) / 20 - 0.5e0 AS fx FROM samples),
  c AS (SELECT p.*, floor(fy) + dy AS cy, floor(fx) + dx AS cx, (CASE WHEN dy = 0 THEN 1 - (fy - floor(fy)) ELSE fy - floor(fy) END) * (CASE WHEN dx = 0 THEN 1 - (fx - floor(fx)) ELSE fx - floor(fx) END) AS b FROM p, range(0, 2) a(dy), range(0, 2) d(dx))
  SELECT sample_id, round(coalesce(sum(b * w) / nullif(sum(CASE WHEN w IS NOT NULL THEN b END), 0), 1), 5) AS w FROM c LEFT JOIN bcw ON bcw.bin = concat_ws('_', CAST(cy AS BIGINT), CAST(cx AS BIGINT)) AND bcw.extract = c.extract GROUP BY sample_id""")
def bilinear_bin_weights(samples: DataFrame, size: float = 20.0) -> DataFrame:
    """The weight of each sample's class interpolated between the four bins around it; missing corners share out theirs."""
    weights = bin_class_weights(samples, size, 4).select("bin", "extract", "w")
    fy, fx = (F.col("lat") + 90) / size - 0.5, (F.col("lon") + 180) / size - 0.5
    ry, rx = fy - F.floor(fy), fx - F.floor(fx)
    corners = F.array(*(
        F.struct(F.concat_ws("_", (F.floor(fy) + dy).cast("string"), (F.floor(fx) + dx).cast("string")).alias("bin"), ((ry if dy else 1 - ry) * (rx if dx else 1 - rx)).alias("b"))
        for dy in (0, 1) for dx in (0, 1)
    ))
    rows = samples.select("sample_id", "extract", F.explode(corners).alias("c")).select("sample_id", "extract", "c.bin", "c.b")
    total = F.sum(F.when(F.col("w").isNotNull(), F.col("b")))
    w = F.coalesce(F.try_divide(F.sum(F.col("b") * F.col("w")), total), F.lit(1.0))
    return rows.join(weights, ["bin", "extract"], "left").groupBy("sample_id").agg(F.round(w, 5).alias("w"))


@query("weight_multipliers", "samples", sql="SELECT sample_id, round(weight * CASE WHEN landcover = 'Brand#11' THEN CASE WHEN extract = 1 THEN 2e0 ELSE 1.5e0 END ELSE 1e0 END, 6) AS w FROM samples")
def weight_multipliers(samples: DataFrame) -> DataFrame:
    """Multipliers by (group, class), ``*`` standing for every group; the exact entry wins."""
    entries = samples.sparkSession.createDataFrame([("1", "Brand#11", 2.0), ("*", "Brand#11", 1.5)], "g string, landcover string, m double")
    exact = entries.where("g <> '*'").select("g", "landcover", F.col("m").alias("exact"))
    anyone = entries.where("g = '*'").select("landcover", F.col("m").alias("wild"))
    joined = samples.withColumn("g", F.col("extract").cast("string")).join(F.broadcast(exact), ["g", "landcover"], "left").join(F.broadcast(anyone), "landcover", "left")
    return joined.select("sample_id", F.round(F.col("weight") * F.coalesce("exact", "wild", F.lit(1.0)), 6).alias("w"))


@query("pool_probabilities", "samples", sql="SELECT sample_id, round(weight / (SELECT sum(weight) FROM samples), 9) AS p FROM samples")
def pool_probabilities(samples: DataFrame) -> DataFrame:
    """Weights over their sum, which is one number found first."""
    total = samples.agg(F.sum("weight")).first()[0]
    return samples.select("sample_id", F.round(F.col("weight") / F.lit(total), 9).alias("p"))


@query("sample_weights", "samples", sql="""SELECT sample_id, round(least(greatest(quality_lc / CASE WHEN (SELECT max(quality_lc) FROM samples) > 1.5 THEN 100 ELSE 1 END, 0), 1) * least(greatest(quality_ct / CASE WHEN (SELECT max(quality_ct) FROM samples) > 1.5 THEN 100 ELSE 1 END, 0), 1) * CASE WHEN extract = 0 THEN 0 ELSE 1 END, 6) AS w FROM samples""")
def sample_weights(samples: DataFrame) -> DataFrame:
    """Quality times score times not flagged; a column with a value over 1.5 is in percent as a whole."""
    top = samples.agg(F.max("quality_lc").alias("a"), F.max("quality_ct").alias("b")).first()

    def unit(c: str, most: float) -> Column:
        return F.least(F.greatest(F.col(c) / (100 if (most or 0) > 1.5 else 1), F.lit(0.0)), F.lit(1.0))

    flag = F.when(F.col("extract") == 0, 0.0).otherwise(1.0)
    return samples.select("sample_id", F.round(unit("quality_lc", top["a"]) * unit("quality_ct", top["b"]) * flag, 6).alias("w"))


@query("identify_outliers", "samples", sql="SELECT sample_id, quality_ct IN (0, 1) AS outlier FROM samples")
def identify_outliers(samples: DataFrame, level: str = "suspect") -> DataFrame:
    """Outlier flags up to a level: candidates, suspects, flagged."""
    levels = ["candidate", "suspect", "flagged"]
    return samples.select("sample_id", F.col("quality_ct").isin(*range(levels.index(level) + 1)).alias("outlier"))


@query("patch_lc_quality", "samples", sql="SELECT sample_id, CASE WHEN regexp_matches(ref_id, '_10[01]$') THEN quality_lc ELSE quality_ct END AS quality_ct FROM samples")
def patch_lc_quality(samples: DataFrame) -> DataFrame:
    return samples.select("sample_id", F.when(F.col("ref_id").rlike("_10[01]$"), F.col("quality_lc")).otherwise(F.col("quality_ct")).alias("quality_ct"))


@query("drop_zero_quality", "samples", sql="SELECT sample_id FROM samples WHERE NOT (coalesce(quality_ct, 1) = 0 AND extract = 0)")
def drop_zero_quality(samples: DataFrame) -> DataFrame:
    zero = (F.coalesce("quality_ct", F.lit(1)) == 0) & (F.col("extract") == 0)
    return samples.where(~zero).select("sample_id")


@query("filter_low_weight_eval", "samples", sql="""WITH p AS (SELECT *, quantile_cont(quality_lc, 0.2) OVER (PARTITION BY ref_id) AS p20 FROM samples), f AS (SELECT *, quality_lc < p20 AND quality_lc < 50 AS low FROM p),
  g AS (SELECT *, count(*) FILTER (NOT low) OVER (PARTITION BY landcover) AS left_over FROM f) SELECT sample_id FROM g WHERE NOT low OR left_over < 5""")
def filter_low_weight_eval(samples: DataFrame, floor: float = 50.0, share: float = 0.2, least: int = 5) -> DataFrame:
    """Rows below both the dataset's percentile and the floor go, unless their class would fall below a minimum."""
    p = samples.groupBy("ref_id").agg(F.percentile("quality_lc", F.lit(share)).alias("p"))
    flagged = samples.join(p, "ref_id").withColumn("low", (F.col("quality_lc") < F.col("p")) & (F.col("quality_lc") < floor))
    left = flagged.groupBy("landcover").agg(F.count(F.when(~F.col("low"), 1)).alias("left_over"))
    return flagged.join(left, "landcover").where(~F.col("low") | (F.col("left_over") < least)).select("sample_id")


# metrics


@query("confusion_matrix", "predictions", sql="SELECT target, prediction, count(*) AS n, round(count(*) * 1e0 / sum(count(*)) OVER (PARTITION BY target), 6) AS share FROM predictions GROUP BY target, prediction")
def confusion_matrix(predictions: DataFrame) -> DataFrame:
    counts = predictions.groupBy("target", "prediction").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("target")), 6))


def per_class(predictions: DataFrame, *group: str) -> DataFrame:
    """Precision, recall, F1 and support of each class (in each group), divisions by zero giving 0."""
    both = predictions.select(*group, F.col("target").alias("label"), F.lit(1).alias("t"), F.lit(0).alias("p"), (F.col("target") == F.col("prediction")).cast("int").alias("tp")).unionByName(
        predictions.select(*group, F.col("prediction").alias("label"), F.lit(0).alias("t"), F.lit(1).alias("p"), F.lit(0).alias("tp"))
    )
    s = both.groupBy(*group, "label").agg(F.sum("t").alias("support"), F.sum("p").alias("predicted"), F.sum("tp").alias("tp"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return s.withColumn("precision", ratio(F.col("tp"), F.col("predicted"))).withColumn("recall", ratio(F.col("tp"), F.col("support"))).withColumn(
        "f1", ratio(2 * F.col("tp"), F.col("predicted") + F.col("support"))
    )


_PC = """pc AS (SELECT g, label, sum(t) AS support, sum(p) AS predicted, sum(tp) AS tp FROM (SELECT {g} AS g, target AS label, 1 AS t, 0 AS p, CASE WHEN target = prediction THEN 1 ELSE 0 END AS tp FROM predictions
  UNION ALL SELECT {g}, prediction, 0, 1, 0 FROM predictions) GROUP BY g, label)"""


@query("classification_report", "predictions", sql=f"""WITH {_PC.format(g="'all'")} SELECT label, CAST(support AS BIGINT) AS support, round(coalesce(tp * 1e0 / nullif(predicted, 0), 0), 6) AS precision, round(coalesce(tp * 1e0 / nullif(support, 0), 0), 6) AS recall, round(2e0 * tp / (predicted + support), 6) AS f1 FROM pc
  UNION ALL SELECT 'macro', sum(support), round(avg(coalesce(tp * 1e0 / nullif(predicted, 0), 0)), 6), round(avg(coalesce(tp * 1e0 / nullif(support, 0), 0)), 6), round(avg(2e0 * tp / (predicted + support)), 6) FROM pc""")
def classification_report(predictions: DataFrame) -> DataFrame:
    c = per_class(predictions)
    stats = ("precision", "recall", "f1")
    macro = c.agg(F.lit("macro").alias("label"), F.sum("support").alias("support"), *(F.round(F.avg(x), 6).alias(x) for x in stats))
    return c.select("label", "support", *(F.round(x, 6).alias(x) for x in stats)).unionByName(macro)


@query("regional_mean_f1", "predictions", sql=f"WITH {_PC.format(g='region')}, r AS (SELECT g, avg(2e0 * tp / (predicted + support)) AS f1, sum(support) AS n FROM pc GROUP BY g HAVING sum(support) >= 50) SELECT round(avg(f1), 6) AS regional_f1, count(*) AS n_regions FROM r")
def regional_mean_f1(predictions: DataFrame, least: int = 50) -> DataFrame:
    """Mean over regions with support of their macro F1."""
    regions = per_class(predictions, "region").groupBy("region").agg(F.avg("f1").alias("f1"), F.sum("support").alias("n")).where(F.col("n") >= least)
    return regions.agg(F.round(F.avg("f1"), 6).alias("regional_f1"), F.count("*").alias("n_regions"))


@query("evaluate_predictions", "predictions", sql="""SELECT round(avg(CASE WHEN target = prediction THEN 1e0 ELSE 0e0 END), 6) AS accuracy, count(*) AS n, (SELECT count(*) FROM predictions WHERE weight <= 0.25e0) AS rejected FROM predictions WHERE weight > 0.25e0""")
def evaluate_predictions(predictions: DataFrame, least_weight: float = 0.25) -> DataFrame:
    """Accuracy of rows with enough weight, and how many were rejected."""
    kept = F.col("weight") > least_weight
    return predictions.agg(
        F.round(F.avg(F.when(kept, (F.col("target") == F.col("prediction")).cast("double"))), 6).alias("accuracy"), F.count(F.when(kept, 1)).alias("n"), F.count(F.when(~kept, 1)).alias("rejected")
    )


@query("crop_false_positive_ratio", "predictions", sql="SELECT round(count(*) FILTER (prediction IN ('c0', 'c1')) * 1e0 / nullif(count(*), 0), 6) AS ratio FROM predictions WHERE target NOT IN ('c0', 'c1')")
def crop_false_positive_ratio(predictions: DataFrame, crops=("c0", "c1")) -> DataFrame:
    other = predictions.where(~F.col("target").isin(*crops))
    return other.agg(F.round(F.try_divide(F.count(F.when(F.col("prediction").isin(*crops), 1)), F.count("*")), 6).alias("ratio"))
