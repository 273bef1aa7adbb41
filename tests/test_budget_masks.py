"""Budget moves, sensor masking and raster operators beyond what their registered queries show."""

import random

import pytest
from pyspark.sql import functions as F

from agrispark.operators import pixels, splits

CELLS = "cell string, region string, n long, classes array<string>, recent long, split string"
SHARE = {"train": 0.7, "val": 0.15, "test": 0.15}


def placed(spark, rows):
    return {r["cell"]: r["split"] for r in splits.balanced(spark.createDataFrame(rows, CELLS)).collect()}


def test_budget_moves_reach_the_tolerance_and_lose_no_class(spark):
    r = random.Random(5)
    rows = [(f"c{k:03}", f"r{k % 3}", r.randint(1, 40), sorted(r.sample("abcdef", 3)), r.randint(0, 2), r.choices(["train", "val", "test"], [1, 1, 4])[0]) for k in range(60)]
    got, total = placed(spark, rows), sum(x[2] for x in rows)
    for s, share in SHARE.items():
        assert abs(sum(x[2] for x in rows if got[x[0]] == s) - share * total) <= 0.02 * total + 20
    for s in SHARE:
        def kinds(where):
            return {(x[1] if s != "train" else "", c) for x in rows if where(x) == s for c in x[3]}
        assert kinds(lambda x: x[5]) <= kinds(lambda x: got[x[0]])
    assert sum(x[4] for x in rows if got[x[0]] == "test") >= 1
    assert len(got) == len(rows)


def test_budget_takes_the_best_cell_and_keeps_the_last_of_a_class(spark):
    rows = [("a", "r", 70, ["x"], 1, "train"), ("b", "r", 14, ["x"], 0, "test"), ("c", "r", 9, ["y"], 0, "test"), ("d", "r", 7, ["x"], 9, "test")]
    # b brings val to 14 of 15; afterwards test holds 16 of 15
    assert placed(spark, rows) == {"a": "train", "b": "val", "c": "test", "d": "test"}
    alone = [("a", "r", 70, ["x"], 1, "train"), ("b", "r", 30, ["y"], 1, "test")]
    assert placed(spark, alone) == {"a": "train", "b": "test"}
    assert placed(spark, []) == {}


BANDS = {"optical": ("b02",), "radar": ("vv",), "meteo": ("t",), "dem": ("e",)}


def test_masking_never_empties_both_sensors(spark):
    obs = spark.range(400).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("sample_id"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("ts"))
    obs = obs.select("*", *(F.lit(1).alias(b[0]) for b in BANDS.values())).withColumn("b02", F.when((F.hash("sample_id") % 3 == 0) & (F.col("ts") > 1), 65535).otherwise(1))
    got = splits.sensor_masking(obs, BANDS, radar_full=0.9, radar_step=0.5, cloud_block=0.9, cloud_step=0.7, meteo_step=0.5, dem_all=0.5)
    left = got.groupBy("sample_id").agg(F.count_if(F.col("b02") == 1).alias("o"), F.count_if(F.col("vv") == 1).alias("r"), F.countDistinct("e").alias("e")).toPandas()
    assert len(left) == 400 and ((left.o + left.r) > 0).all() and (left.e == 1).all() and (left.r == 0).sum() > 300
    certain = splits.sensor_masking(obs, BANDS, radar_full=1.0, cloud_step=0.9)
    assert certain.where("vv = 1").count() == 0
    assert certain.groupBy("sample_id").agg(F.count_if(F.col("b02") == 1).alias("o")).where("o = 0").count() == 0
    assert splits.sensor_masking(obs, BANDS).exceptAll(obs).count() == 0


def test_masking_checks_its_settings(spark):
    obs = spark.createDataFrame([], "sample_id string, ts int, b02 int, vv int, t int, e int")
    for wrong in ({"radar_full": 1.0, "cloud_step": 1.0}, {"dem_all": 1.5}, {"block": (5, 2)}):
        with pytest.raises(ValueError):
            splits.sensor_masking(obs, BANDS, **wrong)
    assert splits.sensor_masking(obs, BANDS, radar_full=0.5).count() == 0


def test_slope_of_a_plane(spark):
    plane = spark.range(20 * 21).select(F.lit(0).alias("tile"), F.floor(F.col("id") / 21).alias("y"), (F.col("id") % 21).alias("x")).withColumn("elevation", (F.col("x") * 10).cast("int"))
    inner = pixels.slope(plane).where("x between 5 and 15 and y between 4 and 15")
    assert {r["slope"] for r in inner.select("slope").distinct().collect()} <= {44, 45}
    holed = plane.withColumn("elevation", F.when((F.col("x") == 8) & (F.col("y") == 8), 65535).otherwise(F.col("elevation")))
    got = {(r["y"], r["x"]): r["slope"] for r in pixels.slope(holed).collect()}
    assert len(got) == 420 and [k for k, v in got.items() if v == 65535] == [(8, 8)]
    with pytest.raises(ValueError):
        pixels.slope(plane, 20)
