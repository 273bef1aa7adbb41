"""Insets, units, months of a stream, held-out rows, components and plots: results where SQL says nothing or little."""

import json
import math
import random
from collections import Counter

from pyspark.sql import functions as F

from agrispark.operators import polygons, sampling, scoring, seasons, timeseries
from agrispark.streaming import stream_composites


def box(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


def test_inset_in_metres(spark):
    rings = [box(5.0, 52.4, 0.6, 0.1), box(5.5, 52.44, 0.05, 0.02)]
    outlines = spark.createDataFrame([("a", r, k, *p) for r, ring in enumerate(rings) for k, p in enumerate(ring)], "iso3 string, ring int, k int, lon double, lat double")
    east = lambda m: m / (111_320 * math.cos(math.radians(52.45)))
    points = {"in": (5.3, 52.47), "edge 15": (5.0 + east(15), 52.45), "edge 26": (5.0 + east(26), 52.45), "hole": (5.52, 52.45), "hole 15": (5.5 - east(15), 52.45), "hole 26": (5.5 - east(26), 52.45), "out": (4.9999, 52.45), "none": (None, 52.45)}
    df = spark.createDataFrame([(k, *p, 1) for k, p in points.items()], "id string, lon double, lat double, cx int")
    got = polygons.inset(df, outlines, 20.0, ("iso3",), 0.5)
    assert {r.id for r in got.collect()} == {"in", "edge 26", "hole 26"} and got.columns == df.columns
    assert {r.id for r in polygons.inset(df, outlines, 0.0, ("iso3",), 0.5).collect()} == {"in", "edge 15", "edge 26", "hole 15", "hole 26"}


def test_units_are_small_and_hold_every_sample(spark):
    rows = [(f"s{k}", "r", f"2020-0{1 + k % 9}-15" if k % 13 else None, 1.0 + k, 50.0, None if k % 7 == 0 else f"t{k % 2}") for k in range(90)]
    df = spark.createDataFrame(rows, "sample_id string, ref_id string, valid_time string, lon double, lat double, tile string").withColumn("valid_time", F.to_date("valid_time"))
    got = sampling.plan_extraction_units(df, 8).collect()
    dated = [r for r in rows if r[2]]
    units = Counter(r.tile for r in got)
    assert units == {t: -(-sum(r[5] == t for r in dated) // 8) for t in ("t0", "t1", None)}
    held = [f["properties"]["sample_id"] for r in got for f in json.loads(r.geometry)["features"]]
    assert sorted(held) == sorted(r[0] for r in dated) and all(r.n <= 8 for r in got)
    assert all(str(r.start_date).endswith("-01") and r.start_date.year == 2019 for r in got)
    assert sampling.plan_extraction_units(df.where("false")).count() == 0


def test_months_of_a_stream_with_late_rows(spark, tmp_path):
    schema = "sample_id string, ts timestamp, value double"

    def arrive(name, rows):
        spark.createDataFrame(rows, "sample_id string, ts string, value double").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.parquet(str(tmp_path / "in" / name))

    arrive("p=1", [("s", "2021-01-05 00:00:00", 1.0), ("s", "2021-01-25 10:00:00", 3.0), ("u", "2021-01-31 23:59:59", 5.0), ("s", None, 9.0)])
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))

    def run():
        q = stream_composites(source).writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
        return {(r.sample_id, str(r.month)[:7]): (r.value, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    assert run() == {}
    arrive("p=2", [("s", "2021-01-30 00:00:00", 5.0), ("s", "2021-03-01 00:00:00", 1.0)])  # late, but within 40 days
    assert run() == {("s", "2021-01"): (3.0, 3), ("u", "2021-01"): (5.0, 1)}
    arrive("p=3", [("s", "2021-01-02 00:00:00", 99.0), ("s", "2021-05-01 00:00:00", 1.0)])  # too late
    assert run() == {("s", "2021-01"): (3.0, 3), ("u", "2021-01"): (5.0, 1), ("s", "2021-03"): (1.0, 1)}


def vectors(spark, n=600):
    rng = random.Random(2)
    rows = []
    for k in range(n):
        label = k % 3
        rows.append((k, [rng.gauss(4.0 if d == label else 0.0, 1.0) + (20.0 * rng.random() if d == 3 else 0.0) for d in range(6)], label))
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_linear_head_on_rows_that_were_held_out(spark):
    got = scoring.train_linear_head(vectors(spark)).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 600 and 80 < len(held) < 160
    assert sum(r.label == r.prediction for r in held) / len(held) > 0.9


def test_components_follow_the_widest_spread(spark):
    df = vectors(spark)
    for most in (400_000, 200):
        got = {r.vec_id: r for r in scoring.pca_embeddings(df, most=most).collect()}
        wide = {r.vec_id: r.embedding[3] for r in df.collect()}
        xs, ys = [wide[i] for i in sorted(wide)], [got[i].p0 for i in sorted(wide)]
        mx, my = sum(xs) / 600, sum(ys) / 600
        r = sum((x - mx) * (y - my) for x, y in zip(xs, ys)) / math.sqrt(sum((x - mx) ** 2 for x in xs) * sum((y - my) ** 2 for y in ys))
        assert abs(r) > 0.98 and min(ys) == 0.0 and max(ys) == 1.0


def test_series_for_a_plot(spark):
    rows = [(f"s{k}", f"d{k % 3}", f"2021-0{m}-01", k * m) for k in range(20) for m in range(1, 6)]
    df = spark.createDataFrame(rows, "sample_id string, ref_id string, ts string, b02 int").withColumn("ts", F.to_date("ts"))
    got = timeseries.sample_series_for_plot(df, n=5).collect()
    chosen = {r.sample_id for r in got}
    assert len(chosen) == 5 and {r.ref_id for r in got} == {"d0", "d1", "d2"}
    assert sorted((r.sample_id, r.ref_id, str(r.ts), r.b02) for r in got) == sorted(r for r in rows if r[0] in chosen)
    assert {r.sample_id for r in timeseries.sample_series_for_plot(df, n=5).collect()} == chosen


def test_extents_without_cells_and_over_the_dateline(spark):
    cells = [(10.25, 179.75, 10, 40), (10.25, -179.75, 20, 50), (10.75, -179.75, 0, 50), (10.25, 170.25, 90, 100)]
    calendar = spark.createDataFrame(cells, "lat double, lon double, sos_dekad int, eos_dekad int")
    boxes = [("over", 179.0, -179.0, 10.0, 11.0), ("beside", 169.0, 171.0, 10.0, 11.0), ("near", 179.0, -179.0, 12.0, 13.0), ("far", 0.0, 1.0, 10.0, 11.0)]
    df = spark.createDataFrame(boxes, "ref_id string, w double, e double, s double, n double")
    got = {r.ref_id: (r.sos_dekad, r.eos_dekad, r.fallback) for r in seasons.extent_median(df, calendar).collect()}
    assert got["over"] == (15, 45, False) and got["beside"] == (90, 100, False) and got["far"] == (None, None, True)
    assert got["near"][2] and got["near"][0] in (None, 10, 20)
