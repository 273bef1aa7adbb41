"""Membership and nearest polygons against plain loops, on stars, parts, holes, and points at vertices and edges."""

import math
import random

import pytest
from pyspark.sql import functions as F

from agrispark.operators import polygons as P

SCHEMA = "iso3 string, region string, ring int, k int, lon double, lat double"


def shapes(rng):
    """Stars, and squares on whole coordinates with a hole and a second part that share corners and edges."""
    out = {}
    for n in range(6):
        cx, cy = rng.uniform(-170, 170), rng.uniform(-70, 70)
        star = [(cx + r * math.cos(a), cy + r * math.sin(a)) for a, r in ((2 * math.pi * k / 14, rng.uniform(0.5, 9)) for k in range(14))]
        out[f"s{n}"] = [star]
    square = lambda x, y, d: [(x, y), (x + d, y), (x + d, y + d), (x, y + d)]
    out["t0"] = [square(0.0, 0.0, 10.0), square(2.0, 2.0, 3.0), square(12.0, 0.0, 2.0)]
    out["t1"] = [square(10.0, 0.0, 2.0), square(-0.5, 10.0, 12.0)]
    return {k: [r + r[:1] for r in rings] for k, rings in out.items()}


def edges(rings):
    return [(a, b) for r in rings for a, b in zip(r, r[1:])]


def inside(rings, x, y):
    return sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in edges(rings)) % 2 == 1


def flat(lon, lat):
    return math.radians(lon) * 6378137.0, math.log(math.tan(math.radians(lat) / 2 + math.pi / 4)) * 6378137.0


def distance(rings, x, y):
    found = []
    for (ax, ay), (bx, by) in edges(rings):
        t = min(1.0, max(0.0, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
        found.append(math.hypot(x - ax - t * (bx - ax), y - ay - t * (by - ay)))
    return min(found)


def expected(all_shapes, lon, lat):
    if lat is None or not -90 <= lat <= 90 or lon is None or not -180 <= lon <= 180:
        return None, "invalid"
    for name in sorted(all_shapes):
        if inside(all_shapes[name], lon, lat):
            return name, "within"
    metres = {name: [[flat(*p) for p in r] for r in rings] for name, rings in all_shapes.items()}
    return min((round(distance(rings, *flat(lon, lat)), 3), name) for name, rings in metres.items())[1], "nearest"


@pytest.mark.parametrize("broadcast", [True, False])
def test_against_loops(spark, monkeypatch, broadcast):
    rng = random.Random(11)
    all_shapes = shapes(rng)
    points = [(rng.uniform(-180, 180), rng.uniform(-80, 80)) for _ in range(120)] + [(float(x), float(y)) for x in range(-1, 15) for y in range(-1, 13)]
    points += [(p[0] + rng.uniform(-3, 3), p[1] + rng.uniform(-3, 3)) for rings in all_shapes.values() for r in rings for p in r]
    points += [(None, 1.0), (1.0, None), (181.0, 0.0), (0.0, -91.0), (float("nan"), 0.0)]
    if not broadcast:
        monkeypatch.setattr(P, "small", lambda df: df)
        points = points[::5] + points[-5:]
    outlines = spark.createDataFrame([(n, n.upper(), k, j, *p) for n, rings in all_shapes.items() for k, r in enumerate(rings) for j, p in enumerate(r)], SCHEMA)
    df = spark.createDataFrame([(k, *p, "x", 5) for k, p in enumerate(points)], "id int, lon double, lat double, held string, cx int")
    got = {r.id: r for r in P.placed(df.drop("held", "cx"), outlines).collect()}
    assert len(got) == len(points)
    for k, p in enumerate(points):
        assert (got[k].iso3, got[k].status) == expected(all_shapes, *(None if v is not None and v != v else v for v in p)), p
        assert got[k].region == (got[k].iso3 and got[k].iso3.upper()) and (got[k].lon == p[0] or p[0] is None or p[0] != p[0])


def test_far_points_and_no_polygons(spark):
    outlines = spark.createDataFrame([("a", "A", 0, j, *p) for j, p in enumerate([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)])], SCHEMA)
    df = spark.createDataFrame([(1, 179.0, -89.95), (2, -179.0, 80.0), (3, 0.9, 0.5)], "id int, lon double, lat double")
    assert {(r.id, r.iso3, r.status) for r in P.placed(df, outlines).collect()} == {(1, "a", "nearest"), (2, "a", "nearest"), (3, "a", "within")}
    assert {(r.iso3, r.status) for r in P.placed(df, outlines.where("false")).collect()} == {(None, None)}
    assert P.placed(df.where("false"), outlines).count() == 0


def test_one_row_a_cell_holds_what_is_near_only(spark):
    ring = [(10 * math.cos(2 * math.pi * k / 2000), 10 * math.sin(2 * math.pi * k / 2000)) for k in range(2000)]
    outlines = spark.createDataFrame([("a", "A", 0, j, *p) for j, p in enumerate(ring + ring[:1])], SCHEMA)
    cells = P.cells_of_shapes(P.edges_of(outlines), 1.0).select(F.size(F.col("shapes")[0]["near"]).alias("n")).collect()
    assert max(r.n for r in cells) < 150 and len(cells) > 300
