"""Greedy cover against counting all gains after each placement."""

import random

import pytest
from pyspark.sql import functions as F

from agrispark.operators import covers

SCHEMA = "region string, cell string, lc array<string>, ct array<string>, placed boolean"


def plain(rows, targets=None):
    """Placements and what stays missing by a loop over all cells."""
    by = {}
    for region, cell, lc, ct, placed in rows:
        by.setdefault(region, {})[cell] = (set(lc or ()), set(ct or ()))
    there = {r[1] for r in rows if r[4]}
    free = {r[1] for r in rows} - there
    picks, left = [], {}
    for region in sorted(targets or by):
        own = by.get(region, {})
        want = targets[region] if targets else tuple(set().union(*(c[k] for c in own.values())) for k in (0, 1))
        missing = [set(want[k]) - set().union(*(own[c][k] for c in there if c in own)) for k in (0, 1)]
        while any(missing):
            gains = [(-len(own[c][0] & missing[0]) - len(own[c][1] & missing[1]), c) for c in free if c in own]
            if not gains or not min(gains)[0]:
                left[region] = tuple(missing)
                break
            gain, cell = min(gains)
            free.remove(cell)
            there.add(cell)
            picks.append((region, cell, -gain))
            missing = [m - own[cell][k] for k, m in enumerate(missing)]
    return picks, left


def cells(rng, n, regions, classes):
    out = []
    for k in range(n):
        for region in rng.sample(range(regions), rng.choice([1, 1, 2]) if regions > 1 else 1):
            draw = lambda kind: [f"{kind}{c}" for c in rng.sample(range(classes), rng.randint(0, 3))]
            out.append((f"r{region}", f"c{k:03}", draw("lc"), draw("ct"), k % 7 == 0))
    return out


@pytest.mark.parametrize(("regions", "ahead"), [(1, 256), (1, 3), (4, 256), (4, 2)])
def test_equals_the_plain_loop(spark, regions, ahead):
    rows = cells(random.Random(regions), 120, regions, 70)
    picks, left, jobs = covers.greedy_cover(spark.createDataFrame(rows, SCHEMA).repartition(5), ahead=ahead)
    assert (picks, left) == plain(rows)
    assert len(picks) > 8 and (ahead < 256 or jobs == 1)
    if (regions, ahead) == (4, 2):
        assert jobs < len(picks)


def test_targets_placed_cells_and_what_stays_missing(spark):
    rows = [("a", "c1", ["x"], ["m"], False), ("a", "c2", ["y"], None, True), ("b", "c1", ["z"], [], False), ("b", "c3", ["w"], ["m"], None)]
    targets = {"a": ({"x", "y", "gone"}, {"m"}), "b": ({"z"}, {"m"}), "none": ({"x"}, set())}
    df = spark.createDataFrame([(r, sorted(t[0]), sorted(t[1])) for r, t in targets.items()], "region string, lc array<string>, ct array<string>")
    picks, left, _ = covers.greedy_cover(spark.createDataFrame(rows, SCHEMA), df)
    assert picks == [("a", "c1", 2), ("b", "c3", 1)]
    assert left == {"a": ({"gone"}, set()), "none": ({"x"}, set())}
    assert covers.greedy_cover(spark.createDataFrame([], SCHEMA)) == ([], {}, 0)


def test_registered_covers_reach_every_class(spark):
    samples = spark.createDataFrame(
        [(f"s{k}", 1.0 + 10 * (k % 12), 1.0 + 10 * (k // 12), f"class {k % 31}", f"crop {k % 17}", 5.0) for k in range(120)], "sample_id string, lat double, lon double, landcover string, croptype string, quality_ct double"
    ).withColumn("valid_time", F.to_date(F.lit("2020-01-01")))
    for by_region in (True, False):
        rows = [tuple(r) for r in covers.class_cells(samples, by_region).select("region", "cell", "lc", "ct", "placed").collect()]
        got = (covers.greedy_region_coverage if by_region else covers.greedy_class_coverage)(samples).orderBy("place").collect()
        assert [(r.region, r.cell, r.gain) for r in got] == plain(rows)[0] and got
