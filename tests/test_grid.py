"""Tiles of odd areas, and merges against a loop over all pairs of tiles."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from agrispark.operators import grid as G

OUTLINE = "id string, ring int, k int, lon double, lat double, season string"


def areas(spark, shapes):
    rows = [(i, r, k, *p, f"s-{i}") for i, rings in shapes.items() for r, ring in enumerate(rings) for k, p in enumerate(ring + ring[:1])]
    return G.rings_of(spark.createDataFrame(rows, OUTLINE), "id", "season")


def box(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]


def test_tiles_carry_columns_cross_zones_and_leave_holes_out(spark):
    shapes = {"a": [box(5.7, -0.2, 0.6, 0.4), box(5.8, -0.1, 0.1, 0.05)[::-1]], "b": [box(20.0, 45.0, 0.3, 0.2), box(20.1, 45.05, 0.1, 0.1)]}
    got = G.production_grid(areas(spark, shapes), 10.0).collect()
    assert {r.season for r in got} == {"s-a", "s-b"} and len({r.tile_name for r in got}) == len(got)
    assert {r.epsg for r in got if r.id == "a"} == {32631, 32632, 32731, 32732}
    assert all(r.tile_name.startswith(f"{r.id}_{r.tile}_") for r in got)
    for r in got:
        xs, ys = ([p[c] for ring in r.rings for p in ring] for c in "xy")
        assert max(xs) - min(xs) <= 10_000 + 1e-6 and max(ys) - min(ys) <= 10_000 + 1e-6
    metres = lambda w, h, lat: w * 111_319.49 * math.cos(math.radians(lat)) * h * 110_574
    for i, whole in (("a", metres(0.6, 0.4, 0) - metres(0.1, 0.05, 0)), ("b", metres(0.3, 0.2, 45.1) - metres(0.1, 0.1, 45.1))):
        assert math.isclose(sum(r.area for r in got if r.id == i), whole, rel_tol=0.02)


def test_area_of_tiles_is_that_of_the_star(spark):
    rng = random.Random(3)
    star = [(0.8 + r * math.cos(a), 51 + r * math.sin(a)) for a, r in ((2 * math.pi * k / 18, rng.uniform(0.1, 0.5)) for k in range(18))]
    df = areas(spark, {"star": [star]})
    tiles = G.production_grid(df, 7.0)
    own = G.strips(df, "x", 6.0, F.lit(-180.0), "z")
    whole = own.select(G.area(F.transform("rings", lambda r: F.transform(r, lambda p: _flat(p)))).alias("m")).agg(F.sum("m")).first()[0]
    assert math.isclose(tiles.agg(F.sum("area")).first()[0], whole, rel_tol=1e-9)
    assert tiles.count() > 40


def _flat(p):
    _, e, n = G.to_utm(p["x"], p["y"], F.lit(31), F.lit(False))
    return F.struct(e.alias("x"), n.alias("y"))


def test_ids_are_checked(spark):
    good = areas(spark, {"a": [box(1.0, 1.0, 0.1, 0.1)], "b": [box(2.0, 1.0, 0.1, 0.1)]})
    for bad in (good.withColumn("id", F.lit("x")), good.withColumn("id", F.when(F.col("id") == "a", "a")), good.withColumn("rings", F.array().cast(f"array<{G.RING}>"))):
        with pytest.raises(ValueError, match="ids"):
            G.production_grid(bad, 10.0)


def edges(rings):
    return [(a, b) for r in rings for a, b in zip(r, r[1:]) if a != b]


def overlap(e, f):
    (ax, ay), (bx, by) = e
    n = math.hypot(bx - ax, by - ay)
    u = ((bx - ax) / n, (by - ay) / n)
    if any(abs((px - ax) * u[1] - (py - ay) * u[0]) > 0.004 for px, py in f):
        return 0.0
    t = sorted((px - ax) * u[0] + (py - ay) * u[1] for px, py in f)
    return max(0.0, min(t[1], n) - max(t[0], 0.0))


def distance(p, e):
    (ax, ay), (bx, by) = e
    t = min(1.0, max(0.0, ((p[0] - ax) * (bx - ax) + (p[1] - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
    return math.hypot(p[0] - ax - t * (bx - ax), p[1] - ay - t * (by - ay))


def by_pairs(tiles, least, gap):
    """{name: merged into} by comparing every pair."""
    out = {}
    for name, (epsg, rings) in tiles.items():
        xs, ys = [p[0] for r in rings for p in r], [p[1] for r in rings for p in r]
        if max(xs) - min(xs) >= least and max(ys) - min(ys) >= least:
            continue
        others = {o: r for o, (z, r) in tiles.items() if z == epsg and o != name}
        shared = {o: round(sum(overlap(e, f) for e in edges(rings) for f in edges(r)), 2) for o, r in others.items()}
        best = min(((-v, o) for o, v in shared.items() if v > 0), default=None)
        if best is None:
            far = {o: round(min([distance(p, f) for e in edges(rings) for p in e for f in edges(r)] + [distance(p, e) for f in edges(r) for p in f for e in edges(rings)]), 2) for o, r in others.items()}
            best = min(((v, o) for o, v in far.items() if v <= gap), default=None)
        if best:
            out[name] = best[1]
    return out


def grouped(tiles, links):
    root = {}
    near = defaultdict(set)
    for a, b in links.items():
        near[a].add(b)
        near[b].add(a)
    for name in tiles:
        seen, todo = {name}, [name]
        while todo:
            for o in near[todo.pop()] - seen:
                seen.add(o)
                todo.append(o)
        root[name] = min(seen, key=lambda s: (s in links, s))
    return root


def as_rows(spark, tiles):
    rows = [(n, z, [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings], 1.0, f"c-{n}") for n, (z, rings) in tiles.items()]
    return spark.createDataFrame(rows, f"tile_name string, epsg int, rings array<{G.RING}>, area double, note string")


def checked(spark, tiles, least, gap):
    links = by_pairs(tiles, least, gap)
    df = as_rows(spark, tiles)
    assert {r.tile_name: r.into for r in G.merge_targets(df, least, gap).collect()} == links
    root = grouped(tiles, links)
    want = defaultdict(list)
    for name, r in root.items():
        want[r].append(name)
    got = {r.tile_name: r for r in G.merged(df, least, gap).collect()}
    assert {n: r.n_merged for n, r in got.items()} == {n: len(own) for n, own in want.items()}
    assert all(r.note == f"c-{n}" and r.area == len(want[n]) and len(r.rings) == sum(len(tiles[o][1]) for o in want[n]) for n, r in got.items())
    return links


def test_merges_are_those_of_all_pairs(spark):
    tiles, close = {}, lambda x, y, w, h: [[(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]]
    rng = random.Random(9)
    widths, x = [900.0, 60.0, 800.0, 40.0, 30.0, 700.0, 50.0], 0.0
    for i, w in enumerate(widths):
        y = 0.0
        for j, h in enumerate((rng.choice([500.0, 90.0]), 700.0, 30.0)):
            tiles[f"t{i}{j}"] = (32631, close(199_000.0 + x, y, w, h))
            y += h
        x += w
    tiles |= {"far": (32631, close(199_000.0 + x + 15.0, 0.0, 20.0, 300.0)), "alone": (32631, close(400_000.0, 0.0, 20.0, 20.0)), "zone": (32632, close(199_000.0, 0.0, 30.0, 900.0))}
    links = checked(spark, tiles, 100.0, 20.0)
    assert links["far"].startswith("t6") and "alone" not in links and "zone" not in links and len(links) > 8


def test_nothing_to_merge(spark):
    tiles = {"a": (32631, [[(0, 0), (500, 0), (500, 500), (0, 500), (0, 0)]])}
    assert checked(spark, tiles, 100.0, 20.0) == {}
    assert G.merged(as_rows(spark, tiles).where("false")).count() == 0


def test_merges_of_a_slanted_grid(spark):
    shapes = {"p": [[(3.0, 50.0), (3.35, 50.05), (3.3, 50.3), (3.02, 50.22)]]}
    rows = G.production_grid(areas(spark, shapes), 5.0).collect()
    tiles = {r.tile_name: (r.epsg, [[(p.x, p.y) for p in ring] for ring in r.rings]) for r in rows}
    assert len(checked(spark, tiles, 1500.0, 20.0)) > 2
