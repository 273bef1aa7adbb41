"""Sampling against the same order taken one sample after the other, run_sampling's errors and caps, and the shares of draws."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from agrispark.operators import sampling as S

SCHEMA = "sample_id string, lat double, lon double, class string, cap int, coarse string, fine string"


def chance(key, seed=42):
    return int(hashlib.md5(f"{seed}|{key}".encode()).hexdigest()[:8], 16) / 2**32


def metres(lat, lon):
    return math.radians(lon) * 6378137.0, math.log(math.tan(math.radians(lat) / 2 + math.pi / 4)) * 6378137.0


def one_by_one(rows, distance):
    """Drawn ids in order, by the order of rarity, turn and cell."""
    rows = [r for r in rows if None not in (r[1], r[2], r[3], r[5], r[6])]
    count = Counter((r[5], r[3]) for r in rows)
    turn, at = defaultdict(int), {}
    for r in sorted(rows, key=lambda r: (chance(r[0]), r[0])):
        turn[r[5], r[3], r[6]] += 1
        at[r[0]] = turn[r[5], r[3], r[6]]
    drawn, have = defaultdict(list), Counter()
    for r in sorted(rows, key=lambda r: (count[r[5], r[3]], r[3], at[r[0]], r[6], chance(r[0]), r[0])):
        x, y = metres(r[1], r[2])
        if have[r[5], r[3]] < r[4] and all((x - a) ** 2 + (y - b) ** 2 > distance**2 for _, a, b in drawn[r[5]]):
            drawn[r[5]].append((r[0], x, y))
            have[r[5], r[3]] += 1
    return {i for own in drawn.values() for i, _, _ in own}


def rows(rng, n, where, spread):
    lat, lon = where
    out = []
    for k in range(n):
        a, b = lat + rng.uniform(0, spread), lon + rng.uniform(0, spread)
        kind = rng.choice(["a", "a", "a", "b", "b", "c"])
        out.append((f"s{k}", a, b, kind, 4 if kind == "a" else 3, f"c{int((b - lon) // (spread / 2))}", f"f{int((a - lat) // (spread / 4))}{int((b - lon) // (spread / 8))}"))
    return out


@pytest.mark.parametrize("where", [(0.0, 10.0), (68.0, 20.0)])
def test_draws_are_those_of_one_by_one(spark, where):
    rng = random.Random(int(where[0]))
    own = rows(rng, 250, where, 0.2)
    odd = [("n1", None, 1.0, "a", 3, "c0", "f0"), ("n2", 1.0, 1.0, None, 3, "c0", "f0"), ("n3", 1.0, 1.0, "a", 3, None, "f0")]
    df = spark.createDataFrame([(*r, 1) for r in own + odd], SCHEMA + ", x int")
    got = {r.sample_id: r for r in S.apart(df, 1500.0).collect()}
    assert set(got) == one_by_one(own, 1500.0)
    points = [(r.coarse, *metres(r.lat, r.lon)) for r in got.values()]
    assert all(math.dist(a[1:], b[1:]) > 1500 for k, a in enumerate(points) for b in points[:k] if a[0] == b[0])


def steps_of(monkeypatch):
    """Names of the tables that are written from here on."""
    written, kept = [], S.kept
    monkeypatch.setattr(S, "kept", lambda df, name: written.append(name) or kept(df, name))
    return written


def test_classes_in_each_others_way_are_drawn_in_one_step(spark, monkeypatch):
    """Classes of a coarse cell that lie among one another don't take a pass over all samples each."""
    rng = random.Random(4)
    own = [(f"s{k}", 1.0 + rng.uniform(0, 0.2), 1.0 + rng.uniform(0, 0.2), f"c{k % 8}", 3, f"c{k % 3}", f"f{k % 7}") for k in range(480)]
    written = steps_of(monkeypatch)
    assert {r.sample_id for r in S.apart(spark.createDataFrame(own, SCHEMA), 1500.0).collect()} == one_by_one(own, 1500.0)
    assert written.count("step") == 2 and written.count("left") == 2


@pytest.mark.parametrize("seen", [1, 6, 40])
def test_classes_beyond_the_rows_seen_hold_up_those_after_them(spark, monkeypatch, seen):
    """Crowds in one place, of which the rows seen give fewer than the class may have."""
    monkeypatch.setattr(S, "SEEN", seen)
    rng = random.Random(seen)
    crowd = [(f"d{k}", 1.0 + rng.uniform(0, 0.001), 1.0 + rng.uniform(0, 0.001), "a", 2, "c0", "f0") for k in range(60)]
    own = crowd + rows(rng, 240, (1.0, 1.0), 0.1) + [("far", 1.3, 1.3, "a", 2, "c0", "f9")]
    own = [(*r[:3], r[3], 2, *r[5:]) for r in own]
    written = steps_of(monkeypatch)
    got = [r.sample_id for r in S.apart(spark.createDataFrame(own, SCHEMA), 1500.0).collect()]
    assert len(got) == len(set(got)) and set(got) == one_by_one(own, 1500.0)
    assert seen == 40 or written.count("step") > 2


def test_a_sample_without_a_number_as_place_is_drawn_once(spark):
    odd = [("n", 5.0, math.nan, "a", 3, "c", "f"), ("s", 5.0, 5.0, "a", 3, "c", "f")]
    assert sorted(r.sample_id for r in S.apart(spark.createDataFrame(odd, SCHEMA), 10.0).collect()) == ["n", "s"]


def test_a_given_level_takes_no_pass_for_the_largest_cap(spark, monkeypatch, labelled):
    monkeypatch.setattr(S, "apart", lambda samples, metres, most=None: samples)
    samples = labelled[0].withColumn("sampling_label", F.lit("a"))
    spark.sparkContext.setJobGroup("level", "level")
    S.distance_class_samples(samples, F.lit(3), 1500.0, coarse=0, fine=2)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("level")
    spark.sparkContext.setJobGroup("", "")


def test_rare_classes_first_and_fine_cells_in_turn(spark):
    crowd = [(f"s{k}", 1.0 + k * 1e-4, 1.0, "many", 4, "c", f"f{k % 8}") for k in range(80)]
    rare = [("r", 1.004, 1.0, "rare", 4, "c", "f9")]
    got = S.apart(spark.createDataFrame(crowd + rare, SCHEMA), 5.0).collect()
    assert "r" in {r.sample_id for r in got}
    many = [r.fine for r in got if r["class"] == "many"]
    assert len(many) == 4 and len(set(many)) == 4


def test_equal_places_and_no_rows(spark):
    same = [(f"s{k}", 5.0, 5.0, "a", 9, "c", "f") for k in range(30)]
    assert S.apart(spark.createDataFrame(same, SCHEMA), 10.0).count() == 1
    assert S.apart(spark.createDataFrame([], SCHEMA), 10.0).count() == 0


def test_ranks_are_exact(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), (F.col("id") % 3).cast("string")).alias("g"), "id").withColumn("c", S.chance("id"))
    got = defaultdict(list)
    for r in S.ranked(df, ["g"], ["c", "id"], "n").collect():
        got[r.g].append((r.c, r.id, r.n))
    for own in got.values():
        assert [n for _, _, n in sorted(own)] == list(range(1, len(own) + 1))


@pytest.fixture
def labelled(spark):
    samples = [(f"p{k}", 40.0 + (k % 20) * 0.05, 5.0 + (k // 20) * 0.05, k % 4, 5.0, 5.0 if k % 9 else 0.0, 7) for k in range(400)]
    samples = spark.createDataFrame(samples, "sample_id string, lat double, lon double, ewoc_code int, quality_lc double, quality_ct double, extract int")
    legend = spark.createDataFrame([(0, "grasslands"), (1, "maize"), (2, "wheat"), (3, "unknown")], "ewoc_code int, sampling_label string")
    return samples, legend


def test_run_sampling_caps_by_kind_of_class(spark, labelled):
    got = S.run_sampling(*labelled, most_lc=5, most_ct=2, metres=3000.0).collect()
    assert len(got) == 400 and {r.extract for r in got} == {0, 1}
    drawn = [r for r in got if r.extract]
    cells = {r.sample_id: r.coarse for r in S.in_cells(labelled[0], 3, 5).collect()}
    counts = Counter((cells[r.sample_id], r.sampling_label) for r in drawn)
    assert all(n <= (5 if c == "grasslands" else 2) for (_, c), n in counts.items()) and max(counts.values()) == 5
    assert not any(r.sampling_label == "unknown" or r.quality_ct == 0 for r in drawn)


def test_run_sampling_errors(spark, labelled):
    samples, legend = labelled
    with pytest.raises(ValueError, match="without a sampling label.*2"):
        S.run_sampling(samples, legend.where("ewoc_code <> 2"))
    with pytest.raises(ValueError, match="no sample"):
        S.run_sampling(samples.withColumn("quality_lc", F.lit(0.0)), legend)


def counted(spark, pool, n, seed=1):
    got = S.draws(pool, n, seed).collect()
    assert sorted(r.position for r in got) == list(range(n if got else 0))
    return Counter(r.id for r in got), {r.position: r.id for r in got}


def test_draws_follow_weights_seeds_and_reruns(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARD", 20)
    pool = spark.createDataFrame([(k, float(k % 5)) for k in range(100)] + [(200, None), (201, -1.0), (202, 100.0)], "id long, weight double")
    total = sum(k % 5 for k in range(100)) + 100.0
    counts, at = counted(spark, pool, 20_000)
    assert not {200, 201, *range(0, 100, 5)} & set(counts)
    chi = sum((counts[i] - 20_000 * w / total) ** 2 / (20_000 * w / total) for i, w in [(k, k % 5) for k in range(100) if k % 5] + [(202, 100.0)])
    assert chi < 80 + 5 * math.sqrt(2 * 80)
    assert counted(spark, pool.repartition(5), 20_000)[1] == at
    assert counted(spark, pool, 20_000, seed=2)[1] != at
    halves = Counter(i for p, i in at.items() if p < 10_000)
    assert abs(halves[202] - counts[202] / 2) < 5 * math.sqrt(counts[202] / 4)


def test_no_draws_without_weight(spark):
    pool = spark.createDataFrame([(1, 0.0), (2, None)], "id long, weight double")
    assert S.draws(pool, 10).count() == 0 and S.draws(pool.where("false"), 10).count() == 0 and S.draws(pool, 0).count() == 0


def test_task_counts():
    assert S.task_counts(5, {"landcover": 0.5, "croptype": 0.5}) == {"landcover": 2, "croptype": 3}
    assert S.task_counts(10, {"landcover": 3, "croptype": 1}) == {"landcover": 8, "croptype": 2}
    assert S.task_counts(4, {"landcover": 1}) == {"landcover": 4}
    with pytest.raises(ValueError):
        S.task_counts(4, {"landcover": 0.0})
    with pytest.raises(ValueError):
        S.task_counts(0, {"landcover": 1.0})


def test_batches_mix_tasks(spark):
    pools = {t: spark.createDataFrame([(f"{t}{k}", 1.0 + k) for k in range(7)], "id string, weight double") for t in ("landcover", "croptype")}
    got = S.mixed_batches(pools, {"landcover": 0.25, "croptype": 0.75}, 8, 50).collect()
    by = defaultdict(list)
    for r in got:
        by[r.batch].append(r)
        assert r.id.startswith(r.task)
    assert set(by) == set(range(50))
    for own in by.values():
        assert Counter(r.task for r in own) == {"landcover": 2, "croptype": 6} and sorted(r.slot for r in own) == list(range(8))
    assert len({tuple(r.task for r in sorted(own, key=lambda r: r.slot)) for own in by.values()}) > 5
