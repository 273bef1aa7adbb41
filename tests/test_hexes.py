"""Names of hexagonal cells against a plain loop over points, in one evaluation of a plan without lambdas."""

import math

import pytest

from agrispark.operators import hexes


def plain(lon: float, lat: float, finest: int) -> dict[int, str]:
    flat = math.cos(math.radians(lat))
    p = (flat * math.cos(math.radians(lon)), flat * math.sin(math.radians(lon)), math.sin(math.radians(lat)))
    dot = lambda t: t[0] * p[0] + t[1] * p[1] + t[2] * p[2]
    face = max(range(len(hexes.FACES)), key=lambda k: dot(hexes.FACES[k][0]))
    normal, first, second = hexes.FACES[face]
    at = complex(dot(first) / dot(normal), dot(second) / dot(normal)) * hexes.STEP**finest / hexes.SPACING
    q, r = at.real - at.imag / math.sqrt(3), at.imag / math.sqrt(0.75)
    names = {}
    for level in range(finest, -1, -1):
        if level < finest:
            q, r = (3 * q + r) / 7, (2 * r - q) / 7
        whole = [math.floor(v + 0.5) for v in (q, r, -q - r)]
        off = [abs(w - v) for w, v in zip(whole, (q, r, -q - r), strict=True)]
        worst = off.index(max(off))
        q, r = (-whole[1] - whole[2] if worst == 0 else whole[0]), (-whole[0] - whole[2] if worst == 1 else whole[1])
        names[level] = f"{level}:{face}:{q}:{r}"
    return names


def test_names_equal_a_plain_loop(spark):
    points = [(k, -180 + 36.0 * (k * 0.6180339 % 10), math.degrees(math.asin(1 - 2 * (k + 0.5) / 3000))) for k in range(3000)]
    df = spark.createDataFrame([*points, (-1, None, 1.0), (-2, 1.0, None), (-3, math.nan, 1.0)], "id long, lon double, lat double")
    got = {r.id: r for r in hexes.with_hexes(df, {"fine": 5, "mid": 2, "top": 0}).collect()}
    assert all(got[k].fine is None and got[k].top is None for k in (-1, -2)) and got[-3].fine == "5:0:0:0"
    for k, lon, lat in points:
        want = plain(lon, lat, 5)
        assert (got[k].fine, got[k].mid, got[k].top) == (want[5], want[2], want[0])


@pytest.mark.parametrize("name", ["hierarchical_cell"])
def test_plan_has_no_lambdas_and_cells_once(spark, name):
    from agrispark import plans

    plan = plans.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and plan.count("ArrowEvalPython ") == 1


def test_sampling_takes_its_cells_from_the_same_step(spark):
    from agrispark.operators.sampling import in_cells

    df = spark.createDataFrame([(1, 10.0, 50.0)], "sample_id long, lon double, lat double")
    plan = in_cells(df, 0, 2)._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and plan.count("ArrowEvalPython ") == 1
