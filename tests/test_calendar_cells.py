"""Calendar lookups are made once for each half-degree cell that holds points, not for each point."""

import math

from agrispark.operators import seasons


def test_many_points_of_a_cell_are_one_lookup(spark, tmp_path):
    cells = [(10.25 + 0.5 * i, 20.25 + 0.5 * j, 100 * i + j, 7 * i + j) for i in range(30) for j in range(10)]
    calendar = spark.createDataFrame(cells, "lat double, lon double, s1_sos int, s1_eos int")
    points = [(k, 9.0 + k % 90 / 10, 16.0 + k % 130 / 10) for k in range(2000)] + [(-1, 60.0, 60.0), (-2, None, 20.0)]
    df = spark.createDataFrame(points, "sample_id int, lat double, lon double")
    found = []
    real = seasons.kept
    seasons.kept = lambda t, name: found.append(real(t, name)) or found[-1]
    try:
        got = {r.sample_id: tuple(r)[1:] for r in seasons.calendar_lookup(df, calendar).collect()}
    finally:
        seasons.kept = real
    want = {}
    for k, lat, lon in points:
        if lat is not None:
            la, lo = math.floor(lat * 2) / 2 + 0.25, math.floor(lon * 2) / 2 + 0.25
            d, *_, sos, eos = min(((c[0] - la) ** 2 + (c[1] - lo) ** 2, *c) for c in cells)
            if d <= 25:
                want[k] = (sos, eos, d > 0)
    assert got == want and any(v[2] for v in want.values())
    held = {(math.floor(p[1] * 2), math.floor(p[2] * 2)) for p in points if p[0] in want}
    assert found[0].count() == len(held) < 600
