"""The wide table holds all steps of all bands, whatever the length of a series."""

import datetime

from agrispark.functions.bands import NODATA, RESOLUTION
from agrispark.operators.timeseries import BANDS, WIDE_STEPS, q_pivot


def test_no_step_and_no_band_is_left_out(spark):
    lengths = {"a": 1, "b": 84, "c": 100, "d": 169}
    value = {b: 1000 * k for k, b in enumerate(BANDS, 1)}
    day = [datetime.date(1992 + i // 12, i % 12 + 1, 1) for i in range(200)]
    rows = [(s, day[3 + i], "r", day[5], *(value[b] + i for b in BANDS)) for s, n in lengths.items() for i in range(n) if i % 7 != 3 or i == n - 1]
    obs = spark.createDataFrame(rows, "sample_id string, ts date, ref_id string, valid_time date, " + ", ".join(f"{b} int" for b in BANDS))
    got = q_pivot(obs).collect()
    assert [(r.sample_id, r.first_step) for r in sorted(got)] == [(s, k) for s, n in lengths.items() for k in range(0, n, WIDE_STEPS)]
    seen = set()
    for r in got:
        assert (r.start_date, r.year) == ("1992-04-01", 1992)
        cells = {(b, i): r[f"{b}-ts{i}-{RESOLUTION[b]}m"] for b in BANDS for i in range(WIDE_STEPS)}
        assert len(r) == 4 + len(cells)
        seen |= {(r.sample_id, b, r.first_step + i, v) for (b, i), v in cells.items() if v != NODATA}
    assert seen == {(r[0], b, (r[1].year - 1992) * 12 + r[1].month - 4, r[4 + k]) for r in rows for k, b in enumerate(BANDS)}
