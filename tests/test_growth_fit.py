"""Growth curves of many series at once against a loop over series and rounds."""

import datetime

import numpy as np

from agrispark.operators import scoring


def plain(x, y, base=0.11):
    p, damp = np.array([max(y.max() - base, 1e-3), x[y.argmax()], max(np.ptp(x) / 4, 1e-3)]), 1e-2
    error = lambda q: y - (q[0] * np.exp(-0.5 * ((x - q[1]) / q[2]) ** 2) + base)
    r = error(p)
    for _ in range(60):
        u = (x - p[1]) / p[2]
        g = np.exp(-0.5 * u * u)
        j = np.column_stack([g, p[0] * g * u / p[2], p[0] * g * u * u / p[2]])
        h = j.T @ j
        q = p + np.linalg.solve(h + damp * np.diag(np.diag(h) + 1e-9), j.T @ r)
        q[2] = max(abs(q[2]), 1e-3)
        s = error(q)
        p, r, damp = (q, s, damp * 0.5) if s @ s < r @ r else (p, r, damp * 4)
    spread = ((y - y.mean()) ** 2).sum()
    return [*p, 1 - (r @ r) / spread if spread else 0.0, np.sqrt(np.mean(r * r))]


def test_series_are_fitted_together(spark):
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for k in range(60):
        n = 18 + k % 7
        days = np.sort(rng.choice(2000, n, replace=False))
        b04 = rng.integers(0, 4000, n) if k % 5 else np.full(n, 1000)
        rows += [(f"s{k}", datetime.date(1995, 1, 1) + datetime.timedelta(int(d)), int(v)) for d, v in zip(days, b04, strict=True)]
        if n >= 20:
            want[f"s{k}"] = [n, *plain(days.astype(float), b04 / 4000)]
    obs = spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "sample_id string, ts date, b04 int")
    df = scoring.gaussian_growth_fit(obs)
    got = {r[0]: list(r)[1:] for r in df.collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        np.testing.assert_allclose(got[k], v, rtol=1e-7, atol=1e-9)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan
