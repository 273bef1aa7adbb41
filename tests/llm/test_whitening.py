"""Eigenpairs against a dense solver, and the query's columns against plain numpy in exact integers."""

import math

import numpy as np
import pytest

from agrispark.llm import whitening as W


def spectrum(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    v = q * np.array(values) @ q.T
    return (v + v.T) / 2


CASES = {
    "spread": np.linspace(1, 60, 64), "clustered": [5.0] * 10 + [5 + 1e-9] * 10 + [1.0] * 30, "steep": 10.0 ** -np.arange(0, 14, 0.5),
    "dominant": [930.0] + list(np.linspace(60.0, 70.0, 63)), "dense": np.concatenate([np.linspace(10, 11, 150), [1000.0, 1e5]]), "rank": [3.0, 2.0] + [0.0] * 20, "one": [7.0], "two": [2.0, 1.0], "equal": [1.0] * 40,
}


@pytest.mark.parametrize("name", CASES)
def test_components(name):
    v = spectrum(CASES[name])
    e, u = W.components(v)
    want = np.sort(np.linalg.eigvalsh(v))[::-1][:32]
    want = want[want > W.TINY * want[0]]
    if name in ("rank", "steep"):  # the smallest may fall to either side of the least
        k = min(len(e), len(want))
        e, u, want = e[:k], u[:, :k], want[:k]
        assert k >= 2
    assert np.abs(e - want).max() <= 1e-12 * want[0]
    assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-12
    assert np.abs(v @ u - u * e).max() < 1e-12 * want[0]


def test_many_spectra_of_noise():
    for seed in range(40):
        x = np.random.default_rng(seed).standard_normal((200 + 50 * seed, 64)) * (1 + 0.1 * (seed % 5))
        v = np.cov(x.T, bias=True) * 64
        e, u = W.components(v)
        assert np.abs(e - np.sort(np.linalg.eigvalsh(v))[::-1][:32]).max() < 1e-11 * e[0]
        assert np.abs(v @ u - u * e).max() < 1e-11 * e[0]


def test_inertia_counts():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 30):
        for _ in range(20):
            a = rng.standard_normal((n, n))
            a = a + a.T if rng.random() < 0.7 else (a + a.T) - np.diag(np.diagonal(a + a.T))
            for shift in (0.0, *rng.standard_normal(3)):
                assert W.below(a, shift) == (np.linalg.eigvalsh(a) < shift).sum()


def test_contour_keeps_only_what_is_inside():
    v = spectrum(np.arange(1.0, 41.0))
    q = W.inside(v, 10.5, 20.5, 10, 16)
    assert np.allclose(np.sort(np.linalg.eigvalsh(q.T @ v @ q)), np.arange(11.0, 21.0), atol=1e-10)


def test_a_wrong_count_is_an_error():
    with pytest.raises(ArithmeticError):
        W.inside(spectrum(np.arange(1.0, 21.0)), 2.5, 5.5, 4, 6)


def expected(rows):
    """{(id, component): ...} by exact sums and a dense solver."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in kept]
    n, dims = len(x), len(x[0])
    s = [sum(r[k] for r in x) for k in range(dims)]
    far = [sum((n * r[k] - s[k]) ** 2 for k in range(dims)) for r in x]
    y = np.array([[(n * r[k] - s[k]) / n for k in range(dims)] for r in x])
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:32], u[:, ::-1][:, :32]
    w = y @ u / np.sqrt(e)
    return kept, far, w, e / np.trace(v)


def compared(got, rows):
    kept, far, w, share = expected(rows)
    assert len(got) == len(kept) * w.shape[1]
    by = {(r["vec_id"], r["component"]): r for r in got}
    signs = {}
    for j in range(w.shape[1]):
        own = np.array([by[i, j + 1]["whitened"] for i, _ in kept])
        signs[j] = np.sign(own @ w[:, j])
        assert np.abs(own - signs[j] * w[:, j]).max() < 1e-6
        assert math.isclose(by[kept[0][0], j + 1]["explained"], share[j], rel_tol=1e-9)
    for (i, _), f in zip(kept, far, strict=True):
        assert by[i, 1]["deviation"] == f and by[i, 1]["n"] == len(kept)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()]
    compared(W.op11_embedding_whitening(spark, "/root/testdata/sf0.01").collect(), rows)


def query(spark, monkeypatch, rows, kind="long"):
    df = spark.createDataFrame([(i, v, 3, "x") for i, v in rows], f"vec_id {kind}, embedding array<float>, w int, id string").repartition(3)
    monkeypatch.setattr(W, "table", lambda *_: df)
    return W.op11_embedding_whitening(spark, "").collect()


def test_dropped_rows_and_few_dimensions(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(k, [float(c) for c in rng.standard_normal(5).astype(np.float32)]) for k in range(60)]
    bad = [(100, None), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [float("nan")] * 5), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (104, [1.0, 2.0]), (105, [])]
    got = query(spark, monkeypatch, rows + bad)
    compared(got, rows)
    assert {r["component"] for r in got} == {1, 2, 3, 4, 5}


def test_repeats_huge_entries_and_string_ids(spark, monkeypatch):
    rows = [("a", [1.0, 2.0, 3.0]), ("a", [1.0, 2.0, 3.0]), (None, [0.5, -2.0, 1e30]), ("b", [9.0, 0.0, -4.0])]
    got = query(spark, monkeypatch, rows, "string")
    assert len(got) % 4 == 0 and len(got) >= 4 and {r["vec_id"] for r in got} == {"a", "b", None}


def test_equal_vectors_and_empty_table_give_no_rows(spark, monkeypatch):
    assert query(spark, monkeypatch, [(1, [1.0, 2.0])] * 5) == []
    assert query(spark, monkeypatch, []) == []
    assert query(spark, monkeypatch, [(1, None)]) == []
