"""Every registered query with SQL against DuckDB on the smallest tables, and golden values of single functions."""

import math

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from agrispark import plans
from agrispark.functions import bands, dates
from agrispark.operators import columns, geometry, scoring

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def shown(v) -> str:
    if pd.api.types.is_scalar(v) and pd.isna(v):
        return "-"
    if hasattr(v, "year"):
        return str(v)[:10]
    return f"{float(v):.4f}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def rows(df: pd.DataFrame) -> list:
    return sorted(tuple(shown(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    got, want = plans.QUERIES[name](spark, SF).toPandas(), duck.sql(plans.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLE_SQL)))
def test_query_without_sql_runs(spark, name):
    assert plans.QUERIES[name](spark, SF).count() > 0


def one(spark, *exprs):
    return tuple(spark.range(1).select(*exprs).first())


def test_season_days_golden(spark):
    a, b = dates.doy_season_dates(F.lit(100), F.lit(200), F.lit(2020))
    assert tuple(map(str, one(spark, a, b))) == ("2020-04-10", "2020-07-19")


def test_extent_season_golden(spark):
    a, b = dates.dekad_date(F.lit(32), F.lit(2024), "first"), dates.dekad_date(F.lit(62), F.lit(2024), "last")
    assert tuple(map(str, one(spark, a, b))) == ("2023-11-01", "2024-09-30")


def test_season_crosses_year(spark):
    d = F.to_date(F.lit("2021-12-05"))
    a, b = dates.resolve_season_bounds(d, (11, 1), (4, 30), 1)
    assert tuple(map(str, one(spark, a, b))) == ("2021-11-01", "2022-04-30")


def test_dekads_of_a_month(spark):
    s = dates.enumerate_slots(F.to_date(F.lit("2021-02-05")), F.to_date(F.lit("2021-02-28")), "dekad")
    assert [str(x) for x in one(spark, s)[0]] == ["2021-02-01", "2021-02-11", "2021-02-21"]


def test_step_ordinals_round_trip(spark):
    d = F.to_date(F.lit("2021-02-11"))
    assert str(one(spark, dates.step_date(dates.step_ordinal(d, "dekad"), "dekad"))[0]) == "2021-02-11"


def test_scaling_keeps_nodata(spark):
    got = one(spark, bands.scaled(F.lit(65535), "sar"), bands.scaled(F.lit(5000), "optical"))
    assert got == (65535.0, 0.5)


def test_missing_columns_are_named(spark):
    with pytest.raises(columns.MissingColumns, match="b02"):
        columns.require_columns(spark.range(1), ["id", "b02"])


def test_utm_of_a_known_point(spark):
    epsg, e, n = one(spark, *geometry.to_utm(F.lit(3.0), F.lit(0.0)))
    assert epsg == 32631 and math.isclose(e, 500000, abs_tol=1e-3) and abs(n) < 1e-3


def test_growth_fit_recovers_a_curve():
    import numpy as np

    x = np.linspace(0, 100, 60)
    a, b, c, r2, _ = scoring.fit_growth(x, 0.6 * np.exp(-0.5 * ((x - 40) / 15) ** 2) + 0.11)
    assert np.allclose([a, b, c], [0.6, 40, 15], rtol=1e-2) and r2 > 0.999


def test_composites_of_a_stream(spark, tmp_path):
    from agrispark.streaming import stream_composites

    spark.sql("SELECT 's' AS sample_id, TIMESTAMP '2021-01-05 00:00:00' + make_dt_interval(CAST(id AS INT)) AS ts, CAST(id AS DOUBLE) AS value FROM range(3)").write.parquet(str(tmp_path / "in"))
    stream = stream_composites(spark.readStream.schema("sample_id string, ts timestamp, value double").parquet(str(tmp_path / "in")))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("composites").start()
    q.processAllAvailable()
    q.stop()
    assert [(r.sample_id, str(r.month)[:10], r.value, r.n) for r in spark.table("composites").collect()] == [("s", "2021-01-01", 1.0, 3)]
