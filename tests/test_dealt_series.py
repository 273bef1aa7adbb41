"""Series are dealt over a number of tasks in proportion to the table, and Spark doesn't join them again."""

import pytest

from agrispark import plans, storage

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["pivot_long_to_wide", "sensor_masking"])
def test_sorts_of_series_are_bounded(spark, monkeypatch, name):
    monkeypatch.setattr(storage, "BYTES_A_TASK", 2 << 10)
    df = plans.QUERIES[name](spark, SF)
    rows = df.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    # the table is estimated at 37 times those bytes
    assert len(rows) > 30 and max(rows) < sum(rows) / 6
