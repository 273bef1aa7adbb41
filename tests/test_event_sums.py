"""Means of floats by group are those of the events in their order, whatever files and tasks hold them."""

import datetime
import math
import random

from agrispark.fixtures import ADAPTERS, adapted
from agrispark.sources.files import q_append


def in_order(values: list[float]) -> int:
    total = 0.0
    for v in values:
        total += v
    return math.floor(total / len(values))


def test_dekad_means_sum_in_order_of_events(spark, tmp_path):
    chance = random.Random(5)
    values: list[float] = []
    # a mean of exactly 50 in cents that falls below 50 in the order of the events, but not backwards
    while not values or not in_order(values) == 49 < in_order(values[::-1]):
        cents = [chance.randrange(100, 10_000) for _ in range(17)]
        cents.append(18 * 5000 - sum(cents))
        values = [c / 100 for c in cents]
    day = datetime.datetime(2024, 1, 12)
    events = [(k, day + datetime.timedelta(minutes=k), 63, v) for k, v in enumerate(values)]
    events += [(100, day, 64, None), (101, datetime.datetime(2024, 1, 31), 64, 7.5)]
    schema = "event_id long, ts timestamp, user_id long, value double"
    spark.createDataFrame(events[::-1], schema).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    got = adapted(spark, str(tmp_path), "obs_dekad")
    want = {("U63", datetime.date(2024, 1, 11), 49), ("U64", datetime.date(2024, 1, 11), None), ("U64", datetime.date(2024, 1, 21), 7)}
    assert {tuple(r) for r in got.collect()} == want
    assert got.schema == spark.sql(ADAPTERS["obs_dekad"].replace("FROM events", "FROM {e}"), e=spark.read.parquet(str(tmp_path / "events.parquet"))).schema
    obs = spark.createDataFrame([], "sample_id string, ts date, b02 int, b04 int")
    assert {(r.sample_id, r.ts, r.b02) for r in q_append(obs, got).collect()} == want
