"""Composites of a stream of observations; every other operator works on batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_composites(observations: DataFrame, late: str = "40 days") -> DataFrame:
    """Mean and number of each sample's values by month of the event time ``ts`` (a timestamp), for a streaming DataFrame.

    The month is the event time of the watermark: in append mode a month comes out once the latest month seen began more
    than ``late`` after it, and its state is dropped then, so state is bounded by the lateness allowed. Rows that come
    later still are left out; rows without a time count nowhere.
    """
    monthly = observations.where("ts is not null").withColumn("month", F.date_trunc("month", "ts")).withWatermark("month", late)
    return monthly.groupBy("sample_id", "month").agg(F.avg("value").alias("value"), F.count("*").alias("n"))
