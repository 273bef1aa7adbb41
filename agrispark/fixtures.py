"""Adapters that read the driver's tables as crop-observation tables.

Each adapter is one SELECT that Spark and DuckDB both understand, so queries and their SQL share it: Spark gets the
tables as DataFrames, DuckDB as views.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Outlines of polygons by vertex, at a scale: a region of seven corners (0), a hole in it (1) and an island to the east (2).
_OUTLINES = """
        SELECT n_name AS iso3, r_name AS region, ring, k, -180e0 + (n_nationkey % 5) * 72e0 + (dx - CASE WHEN k = 1 AND ring = 0 THEN (n_nationkey % 3) * 5e0 ELSE 0e0 END) * {0} AS lon,
               -60e0 + floor(n_nationkey / 5e0) * 24e0 + (dy + CASE WHEN k = 4 AND ring = 0 THEN (n_nationkey % 4) * 1e0 ELSE 0e0 END) * {0} AS lat
        FROM nation JOIN region ON n_regionkey = r_regionkey CROSS JOIN (VALUES
          (0, 0, 0e0, 0e0), (0, 1, 60e0, 0e0), (0, 2, 60e0, 12e0), (0, 3, 40e0, 20e0), (0, 4, 30e0, 9e0), (0, 5, 12e0, 20e0), (0, 6, 0e0, 15e0), (0, 7, 0e0, 0e0),
          (1, 0, 20e0, 3e0), (1, 1, 28e0, 3e0), (1, 2, 26e0, 7e0), (1, 3, 20e0, 6e0), (1, 4, 20e0, 3e0),
          (2, 0, 62e0, 2e0), (2, 1, 68e0, 2e0), (2, 2, 66e0, 8e0), (2, 3, 62e0, 2e0)) AS v(ring, k, dx, dy)"""

ADAPTERS = {
    "outlines": _OUTLINES.format("1e0"),
    "estates": _OUTLINES.format("0.05e0"),
    # long observations: about 700 series by month, with gaps inside
    "obs": """
        SELECT concat(CAST(l_suppkey AS STRING), '_', CAST(l_linenumber AS STRING)) AS sample_id,
               CAST(date_trunc('MONTH', l_shipdate) AS DATE) AS ts,
               concat(CAST(2017 + l_suppkey % 8 AS STRING), '_ABC_X_POINT_', CASE WHEN l_suppkey % 4 = 0 THEN '100' ELSE '110' END) AS ref_id,
               DATE '1998-01-01' + CAST(min(l_suppkey * 37 % 900) AS INTEGER) AS valid_time,
               CAST(floor(median(l_quantity)) AS INTEGER) AS b02,
               CAST(floor(median(l_extendedprice % 4000)) AS INTEGER) AS b04,
               CAST(floor(median(l_extendedprice % 7000)) AS INTEGER) AS b08,
               CAST(floor(median(l_discount * 100)) AS INTEGER) AS vv,
               CAST(floor(median(l_tax * 100)) AS INTEGER) AS vh
        FROM lineitem GROUP BY l_suppkey, l_linenumber, date_trunc('MONTH', l_shipdate)""",
    # one row an observation day, several a month
    "obs_raw": """
        SELECT concat('S', CAST(l_suppkey AS STRING)) AS sample_id, CAST(l_shipdate AS DATE) AS ts, l_orderkey AS seq, l_linenumber AS line,
               CAST(floor(l_quantity) AS INTEGER) AS b02, CAST(floor(l_extendedprice % 4000) AS INTEGER) AS b04,
               CAST(floor(l_extendedprice % 7000) AS INTEGER) AS b08, CAST(floor(l_discount * 100) AS INTEGER) AS vv,
               CAST(floor(l_tax * 100) AS INTEGER) AS vh
        FROM lineitem""",
    # ten-day series by user
    "obs_dekad": """
        SELECT concat('U', CAST(user_id AS STRING)) AS sample_id,
               CAST(CASE WHEN day(ts) <= 10 THEN date_trunc('MONTH', ts) WHEN day(ts) <= 20 THEN date_trunc('MONTH', ts) + INTERVAL 10 DAY
                    ELSE date_trunc('MONTH', ts) + INTERVAL 20 DAY END AS DATE) AS ts,
               CAST(floor(avg(value)) AS INTEGER) AS b02
        FROM events GROUP BY 1, 2""",
    "samples": """
        SELECT concat('P', CAST(p_partkey AS STRING)) AS sample_id, -60e0 + (p_partkey * 37 % 12000) / 100e0 AS lat,
               -180e0 + (p_partkey * 91 % 36000) / 100e0 AS lon,
               1100000000 + CAST(p_size AS BIGINT) * 500000 + CAST(substr(p_brand, 7, 1) AS BIGINT) * 1000 AS ewoc_code,
               p_type AS croptype, p_brand AS landcover, CAST(p_size * 2 AS DOUBLE) AS quality_lc, CAST(p_size % 7 AS DOUBLE) AS quality_ct,
               CAST(p_partkey % 3 AS INTEGER) AS extract,
               concat(CAST(2017 + p_partkey % 8 AS STRING), '_ABC_X_POINT_', CASE WHEN p_partkey % 4 = 0 THEN '100' ELSE '110' END) AS ref_id,
               DATE '2020-01-01' + CAST(p_partkey * 13 % 700 AS INTEGER) AS valid_time, p_retailprice AS weight
        FROM part""",
    "legend": """
        SELECT DISTINCT 1100000000 + CAST(p_size AS BIGINT) * 500000 + CAST(substr(p_brand, 7, 1) AS BIGINT) * 1000 AS ewoc_code,
               concat('crop ', CAST(p_size AS STRING)) AS label_full, concat('group ', CAST(p_size % 5 AS STRING)) AS sampling_label,
               concat('L1-', CAST(p_size % 2 AS STRING)) AS level_1, concat('L2-', CAST(p_size % 4 AS STRING)) AS level_2,
               concat('L3-', CAST(p_size % 8 AS STRING)) AS level_3
        FROM part WHERE p_size % 10 <> 3""",
    "regions": """
        SELECT n_name AS iso3, r_name AS region, -180e0 + (n_nationkey % 5) * 72e0 AS w, -180e0 + (n_nationkey % 5) * 72e0 + 60e0 AS e,
               -60e0 + floor(n_nationkey / 5e0) * 24e0 AS s, -60e0 + floor(n_nationkey / 5e0) * 24e0 + 20e0 AS n
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    # samples of which some have no or impossible coordinates
    "located": """
        SELECT concat('P', CAST(p_partkey AS STRING)) AS sample_id, CASE WHEN p_partkey % 50 = 0 THEN NULL WHEN p_partkey % 50 = 1 THEN 95e0 ELSE -60e0 + (p_partkey * 37 % 12000) / 100e0 END AS lat,
               -180e0 + (p_partkey * 91 % 36000) / 100e0 AS lon
        FROM part""",
    "jobs": """
        SELECT concat('J', CAST(o_orderkey AS STRING)) AS job, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'queued' ELSE 'running' END AS status,
               o_totalprice AS cost, concat(CAST(o_orderkey % 900 AS STRING), 's') AS duration, o_custkey % 60 + 32601 AS epsg,
               CAST(o_orderdate AS DATE) AS start_date, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 200 AS INTEGER) AS end_date
        FROM orders""",
    "predictions": """
        SELECT vec_id AS sample_id, concat('c', CAST(label AS STRING)) AS target,
               concat('c', CAST(CASE WHEN vec_id % 3 = 0 THEN (label + 1) % 10 ELSE label END AS STRING)) AS prediction,
               concat('r', CAST(vec_id % 5 AS STRING)) AS region, (vec_id % 11) / 10e0 AS weight
        FROM embeddings""",
    "pixels": """
        SELECT CAST(l_suppkey % 4 AS INTEGER) AS tile, CAST(l_partkey % 32 AS INTEGER) AS x, CAST(l_orderkey % 32 AS INTEGER) AS y,
               CAST(min(l_quantity) AS INTEGER) % 4 AS label, floor(avg(l_extendedprice) % 1000) / 1000e0 AS prob,
               CAST(max(l_linenumber) AS INTEGER) AS scl
        FROM lineitem GROUP BY 1, 2, 3""",
    # rasters of unequal extents
    "rasters": """
        SELECT CAST(l_suppkey % 4 AS INTEGER) AS tile, CAST(l_partkey % (32 - 2 * (l_suppkey % 4)) AS INTEGER) AS x, CAST(l_orderkey % (32 - 3 * (l_suppkey % 4)) AS INTEGER) AS y,
               CAST(min(l_quantity) AS INTEGER) % 4 AS label, floor(avg(l_extendedprice) % 1000) / 1000e0 AS prob,
               CAST(max(l_linenumber) AS INTEGER) AS scl
        FROM lineitem GROUP BY 1, 2, 3""",
    "calendar": """
        SELECT CAST(floor(s_suppkey / 10e0) AS INTEGER) * 5e-1 + 1025e-2 AS lat, CAST(s_suppkey % 10 AS INTEGER) * 5e-1 + 2025e-2 AS lon,
               CAST(1 + s_suppkey * 7 % 200 AS INTEGER) AS s1_sos, CAST(1 + (s_suppkey * 7 % 200) + 100 AS INTEGER) AS s1_eos,
               CAST(1 + s_suppkey * 11 % 180 + 150 AS INTEGER) AS s2_sos, CAST(1 + (s_suppkey * 11 % 180) * 2 AS INTEGER) AS s2_eos,
               CAST(1 + s_suppkey % 60 AS INTEGER) AS sos_dekad, CAST(40 + s_suppkey % 60 AS INTEGER) AS eos_dekad
        FROM supplier""",
    "embeddings_": "SELECT vec_id, embedding, label FROM embeddings",
    "events_": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "collections": """
        SELECT concat(CAST(2017 + n_nationkey % 8 AS STRING), '_', n_name) AS ref_id, n_nationkey * 10e0 - 120e0 AS w, n_nationkey * 10e0 - 112e0 AS e,
               n_nationkey * 2e0 - 30e0 AS s, n_nationkey * 2e0 - 20e0 AS n, DATE '2017-01-01' + CAST(n_nationkey * 90 AS INTEGER) AS t0,
               DATE '2018-01-01' + CAST(n_nationkey * 90 AS INTEGER) AS t1, CASE WHEN n_nationkey % 3 = 0 THEN 'Private' ELSE 'Public' END AS access
        FROM nation""",
}
#: Adapters that Spark reads by another SELECT of the same rows: a sum of floats by group depends on the order of its
#: rows, which is that of arrival in Spark. Here it is that of the events, as one reader of the file takes them.
SPARK_ADAPTERS = {
    "obs_dekad": """
        SELECT concat('U', CAST(user_id AS STRING)) AS sample_id, day AS ts, CAST(floor(total / n) AS INTEGER) AS b02
        FROM (SELECT user_id, day, sum(value) OVER (so_far) AS total, count(value) OVER (so_far) AS n, row_number() OVER (so_far) AS k, count(*) OVER (PARTITION BY user_id, day) AS last
              FROM (SELECT user_id, event_id, ts, value,
                           CAST(CASE WHEN day(ts) <= 10 THEN date_trunc('MONTH', ts) WHEN day(ts) <= 20 THEN date_trunc('MONTH', ts) + INTERVAL 10 DAY
                                ELSE date_trunc('MONTH', ts) + INTERVAL 20 DAY END AS DATE) AS day FROM events)
              WINDOW so_far AS (PARTITION BY user_id, day ORDER BY event_id, ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
        WHERE k = last""",
}
_TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def adapted(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The adapter's table from the driver's Parquet files."""
    text = SPARK_ADAPTERS.get(name, ADAPTERS[name])
    used = [t for t in _TABLES if re.search(rf"(FROM|JOIN) {t}\b", text)]
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    for t in used:
        text = re.sub(rf"(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **frames)


def with_adapters(sql: str) -> str:
    """DuckDB SQL with the adapters that it names put before it."""
    used = [n for n in ADAPTERS if re.search(rf"\b{n}\b", sql)]
    heads = ", ".join(f"{n} AS ({ADAPTERS[n].strip()})" for n in used)
    if not heads:
        return sql
    body = sql.strip()
    return f"WITH {heads}, {body[5:]}" if body[:5].upper() == "WITH " else f"WITH {heads} {body}"
