"""Hexagonal cells: lattices of hexagons on the faces of an icosahedron, each level with a seventh of the area of the one above.

A point is projected onto the face nearest to it from the centre of the globe. Cells of a level are the points
``q + r * z`` (z the sixth root of one) of a lattice on that face; the lattice of the next level is finer by ``2 + z``,
whose square length is seven, so a cell's centre divided by ``2 + z`` and rounded to the lattice is its parent. The
parents of a cell are exact in integers at every level.
"""

from __future__ import annotations

import cmath
import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrispark.registry import query

#: Distance of neighbouring centres of level 0 in radii of the globe: cells of about 4.3 million square kilometres.
SPACING = 0.3477
#: Turns of the icosahedron about two axes, so that round coordinates don't lie between faces.
TURN_Z, TURN_X = 0.3, 0.7
STEP = 2 + cmath.exp(1j * math.pi / 3)


def faces() -> list[tuple[list[float], list[float], list[float]]]:
    """For each face its outward normal and the two axes of its plane."""
    golden = (1 + 5**0.5) / 2
    corners = [np.roll([0.0, a, b * golden], k) for k in range(3) for a in (-1, 1) for b in (-1, 1)]
    c, s = math.cos(TURN_Z), math.sin(TURN_Z)
    d, t = math.cos(TURN_X), math.sin(TURN_X)
    turn = np.array([[1, 0, 0], [0, d, -t], [0, t, d]]) @ np.array([[c, -s, 0], [s, c, 0], [0, 0, 1]])
    corners = [turn @ v / np.linalg.norm(v) for v in corners]
    edge = min(np.linalg.norm(a - b) for a, b in itertools.combinations(corners, 2))
    out = []
    for three in itertools.combinations(corners, 3):
        if all(np.linalg.norm(a - b) < edge * 1.01 for a, b in itertools.combinations(three, 2)):
            normal = sum(three) / np.linalg.norm(sum(three))
            first = three[0] - (three[0] @ normal) * normal
            first /= np.linalg.norm(first)
            out.append((normal, first, np.cross(normal, first)))
    return [tuple(v.tolist() for v in f) for f in out]


FACES = faces()


def lattice_cells(x: np.ndarray, y: np.ndarray, z: np.ndarray, finest: int, coarsest: int) -> dict[str, np.ndarray]:
    """``face`` of points of the unit globe, and ``q<level>``, ``r<level>`` of the hexagon that holds each, from the finest level up."""
    grow = STEP**finest / SPACING
    heights = np.stack([n[0] * x + n[1] * y + n[2] * z for n, _, _ in FACES])
    face = heights.argmax(axis=0)
    top = np.take_along_axis(heights, face[None], axis=0)[0]
    first, second = (np.array([f[j] for f in FACES])[face].T for j in (1, 2))
    east, north = ((t[0] * x + t[1] * y + t[2] * z) / top for t in (first, second))
    u, v = east * grow.real - north * grow.imag, east * grow.imag + north * grow.real
    q, r = u - v / math.sqrt(0.75) / 2, v / math.sqrt(0.75)
    out = {"face": face}
    for level in range(finest, coarsest - 1, -1):
        if level < finest:
            q, r = (3 * q + r) / 7, (2 * r - q) / 7
        s = -q - r
        a, b, c = (np.nan_to_num(np.floor(t + 0.5)).astype(np.int64) for t in (q, r, s))
        da, db, dc = np.abs(a - q), np.abs(b - r), np.abs(c - s)
        far = (da > db) & (da > dc)
        q, r = np.where(far, -b - c, a), np.where(~far & (db > dc), -a - c, b)
        out |= {f"q{level}": q, f"r{level}": r}
    return out


def with_hexes(points: DataFrame, levels: dict[str, int]) -> DataFrame:
    """``points`` (``lon``, ``lat``) with the name of the cell that holds each at every level given; null for null coordinates."""
    finest, coarsest = max(levels.values()), min(levels.values())
    fields = ", ".join(f"q{k} long, r{k} long" for k in range(finest, coarsest - 1, -1))

    @F.pandas_udf(f"face int, {fields}")
    def cells(x: pd.Series, y: pd.Series, z: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(lattice_cells(x.to_numpy(float), y.to_numpy(float), z.to_numpy(float), finest, coarsest))

    flat, lon, lat = F.cos(F.radians("lat")), F.radians("lon"), F.radians("lat")
    d = points.withColumn("_hex", cells(flat * F.cos(lon), flat * F.sin(lon), F.sin(lat)))
    known = F.col("lon").isNotNull() & F.col("lat").isNotNull()
    name = {n: F.concat_ws(":", F.lit(str(k)), *(F.col(f"_hex.{c}").cast("string") for c in ("face", f"q{k}", f"r{k}"))) for n, k in levels.items()}
    return d.withColumns({n: F.when(known, c) for n, c in name.items()}).drop("_hex")


_HEX = "CASE WHEN abs(a - q) > abs(b - r) AND abs(a - q) > abs(c + q + r) THEN -b - c ELSE a END AS q, CASE WHEN NOT (abs(a - q) > abs(b - r) AND abs(a - q) > abs(c + q + r)) AND abs(b - r) > abs(c + q + r) THEN -a - c ELSE b END AS r"
_ROUND = f"SELECT * EXCLUDE (q, r, a, b, c), {_HEX} FROM (SELECT *, floor(q + 0.5e0) AS a, floor(r + 0.5e0) AS b, floor(0.5e0 - q - r) AS c FROM ({{0}}))"
_NAME = "concat_ws(':', '{0}', CAST(face AS VARCHAR), CAST(CAST(q AS BIGINT) AS VARCHAR), CAST(CAST(r AS BIGINT) AS VARCHAR)) AS {1}"


def hex_sql(level: int, names: dict[int, str]) -> str:
    """SQL of ``samples`` with the names of their cells at a level and at those above."""
    grow = STEP**level / SPACING
    rows = ", ".join(f"({k}, {', '.join(repr(x) + 'e0' if 'e' not in repr(x) else repr(x) for v in f for x in v)})" for k, f in enumerate(FACES))
    sql = f"""SELECT sample_id, face, u - v / sqrt(0.75e0) / 2 AS q, v / sqrt(0.75e0) AS r FROM (SELECT sample_id, m.face AS face, m.x * {grow.real!r}e0 - m.y * {grow.imag!r}e0 AS u, m.x * {grow.imag!r}e0 + m.y * {grow.real!r}e0 AS v FROM
      (SELECT sample_id, arg_max({{'face': face, 'x': (px * ax + py * ay + pz * az) / (px * nx + py * ny + pz * nz), 'y': (px * bx + py * by_ + pz * bz) / (px * nx + py * ny + pz * nz)}}, px * nx + py * ny + pz * nz) AS m FROM
       (SELECT sample_id, cos(radians(lat)) * cos(radians(lon)) AS px, cos(radians(lat)) * sin(radians(lon)) AS py, sin(radians(lat)) AS pz FROM samples), (VALUES {rows}) f(face, nx, ny, nz, ax, ay, az, bx, by_, bz) GROUP BY sample_id))"""
    for at in range(level, min(names) - 1, -1):
        if at < level:
            sql = f"SELECT * EXCLUDE (q, r), (3 * q + r) / 7 AS q, (2 * r - q) / 7 AS r FROM ({sql})"
        sql = _ROUND.format(sql)
        if at in names:
            sql = f"SELECT *, {_NAME.format(at, names[at])} FROM ({sql})"
    return sql


@query("hierarchical_cell", "samples", sql=f"SELECT sample_id, cell, parent, coarse, top FROM ({hex_sql(5, {5: 'cell', 4: 'parent', 3: 'coarse', 0: 'top'})})")
def hierarchical_cell(samples: DataFrame) -> DataFrame:
    """The cell of level 5 and those above it at levels 4, 3 and 0."""
    levels = {"cell": 5, "parent": 4, "coarse": 3, "top": 0}
    return with_hexes(samples.select("sample_id", "lon", "lat"), levels).select("sample_id", *levels)
