"""The registered queries of the library's own operators."""

from __future__ import annotations

from agrispark.operators import columns, covers, geometry, grid, hexes, pixels, polygons, relations, sampling, scoring, seasons, splits, timeseries  # noqa: F401
from agrispark.registry import ORACLE_SQL, QUERIES  # noqa: F401
from agrispark.sources import files  # noqa: F401
