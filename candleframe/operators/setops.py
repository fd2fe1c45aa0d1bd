"""Set operations over candle frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_pairs(*frames: DataFrame) -> DataFrame:
    """Union all, matching columns by name (``union`` matches by position and silently
    swaps same-typed columns listed in another order)."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b), frames)
