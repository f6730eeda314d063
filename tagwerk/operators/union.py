"""Append frames by column name; missing columns become NULL, duplicates kept."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("union_by_name needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
