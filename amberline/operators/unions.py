"""Union of frames by column name."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name; a column a frame lacks is null there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
