"""Union of frames whose columns differ."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _kinds(frames: Sequence[DataFrame]) -> dict[str, set[T.DataType]]:
    kinds: dict[str, set[T.DataType]] = {}
    for frame in frames:
        for field in frame.schema:
            kinds.setdefault(field.name, set()).add(field.dataType)
    return kinds


def union_by_name(frames: Sequence[DataFrame], relaxed: bool = False) -> DataFrame:
    """UNION ALL by column name; a column a frame lacks is NULL there.

    Columns keep the first frame's order, later ones are appended. Numeric types
    widen by themselves; ``relaxed`` also turns a column that is text in one
    frame and something else in another into text.
    """
    if not frames:
        raise ValueError("nothing to union: no input frames")
    if relaxed:
        mixed = [
            name
            for name, kinds in _kinds(frames).items()
            if len(kinds) > 1 and T.StringType() in kinds
        ]
        frames = [
            f.withColumns({c: F.col(c).cast("string") for c in mixed if c in f.columns}) for f in frames
        ]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
