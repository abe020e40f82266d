"""Joins that stay splittable when a key is hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MARK = "_keys_hash"


def splittable_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join of ``left`` with a ``right`` that was aggregated on the same keys.

    Adaptive execution splits a hot left partition only if bare shuffles feed
    the join. An aggregate on the join keys would hand its own shuffle on and
    stand in between, so the join also names a hash of the keys: the (already
    reduced) right side is shuffled once more, and a hot key of ``left`` can be
    spread over tasks. A right side that turns out small is broadcast, an empty
    one drops out of the plan, both by its size at run time.
    """
    hashed = F.xxhash64(*[F.col(k) for k in keys])
    return (
        left.withColumn(_MARK, hashed)
        .join(right.withColumn(_MARK, hashed), [*keys, _MARK], how)
        .drop(_MARK)
    )


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose keys are not in ``right``; a null key never matches.

    The right side is reduced to distinct keys before its shuffle.
    """
    seen = right.select(*keys).dropna(subset=list(keys)).distinct()
    return splittable_join(left, seen, keys, "left_anti").select(left.columns)
