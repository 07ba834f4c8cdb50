"""Joins against a lookup that was grouped by the join key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_AGAIN = "__key_hash"


def splittable_join(rows: DataFrame, lookup: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which adaptive execution may split a partition of ``rows`` that one key fills.

    A lookup grouped by the join key is already partitioned by it and would be joined as it lies;
    adaptive execution splits a skewed partition only between two shuffles made for the join. A hash
    of the key as one more join column makes the (small) lookup move once more and so allows it.
    """
    hashed = F.xxhash64(*on).alias(_AGAIN)
    left, right = rows.select("*", hashed), lookup.select("*", hashed)
    return left.join(right, [*on, _AGAIN], how).drop(_AGAIN)
