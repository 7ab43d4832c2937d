"""Joins that stay balanced when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame


def left_join(
    left: DataFrame, right: DataFrame, key: str, hot_right: bool = False
) -> DataFrame:
    """Left outer join on one column.

    ``hot_right`` is for a right side where one key may hold much of the rows;
    it reads and exchanges both sides twice. Adaptive execution can split a hot key on the right of an inner join, but
    not on the right of a left outer join. So the matches come from an inner
    join, and the left rows without one from an anti join against the distinct
    keys. Filter the right side beforehand for a condition on it.
    """
    if not hot_right:
        return left.join(right, key, "left")
    matched = left.join(right, key)
    unmatched = left.join(right.select(key).distinct(), key, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
