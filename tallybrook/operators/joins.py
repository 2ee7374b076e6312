"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_shared_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join on a column both sides have; the result has it once, first.

    NULL keys never match and repeated keys multiply. The strategy is left to
    Catalyst: a side is broadcast only if its measured size allows it, and
    adaptive execution splits the partition of a hot key in a sort-merge join.
    """
    shared = (set(left.columns) & set(right.columns)) - {key}
    if shared:
        raise ValueError(f"both sides have {sorted(shared)}; rename or drop them before the join")
    return left.join(right, key, "inner")
