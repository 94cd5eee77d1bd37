"""Ordered merging of binary fragments in a tree of bounded fan-in.

The merger is a plug point (bytes of several fragments to bytes of one); the
default concatenates. Each round merges groups of `fan_in` neighbours in their
own tasks, so no task holds more than `fan_in` fragments, and a lone fragment passes
through: every leaf is kept, whatever their number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.operators.pages import positive


def concat_fragments(parts: Column) -> Column:
    return F.aggregate(parts, F.lit("").cast("binary"), lambda a, x: F.concat(a, x))


def merge_tree(
    fragments: DataFrame, key: str, order: str, content: str, fan_in: int = 4, merger: Callable[[Column], Column] = concat_fragments
) -> DataFrame:
    """(key, content) of fragments(key, order from 0 without gaps, content).

    The number of rounds is the logarithm of the longest group, read once.
    """
    if positive("fan_in", fan_in) < 2:
        raise ValueError("fan_in must be >= 2")
    longest = fragments.agg(F.max(order)).first()[0]
    current = fragments.select(key, F.col(order).cast("bigint").alias("_ix"), F.col(content).cast("binary").alias("_c"))
    size = 0 if longest is None else int(longest) + 1
    while size > 1:
        parts = F.transform(F.array_sort(F.collect_list(F.struct("_ix", "_c"))), lambda x: x["_c"])
        current = current.groupBy(key, F.expr(f"_ix div {fan_in}").alias("_ix")).agg(merger(parts).alias("_c"))
        size = -(-size // fan_in)
    return current.select(key, F.col("_c").alias(content))
