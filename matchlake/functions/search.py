"""Binary search in a sorted array column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_before(
    items: Column, longest: int, before: Callable[[Column], Column]
) -> Column:
    """How many leading items satisfy ``before``.

    ``items`` must be sorted so that ``before`` is true for a prefix only;
    ``longest`` bounds the array length and so the number of halvings.
    """
    halvings = max(1, int(longest).bit_length())
    start = F.struct(F.lit(0).alias("lo"), F.size(items).alias("hi"))

    def halve(span: Column, _: Column) -> Column:
        mid = F.shiftright(span["lo"] + span["hi"], 1)
        narrowed = F.when(
            before(F.get(items, mid)),
            F.struct((mid + 1).alias("lo"), span["hi"].alias("hi")),
        ).otherwise(F.struct(span["lo"].alias("lo"), mid.alias("hi")))
        return F.when(span["lo"] < span["hi"], narrowed).otherwise(span)

    steps = F.sequence(F.lit(1), F.lit(halvings))
    return F.aggregate(steps, start, halve, lambda span: span["lo"])
