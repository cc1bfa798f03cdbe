"""Array helpers used by the run reports (all built-in expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_ints(arr: Column, sep: str = ",") -> Column:
    """int array -> ``'a,b,c'``; NULL elements are skipped, an empty array gives ``''``."""
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), sep)


def sorted_distinct(c: Column) -> Column:
    """Aggregate: distinct non-NULL values of ``c``, ascending."""
    return F.array_sort(F.collect_set(c))


def in_order(value: Column, *order: Column) -> Column:
    """Aggregate: ``value`` of every row (duplicates and NULLs kept), ordered by ``order``.

    Collects ``struct(order..., value)`` and sorts the structs field by field,
    then keeps the value field.
    """
    fields = [o.alias(f"_o{i}") for i, o in enumerate(order)] + [value.alias("_v")]
    return F.transform(F.array_sort(F.collect_list(F.struct(*fields))), lambda s: s["_v"])
