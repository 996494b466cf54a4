"""Folds over the arrays of a row that keep a result for each item."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def running(items: Column, state: Column, step: Callable[[Column, Column], Column], out: Callable[[Column, Column], Column], kind: str,
            block: int = 256) -> Column:
    """``out(state before the item, item)`` (of the type ``kind``) for each item, where ``step(state, item)`` gives the next state.

    The array is walked in blocks, so that appending copies a block at most and the work grows with the array.
    """
    def walk(first: Column, part: Column) -> Column:
        return F.aggregate(part, F.struct(first.alias("state"), F.array().cast(f"array<{kind}>").alias("out")),
                           lambda a, x: F.struct(step(a["state"], x).alias("state"), F.concat(a["out"], F.array(out(a["state"], x))).alias("out")))

    def blocks(all_items: Column) -> Column:
        start = F.array(F.struct(state.alias("state"), F.array().cast(f"array<{kind}>").alias("out")))
        done = F.aggregate(F.sequence(F.lit(0), F.floor((F.size(all_items) - 1) / block).cast("int")), start,
                           lambda a, i: F.concat(a, F.array(walk(F.element_at(a, -1)["state"], F.slice(all_items, i * block + 1, F.lit(block))))))
        return F.flatten(F.transform(done, lambda d: d["out"]))

    return let(items, lambda x: F.when(F.size(x) > 0, blocks(x)).otherwise(F.array().cast(f"array<{kind}>")))
