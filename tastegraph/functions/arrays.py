"""Array expressions that keep a per-row group inside its row, with no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row.

    A lambda computes every outer expression it mentions again for each element;
    a lambda variable is a plain reference.
    """
    return F.get(F.transform(F.array(value), body), 0)


def run_starts(ordered: Column) -> Column:
    """0-based positions where a new value starts in a sorted array (a reference)."""
    return F.filter(
        F.transform(ordered, lambda _, i: i),
        lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
    )


def value_counts(values: Column) -> Column:
    """``array<struct<value, n>>`` of a string array, from its sorted runs."""

    def counts(ordered: Column, starts: Column) -> Column:
        def run(start: Column, j: Column) -> Column:
            end = F.coalesce(F.get(starts, j + 1), F.size(ordered))
            return F.struct(
                F.get(ordered, start).alias("value"), (end - start).cast("long").alias("n")
            )

        return F.transform(starts, run)

    return let(F.array_sort(values), lambda o: let(run_starts(o), lambda s: counts(o, s)))


def last_per_id(ids: Column, values: Column) -> Column:
    """Map from id to value; a repeated id keeps the value at its last position."""

    def pick(placed: Column, ends: Column) -> Column:
        def entry(end: Column) -> Column:
            item = F.get(placed, end)
            return F.struct(item["id"], item["value"])

        return F.map_from_entries(F.transform(ends, entry))

    def ends(placed: Column) -> Column:
        last = F.size(placed) - 1
        return F.filter(
            F.transform(placed, lambda _, i: i),
            lambda i: (i == last) | (F.get(placed, i)["id"] != F.get(placed, i + 1)["id"]),
        )

    listed = F.transform(
        F.arrays_zip(ids.alias("id"), values.alias("value")),
        lambda e, i: F.struct(e["id"].alias("id"), i.alias("at"), e["value"].alias("value")),
    )
    return let(F.array_sort(listed), lambda p: let(ends(p), lambda e: pick(p, e)))


def literal_doubles(values) -> Column:
    """A constant ``array<double>``; one literal, folded once by the optimizer."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def dot(indices: Column, values: Column, weights: Column) -> Column:
    """Sum of ``values[j] * weights[indices[j]]``."""
    return F.aggregate(
        F.zip_with(indices, values, lambda i, v: v * F.get(weights, i)),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )
