"""Ordered computations within groups.

A group is handed to one task where its size is bounded by its meaning: the versions
of an entity, the events of a game, the games of a team. Where it is not, the caller names
``slices``: columns that cut the order into consecutive parts, such as the month of a
timestamp. Each slice is then handled on its own and one small total for each
slice carries the state over. Both are one lazy plan, whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


class Running(NamedTuple):
    """A running aggregate from the start of the group up to the row: 'sum' or 'max'."""

    kind: str
    value: Column


def same_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality of column pairs."""
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def _aggregate(kind: str, value: Column) -> Column:
    return {"sum": F.sum, "max": F.max}[kind](value)


def _combine(kind: str, before: Column, here: Column) -> Column:
    if kind == "sum":
        return F.coalesce(before + here, before, here)
    return F.greatest(before, here)


def running(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], measures: dict[str, Running], *, slice_by: Column | None = None
) -> DataFrame:
    """Append running aggregates over each group in the given order.

    ``slice_by`` must never fall from one row of the order to the next; a group then needs
    one row for each of its slices in one task, and one slice's rows in another.
    """
    if slice_by is None:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[_aggregate(m.kind, m.value).over(window).alias(out) for out, m in measures.items()])
    sliced = df.select("*", slice_by.alias("_slice"), *[m.value.alias(f"_v_{out}") for out, m in measures.items()])
    here = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.select("*", *[_aggregate(m.kind, F.col(f"_v_{out}")).over(here).alias(f"_l_{out}") for out, m in measures.items()])
    totals = sliced.groupBy(*keys, "_slice").agg(*[_aggregate(m.kind, F.col(f"_v_{out}")).alias(f"_t_{out}") for out, m in measures.items()])
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_slice").alias("_k_slice"),
        *[_aggregate(m.kind, F.col(f"_t_{out}")).over(earlier).alias(f"_b_{out}") for out, m in measures.items()],
    )
    on = same_keys(local, before, [(k, f"_k_{k}") for k in keys] + [("_slice", "_k_slice")])
    return local.join(before, on).select(
        *[F.col(c) for c in df.columns],
        *[_combine(m.kind, F.col(f"_b_{out}"), F.col(f"_l_{out}")).alias(out) for out, m in measures.items()],
    )


def sequence_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """Append 1, 2, 3, … over each group in the given order; groups are bounded by their meaning."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def framed(df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Callable[[WindowSpec], Sequence[Column]]) -> DataFrame:
    """Append window columns over each group; groups are bounded by their meaning.

    ``columns`` gets the ordered window and may narrow it with ``rowsBetween``.
    """
    return df.select("*", *columns(Window.partitionBy(*keys).orderBy(*order)))


def dealt(df: DataFrame, key: str, tasks: int | None) -> DataFrame:
    """The rows dealt by the key to so many tasks; as the session deals them if no number is given.

    For steps that make several rows of one: tasks by the bytes of their input would get too many.
    """
    return df if tasks is None else df.repartition(tasks, key)


def dealt_once(df: DataFrame, key: str | Column) -> DataFrame:
    """The rows dealt by the key to as many tasks as the session names, for several steps by that key in one place.

    AQE would merge tasks by the bytes of their input, which say too little of the memory such steps take together.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def covered(df: DataFrame, game: str, columns: Sequence[Column], start: str, stop: str, tasks: int | None = None) -> DataFrame:
    """(_game, columns, stint_no, stint_start): the stretches that each row covers, from its start to its stop.

    The distinct starts and stops of a game are numbered. A row is expanded to the numbers from its start's to its stop's;
    at the last, where the row has ended, its columns are NULL. Every number's time is known from the rows that
    start or stop there, NULL in the others. All steps keep the games where they are: they are shuffled once.
    """
    rows = df.select(F.col(game).alias("_game"), F.struct(*columns).alias("_row"), F.col(start).alias("_from"), F.col(stop).alias("_to"))
    ends = dealt(rows, "_game", tasks).withColumn("_point", F.explode(F.array("_from", "_to")))
    numbered = framed(ends, ["_game"], [F.col("_point")], lambda w: [F.dense_rank().over(w).alias("_no")])
    spans = numbered.groupBy("_game", "_row", "_from", "_to").agg(F.min("_no").alias("_first"), F.max("_no").alias("_last"))
    there = spans.select("*", F.explode(F.sequence("_first", "_last")).alias("stint_no"))
    time = F.when(F.col("stint_no") == F.col("_first"), F.col("_from")).when(F.col("stint_no") == F.col("_last"), F.col("_to"))
    return there.select("_game", F.when(F.col("stint_no") < F.col("_last"), F.col("_row")).alias("_row"), "stint_no", time.alias("stint_start")).select("_game", "_row.*", "stint_no", "stint_start")


def numbered_stretches(there: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """(_game, stint_no, stint_start, measures, stint_end): the stretches of ``covered`` rows, the last of a game without an end."""
    found = there.groupBy("_game", "stint_no").agg(F.max("stint_start").alias("stint_start"), *[c.alias(n) for n, c in measures.items()])
    return framed(found, ["_game"], [F.col("stint_no")], lambda w: [F.lead("stint_start").over(w).alias("stint_end")])


def quantile_cell(df: DataFrame, value: Column, cells: int, coarse: int = 16) -> DataFrame:
    """Append ``_cell``: the number of the value's interval between approximate quantiles of all values, from 0; null values are in 0.

    The quantiles are a scalar subquery. A value is compared with every cells/coarse-th of them first, then with those
    in between. A larger value never gets a smaller number.
    """
    ends = df.agg(F.percentile_approx(value, [i / cells for i in range(1, cells)], 20 * cells).alias("e")).scalar()
    placed = df.withColumns({"_ends": ends, "_value": value})
    step = cells // coarse

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda e: e <= F.col("_value")))

    firsts = F.transform(F.sequence(F.lit(1), F.lit(coarse - 1)), lambda i: F.get("_ends", i * step - 1))
    placed = placed.withColumn("_coarse", below(firsts))
    cell = F.col("_coarse") * step + below(F.slice("_ends", F.col("_coarse") * step + 1, step - 1))
    return placed.withColumn("_cell", F.greatest(F.coalesce(cell, F.lit(0)), F.lit(0))).drop("_ends", "_value", "_coarse")
