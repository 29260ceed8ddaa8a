"""Typing and deduplicating raw tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import sequence_within


class Field(NamedTuple):
    """One typed column: strict casts raise on unreadable text, tolerant ones give NULL."""

    source: str
    name: str
    type: str
    tolerant: bool = False
    sentinel: str | None = None

    def sql(self) -> str:
        raw = f"`{self.source}`"
        if self.sentinel is not None:
            raw = f"nullif({raw}, '{self.sentinel}')"
        return f"{'try_cast' if self.tolerant else 'cast'}({raw} as {self.type}) as `{self.name}`"


def typed_select(df: DataFrame, fields: Sequence[Field | Column]) -> DataFrame:
    """Rename and cast; plain columns pass through for derived values."""
    return df.select(*[F.expr(f.sql()) if isinstance(f, Field) else f for f in fields])


def dedupe_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], *, total: bool = False
) -> DataFrame:
    """One row per key, the first in ``order``.

    Ties fall to a hash of the row, so the pick does not depend on partitioning;
    ``total=True`` says the order has no ties. The planner drops all but each
    task's first row per key before the shuffle, so no key can become a hot spot.
    """
    ranking = list(order) if total else [*order, F.xxhash64(*df.columns)]
    window = Window.partitionBy(*keys).orderBy(*ranking)
    return df.withColumn("_pick", F.row_number().over(window)).where("_pick = 1").drop("_pick")


def event_sequence(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str = "action_seq",
) -> DataFrame:
    """Drop identical rows, then number the rows that share a natural key.

    The remaining columns break ties after ``order``, so the numbering is unique. Rows are hashed by
    the key once, for both steps.
    """
    distinct = df.repartition(*keys).dropDuplicates()
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranking = [F.col(c).asc_nulls_last() for c in [*order, *rest]]
    return sequence_within(distinct, keys, ranking, out)


def drop_rollups(df: DataFrame, label: str, rollup: str, required: str) -> DataFrame:
    """Keep rows whose label is not the rollup marker (nor NULL) and whose id is present."""
    return df.where((F.col(label) != rollup) & F.col(required).isNotNull())


def union_distinct(*parts: DataFrame) -> DataFrame:
    """Distinct rows of several tables."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.distinct()


def most_recent(df: DataFrame, by: str, key: str, n: int) -> DataFrame:
    """The n most recent rows, ties by key."""
    return df.orderBy(F.col(by).desc(), F.col(key)).limit(n)


def top_n(df: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    """The n rows with the largest measure, rows without it last, ties by key."""
    return df.orderBy(F.col(measure).desc_nulls_last(), F.col(key)).limit(n)


def last_periods(df: DataFrame, period: str, n: int) -> DataFrame:
    """Rows of the n latest distinct periods."""
    latest = df.select(period).distinct().orderBy(F.col(period).desc()).limit(n)
    return df.join(latest, period, "left_semi")


def unpivot_long(df: DataFrame, ids: Sequence[str], measures: Sequence[str], name: str, value: str) -> DataFrame:
    """Wide measures as tidy (name, value) rows."""
    return df.unpivot(list(ids), list(measures), name, value)


def variant_fallback(primary: DataFrame, fallback: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of either version, each column from the primary where it has a value."""
    a, b = primary.alias("a"), fallback.alias("b")
    return a.join(b, list(keys), "full").select(
        *keys, *[F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in columns]
    )


def unify_variants(
    base: DataFrame, extra: DataFrame, keys: Sequence[str], columns: Sequence[str], *, within: str | None = None
) -> DataFrame:
    """All rows of the base with the other variant's columns where it has the key.

    ``within`` names one of several keys, by which both are dealt already and whose groups are bounded by their meaning:
    a group's rows of the other variant become a list in which the base's rows find theirs, so nothing is dealt by all keys.
    """
    if within is None:
        return base.join(extra.select(*keys, *columns), list(keys), "left")
    rest = [k for k in keys if k != within]
    lists = extra.dropna(subset=list(keys)).groupBy(within).agg(F.collect_list(F.struct(*rest, *columns)).alias("_all"))

    def matches(row: Column) -> Column:
        return reduce(and_, [row[k] == F.col(k) for k in rest])

    rows = base.join(lists, within, "left").withColumn("_found", F.filter("_all", matches)).drop("_all")
    return rows.select(*base.columns, F.explode_outer("_found").alias("_found")).select(
        *keys, *[c for c in base.columns if c not in keys], *[F.col(f"_found.{c}").alias(c) for c in columns]
    )
