"""Marts over (entity, group, period) rows: tenure and cohort attribution."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import dealt

# Periods that make an entity established, and periods shown in the reports.
THRESHOLD = 4
REPORT_PERIODS = 20


def tenure_rollup(
    df: DataFrame, entity: str, group: str, period: str, *, name: str, label: str, tie: str, measures: dict[str, str]
) -> DataFrame:
    """One row per (entity, group): periods spent, first and last period, summed measures.

    ``label`` is the one of the latest period (ties by ``tie``), NULL if that one is.
    """
    return df.groupBy(entity, group).agg(
        F.max(name).alias(name),
        F.max_by(label, F.struct(period, tie)).alias(label),
        F.count_distinct(period).alias("seasons"),
        F.min(period).alias("first_season"),
        F.max(period).alias("last_season"),
        *[F.sum(c).alias(out) for c, out in measures.items()],
    )


def latest_label(df: DataFrame, key: str, label: str, period: str, tie: str | Column) -> DataFrame:
    """The last known label per key; rows without a label do not count."""
    order = F.struct(F.col(period).alias("p"), (F.col(tie) if isinstance(tie, str) else tie).alias("t"))
    return df.where(F.col(label).isNotNull()).groupBy(key).agg(F.max_by(label, order).alias(label))


def completed_periods(df: DataFrame, entity: str, period: str, out: str = "completed") -> DataFrame:
    """One row per entity and period with the number of distinct periods up to it.

    The rows are distinct before the window, so a group is as long as the calendar
    of periods however many raw rows an entity has.
    """
    once = df.select(entity, period).distinct()
    window = Window.partitionBy(entity).orderBy(period)
    return once.withColumn(out, F.row_number().over(window))


def established_in(df: DataFrame, entity: str, period: str, threshold: int = THRESHOLD) -> DataFrame:
    """The period in which an entity completes ``threshold`` distinct periods."""
    done = completed_periods(df, entity, period, "_nth").where(F.col("_nth") <= threshold)
    return done.where(F.col("_nth") == threshold).select(entity, F.col(period).alias("established_by"))


def _numbered_spells(df: DataFrame, entity: str, group: str, period: str, tasks: int | None) -> DataFrame:
    """The distinct (entity, group, period) rows with ``_nth``, the period's number among the entity's.

    All that follows groups by the entity, so the rows are shuffled for it only once more.
    """
    spells = dealt(df.where(F.col(period).isNotNull()).select(entity, group, period).distinct(), entity, tasks)
    return spells.withColumn("_nth", F.dense_rank().over(Window.partitionBy(entity).orderBy(period)))


def _attributed(numbered: DataFrame, entity: str, group: str, period: str, threshold: int) -> DataFrame:
    standing = numbered.groupBy(entity, group).agg(
        F.count_if(F.col("_nth") <= threshold).alias("periods"),
        F.min(period).alias("first"),
        F.min(F.when(F.col("_nth") == threshold, F.col(period))).alias("_by"),
    )
    winner = F.min_by(F.struct(group, "periods", "first"), F.struct(-F.col("periods"), "first", group))
    best = standing.groupBy(entity).agg(winner.alias("_best"), F.max("_by").alias("established_by"))
    return best.where(F.col("established_by").isNotNull()).select(entity, "_best.*", "established_by")


def attribute_cohort(df: DataFrame, entity: str, group: str, period: str, threshold: int = THRESHOLD, tasks: int | None = None) -> DataFrame:
    """The group each established entity spent most of its first ``threshold`` periods with.

    Ties go to the group joined earlier, then to the lower group id; no group is a group too. Rows without a
    period do not count. ``tasks`` is the number of parts that the entities are dealt to.
    """
    return _attributed(_numbered_spells(df, entity, group, period, tasks), entity, group, period, threshold)


class Cohorts(NamedTuple):
    attribution: DataFrame
    summary: DataFrame
    matrix: DataFrame


def _share(count: Column, total: Column, digits: int = 1) -> Column:
    return F.when(total > 0, F.round(100.0 * count / total, digits)).otherwise(F.lit(0.0))


def cohort_summary(
    df: DataFrame, entity: str, period: str, threshold: int = THRESHOLD, last_n: int = REPORT_PERIODS
) -> DataFrame:
    """Per period: active entities, how many are established by then, and their percentage (half-even)."""
    active = completed_periods(df, entity, period)
    latest = df.select(period).distinct().orderBy(F.col(period).desc()).limit(last_n)
    counts = active.join(latest, period, "left_semi").groupBy(period).agg(
        F.count(F.lit(1)).alias("active"), F.count_if(F.col("completed") >= threshold).alias("vets")
    )
    return counts.select(
        period,
        "active",
        "vets",
        (F.col("active") - F.col("vets")).alias("below"),
        F.bround(100.0 * F.col("vets") / F.col("active"), 1).alias("vet_pct"),
    )


def cohort_counts(
    df: DataFrame,
    entity: str,
    group: str,
    period: str,
    label: str,
    threshold: int = THRESHOLD,
    last_n: int = REPORT_PERIODS,
    tasks: int | None = None,
) -> DataFrame:
    """Established active entities per period and attributed group, under the group's latest label.

    ``tasks`` is the number of parts that the entities are dealt to.
    """
    labels = latest_label(df, group, label, period, tie=entity)
    latest = df.select(period).distinct().orderBy(F.col(period).desc()).limit(last_n)
    numbered = _numbered_spells(df, entity, group, period, tasks)
    since = numbered.where(F.col("_nth") >= threshold).select(entity, period).distinct()
    owner = _attributed(numbered, entity, group, period, threshold).select(entity, group)
    counts = since.join(owner, entity).groupBy(group, period)
    named = counts.agg(F.count(F.lit(1)).alias("n")).join(latest, period, "left_semi").join(labels, group)
    return named.groupBy(label, period).agg(F.sum("n").alias("n"))


def cohort_share(counts: DataFrame, summary: DataFrame, label: str, period: str) -> DataFrame:
    """Each group's percentage of a period's established entities, largest first; 0 without any."""
    joined = counts.join(summary.select(period, "vets"), period)
    out = joined.select(period, label, "n", _share(F.col("n"), F.col("vets")).alias("share"))
    return out.orderBy(period, F.col("share").desc(), label)


def latest_values(df: DataFrame, period: str, last_n: int = REPORT_PERIODS) -> list:
    """The ``last_n`` latest distinct periods, ascending: at most that many values reach the driver."""
    rows = df.select(period).distinct().orderBy(F.col(period).desc()).limit(last_n).collect()
    return sorted(r[0] for r in rows)


def cohort_matrix(counts: DataFrame, label: str, period: str, periods: Sequence) -> DataFrame:
    """Groups as rows, the given periods as columns, 0 where none; ordered by the last period's count."""
    wide = counts.groupBy(label).pivot(period, list(periods)).agg(F.sum("n")).na.fill(0)
    return wide.orderBy(F.col(f"`{periods[-1]}`").desc(), label)


def cohort_report(
    df: DataFrame,
    entity: str,
    group: str,
    period: str,
    label: str,
    threshold: int = THRESHOLD,
    last_n: int = REPORT_PERIODS,
) -> Cohorts:
    """Attribution per entity, summary per period and the group × period matrix."""
    counts = cohort_counts(df, entity, group, period, label, threshold, last_n)
    return Cohorts(
        attribute_cohort(df, entity, group, period, threshold),
        cohort_summary(df, entity, period, threshold, last_n).orderBy(period),
        cohort_matrix(counts, label, period, latest_values(df, period, last_n)),
    )
