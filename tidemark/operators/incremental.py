"""Incremental loads of written tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import same_keys, sequence_within
from tidemark.operators.staging import dedupe_latest
from tidemark.session import discard, written
from tidemark.sources import versions


def incremental_merge(
    target: DataFrame, source: DataFrame, keys: Sequence[str], date: str, *, lookback_days: int = 0
) -> DataFrame:
    """The target after merging source rows newer than its latest date, by key.

    The comparison is strict, so rows arriving late for the latest date are missed
    unless ``lookback_days`` reaches back over them. Without a mark, in an empty target or one
    without dates, all rows are new, and rows without a date always are. Of several new rows of a key the
    latest stays, ties by a hash of the row. NULL keys are keys. The mark is a
    scalar subquery, pushed into the source's scan as a filter.
    """
    mark = target.agg(F.date_sub(F.max(F.col(date).cast("date")), lookback_days).alias("m")).scalar()
    fresh = _fresh(source, keys, date, mark)
    new = fresh.select(*[F.col(k).alias(f"_new_{k}") for k in keys]).distinct()
    kept = target.join(new, same_keys(target, new, [(k, f"_new_{k}") for k in keys]), "left_anti")
    return kept.select(*target.columns).unionByName(fresh)


def _fresh(source: DataFrame, keys: Sequence[str], date: str, mark: Column) -> DataFrame:
    day = F.col(date).cast("date")
    return dedupe_latest(source.where(day.isNull() | mark.isNull() | (day > mark)), keys, [F.col(date).desc_nulls_last()])


def merge_parts(
    source: DataFrame, path: str, keys: Sequence[str], date: str, part: Column, *, lookback_days: int = 0, tests: versions.Tests | None = None
) -> versions.Version:
    """``incremental_merge`` into a stored table of versions, of which only the parts that change are rewritten.

    A part changes if fresh rows belong to it or if it holds a row of a fresh row's key; to find the latter, only
    the table's keys and the columns of ``part`` are read. The high-water mark is kept with the table, so its dates are
    not read. The new version appears at once, after ``tests`` have passed on it. A first run writes the whole table.
    """
    spark = source.sparkSession
    before = versions.version(spark, path)
    mark = before.about.get("mark")
    limit = F.date_sub(F.lit(mark).cast("date"), lookback_days)
    fresh = written(_fresh(source, keys, date, limit), "fresh_rows")
    held = versions.read(spark, path, source.schema, before)
    new = fresh.select(*[F.col(k).alias(f"_new_{k}") for k in keys]).distinct()
    pairs = [(k, f"_new_{k}") for k in keys]
    touched = set(versions.parts_in(held.join(new, same_keys(held, new, pairs), "left_semi"), part)) | set(versions.parts_in(fresh, part))
    old = versions.read(spark, path, source.schema, before, list(touched))
    kept = old.join(new, same_keys(old, new, pairs), "left_anti")
    latest = fresh.agg(F.max(F.col(date).cast("date"))).first()[0]
    about = {"mark": max(filter(None, (mark, latest and latest.isoformat())), default=None)}
    try:
        return versions.replace_parts(kept.unionByName(fresh), path, part, touched=list(touched), tests=tests, about=about, after=before)
    finally:
        discard(fresh)


def temporal_split(df: DataFrame, entity: str, order: Sequence[str], first: int) -> DataFrame:
    """Tag each entity's first rows as 'train' and the later ones as 'test'."""
    ranked = sequence_within(df, [entity], [F.col(c) for c in order], "_nth")
    return ranked.withColumn("split", F.when(F.col("_nth") <= first, "train").otherwise("test")).drop("_nth")


def novel_pairs(train: DataFrame, test: DataFrame, a: str, b: str) -> DataFrame:
    """Test rows tagged by whether their unordered pair occurs in the training rows."""
    pair = [F.least(a, b).alias("_lo"), F.greatest(a, b).alias("_hi")]
    seen = train.select(*pair).distinct().withColumn("_seen", F.lit(True))
    return (
        test.select("*", *pair)
        .join(seen, ["_lo", "_hi"], "left")
        .withColumn("is_novel", F.col("_seen").isNull())
        .select(*test.columns, "is_novel")
    )
