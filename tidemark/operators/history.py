"""Type-2 history: versions with open and closed validity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import surrogate_key
from tidemark.operators.ordered import Running, framed, running
from tidemark.session import discard, written
from tidemark.sources import versions

# Seconds of one slice of a key's facts in the merge with its versions.
SLICE_SECONDS = 30 * 86400


def scd2_apply(current: DataFrame | None, incoming: DataFrame, key: str, check: Sequence[str], ts: Column) -> DataFrame:
    """All versions after one snapshot run at time ``ts``.

    ``current`` holds the earlier versions (``incoming`` columns plus valid_from and
    valid_to, ``None`` before the first run); ``incoming`` has one row per key. A
    new key opens a version, a null-safe change of a check column closes the old
    and opens a new one. Keys that are missing stay open, and other columns are
    refreshed only when a version opens.
    """
    columns = incoming.columns
    never = F.when(F.lit(False), ts)
    if current is None:
        return incoming.select(*columns, ts.alias("valid_from"), never.alias("valid_to"))
    closed = current.where(F.col("valid_to").isNotNull()).select(*columns, "valid_from", "valid_to")
    stored = current.where(F.col("valid_to").isNull()).select(
        F.col(key).alias("_key"), F.struct(*columns, "valid_from").alias("_old")
    )
    arriving = incoming.select(F.col(key).alias("_key"), F.struct(*columns).alias("_new"))
    both = stored.join(arriving, "_key", "full")
    same = F.struct(*[F.col(f"_old.{c}") for c in check]).eqNullSafe(F.struct(*[F.col(f"_new.{c}") for c in check]))
    had, has = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    changed = had & has & ~same

    def version(side: str, valid_from: Column, valid_to: Column) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in columns], valid_from.alias("valid_from"), valid_to.alias("valid_to")
        )

    # one full join yields both rows of a change
    versions = F.array(
        F.when(had, version("_old", F.col("_old.valid_from"), F.when(changed, ts).otherwise(never))),
        F.when(has & (~had | changed), version("_new", ts, never)),
    )
    rows = both.select(F.explode(F.filter(versions, lambda v: v.isNotNull())).alias("v")).select("v.*")
    return closed.unionByName(rows)


def scd2_store(incoming: DataFrame, path: str, key: str, check: Sequence[str], ts: Column, *, buckets: int = 64) -> versions.Version:
    """``scd2_apply`` into a stored table, where a run rewrites only what it changes.

    Open versions lie in parts by a hash of the key, of which only those with new or changed keys are rewritten; closed
    ones are appended, in a part for each run, and never touched again. Both appear at once. To find the changes, the
    open versions' key and check columns are read. ``buckets`` holds for a new table and is kept with it.
    """
    spark, columns = incoming.sparkSession, incoming.columns
    before = versions.version(spark, path)
    about = {"buckets": before.about.get("buckets", buckets)}
    part = F.concat(F.lit("open-"), F.pmod(F.xxhash64(key), F.lit(about["buckets"])))
    never = F.when(F.lit(False), ts)
    first = incoming.select(*columns, ts.alias("valid_from"), never.alias("valid_to"))
    opened = [p for p in before.parts if p and p.startswith("open-")]
    stored = versions.read(spark, path, first.schema, before, opened)
    old = stored.select(F.col(key).alias("_key"), F.struct(*check).alias("_old"))
    same = (first[key] == old["_key"]) & F.struct(*check).eqNullSafe(F.col("_old"))
    fresh = written(first.join(old, same, "left_anti"), "opened_versions")
    touched = versions.parts_in(fresh, part)
    now = fresh.select(F.col(key).alias("_key"))
    held = versions.read(spark, path, first.schema, before, touched)
    kept = held.join(now, F.col(key) == F.col("_key"), "left_anti").unionByName(fresh)
    closed = held.join(now, F.col(key) == F.col("_key"), "left_semi").select(*columns, "valid_from", ts.alias("valid_to"))
    new = versions.stage(kept, path, part)
    ended = versions.stage(closed, path, F.lit(f"closed-{before.number + 1:010}"))
    parts = {p: own for p, own in before.parts.items() if p not in set(touched)}
    parts |= {p: [folder] for p, folder in (new | ended).items()}
    done = versions.publish(spark, path, before, about, parts)
    discard(fresh)
    return done


def scd2_history(log: DataFrame, key: str, check: Sequence[str], ts: str) -> DataFrame:
    """The versions that repeated snapshots of an ordered change log would leave."""
    state = F.struct(*check)
    flagged = framed(
        log,
        [key],
        [F.col(ts)],
        lambda w: [F.lag(state).over(w).alias("_before"), F.lag(ts).over(w).isNull().alias("_first")],
    )
    opened = flagged.where(F.col("_first") | ~state.eqNullSafe(F.col("_before"))).drop("_before", "_first")
    versions = framed(opened, [key], [F.col(ts)], lambda w: [F.lead(ts).over(w).alias("valid_to")])
    return versions.withColumnRenamed(ts, "valid_from")


def scd2_dim(versions: DataFrame, key: str, sk: str) -> DataFrame:
    """Dimension rows: a surrogate key over (key, valid_from) and a current flag."""
    attributes = [c for c in versions.columns if c not in ("valid_from", "valid_to")]
    return versions.select(
        surrogate_key(key, "valid_from").alias(sk),
        *attributes,
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def asof_lookup(fact: DataFrame, dim: DataFrame, key: str, ts: str, take: str, *, out: str | None = None) -> DataFrame:
    """Append the value of the version that was valid at the row's time.

    Facts and versions are merged in time order, slice by slice, and each fact reads the version that
    started last at or before it (of several that started then, the one that ends last, an open one first), so no (fact,
    version) pairs arise. A fact gets NULL if that version has ended by its time, even where an
    older version is still open. NULL keys and times get NULL.
    """
    out = out or take
    type_of = dict(fact.dtypes)
    version = F.struct(
        F.col("valid_from").alias("start"),
        F.col("valid_to").isNull().alias("open"),
        F.col("valid_to").alias("stop"),
        F.col(take).alias("value"),
    )
    starts = dim.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull()).select(
        F.col(key).cast(type_of[key]).alias("_key"),
        F.col("valid_from").alias("_at"),
        F.lit(0).alias("_late"),
        version.alias("_version"),
        F.lit(None).cast(fact.select(F.struct("*").alias("s")).schema["s"].dataType).alias("_fact"),
        F.lit(0).cast("long").alias("_tie"),
    )
    rows = fact.select(
        F.col(key).alias("_key"),
        F.col(ts).alias("_at"),
        F.lit(1).alias("_late"),
        F.lit(None).cast(starts.schema["_version"].dataType).alias("_version"),
        F.struct(*fact.columns).alias("_fact"),
        F.xxhash64(*fact.columns).alias("_tie"),
    )
    merged = running(
        starts.unionByName(rows),
        ["_key"],
        [F.col("_at"), F.col("_late"), F.col("_tie")],
        {"_seen": Running("max", F.col("_version"))},
        slice_by=F.floor(F.unix_seconds(F.col("_at").cast("timestamp")) / F.lit(SLICE_SECONDS)),
    ).where("_late = 1")
    alive = F.col("_seen.stop").isNull() | (F.col("_at") < F.col("_seen.stop"))
    return merged.select("_fact.*", F.when(alive & F.col("_key").isNotNull() & F.col("_at").isNotNull(), F.col("_seen.value")).alias(out))
