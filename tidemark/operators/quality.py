"""Data tests: each returns the violating rows, and a suite fails closed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rates import ratio


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs do not count."""
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once; NULLs are equal to each other."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def relationship(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows with a value that no parent has."""
    keys = parent.select(F.col(parent_column).alias("_parent"))
    known = child.where(F.col(column).isNotNull())
    return known.join(keys, known[column] == keys["_parent"], "left_anti")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Unexpected values with their counts; NULL passes."""
    return df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def accepted_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows outside the inclusive range; NULL passes."""
    return df.where(outside(column, low, high))


def outside(column: str, low=None, high=None) -> Column:
    """True for values outside the inclusive range."""
    tests = [F.col(column) < low] if low is not None else []
    tests += [F.col(column) > high] if high is not None else []
    if not tests:
        raise ValueError("a range needs a lower or an upper bound")
    return reduce(lambda a, b: a | b, tests)


def rows_per_key(df: DataFrame, key: str, expected: int) -> DataFrame:
    """Keys with another number of rows than expected."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("team_rows")).where(F.col("team_rows") != expected)


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], a: str, b: str) -> DataFrame:
    """Keys present on both sides whose measures differ; NULL measures are not reported."""
    both = left.select(*keys, a).join(right.select(*keys, b), list(keys))
    return both.where(F.col(a) != F.col(b))


def reconcile_sum(
    detail: DataFrame, summary: DataFrame, keys: Sequence[str], measure: str, total: str, *, as_name: str, total_name: str
) -> DataFrame:
    """Summed detail against the summary rows."""
    sums = detail.groupBy(*keys).agg(F.sum(measure).alias(as_name))
    return reconcile(sums, summary.withColumnRenamed(total, total_name), keys, as_name, total_name)


def reconcile_count(
    detail: DataFrame, other: DataFrame, keys: Sequence[str], flag: str, measure: str, *, as_name: str, total_name: str
) -> DataFrame:
    """Rows with a flag, counted, against another table's summed measure."""
    counts = detail.groupBy(*keys).agg(F.count_if(F.col(flag)).alias(as_name))
    sums = other.groupBy(*keys).agg(F.sum(measure).alias(total_name))
    return reconcile(counts, sums, keys, as_name, total_name)


def freshness(df: DataFrame, ts: str, now: Column, max_hours: int = 24, by: Sequence[str] = ()) -> DataFrame:
    """Groups whose latest row is older than allowed, or that have none."""
    last = df.groupBy(*by).agg(F.max(ts).alias("last_loaded"))
    return last.where(F.col("last_loaded").isNull() | (F.col("last_loaded") < now - F.expr(f"interval {max_hours} hours")))


def row_count_band(df: DataFrame, by: Sequence[str], low: int, high: int) -> DataFrame:
    """Groups whose number of rows is outside the band."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where(~F.col("n").between(low, high))


def profile(df: DataFrame, period: str, columns: Sequence[str]) -> DataFrame:
    """Rows, null rates and means per period."""
    rows = F.count(F.lit(1))
    measures = []
    for c in columns:
        measures += [
            ratio(F.count_if(F.col(c).isNull()), rows).alias(f"{c}_null_rate"),
            F.avg(c).alias(f"{c}_mean"),
        ]
    return df.groupBy(period).agg(rows.alias("n"), *measures)


def profile_drift(df: DataFrame, period: str, columns: Sequence[str], before: Column) -> DataFrame:
    """The profile with its change against the period ``before`` (an expression of ``period``).

    Changes are NULL where that period has no rows. Periods are joined, so that a fine period fits too.
    """
    stats = profile(df, period, columns)
    watched = ["n", *[f"{c}_{m}" for c in columns for m in ("null_rate", "mean")]]
    earlier = stats.select(F.col(period).alias("_period"), *[F.col(c).alias(f"_{c}") for c in watched])
    joined = stats.withColumn("_before", before).join(earlier, F.col("_before") == F.col("_period"), "left")
    return joined.select(*stats.columns, *[(F.col(c) - F.col(f"_{c}")).alias(f"{c}_change") for c in watched])


def quantile_edges(df: DataFrame, column: str, bins: int) -> list[float]:
    """Distinct inner edges at approximate quantiles: at most ``bins`` - 1 numbers reach the driver."""
    found = df.agg(F.percentile_approx(F.col(column).cast("double"), [i / bins for i in range(1, bins)], 100 * bins)).first()[0]
    return sorted(set(found or []))


def histograms(df: DataFrame, period: str, edges: dict[str, Sequence[float]]) -> DataFrame:
    """(period, <column>_hist, <column>_nulls): rows in each interval of the column, by one partial aggregate.

    An interval reaches from an edge up to, not including, the next one; the first and the last are open. NULL
    and NaN are counted apart. Histograms of parts of the data add up.
    """
    measures = []
    for c, inner in edges.items():
        value = F.col(c).cast("double")
        known = value.isNotNull() & ~F.isnan(value)
        place = sum((F.when(value >= float(e), 1).otherwise(0) for e in inner), F.lit(0))
        measures.append(F.array(*[F.count_if(known & (place == i)) for i in range(len(inner) + 1)]).alias(f"{c}_hist"))
        measures.append(F.count_if(~F.coalesce(known, F.lit(False))).alias(f"{c}_nulls"))
    return df.groupBy(period).agg(*measures)


def _stability(p: Column, q: Column) -> Column:
    """The population stability index of two histograms, with half a row more in each interval."""

    def shares(h: Column) -> Column:
        total = F.aggregate(h, F.lit(0.0), lambda s, x: s + x) + F.size(h) * 0.5
        return F.transform(h, lambda x: (x + 0.5) / total)

    terms = F.zip_with(shares(p), shares(q), lambda x, y: (x - y) * F.log(x / y))
    return F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)


def _largest_gap(p: Column, q: Column, bins: int) -> Column:
    """The largest difference of two cumulative distributions at the edges; NULL where one has no rows."""

    def until(h: Column, i: int) -> Column:
        return ratio(sum((F.get(h, F.lit(k)) for k in range(i + 1)), F.lit(0)), sum((F.get(h, F.lit(k)) for k in range(bins)), F.lit(0)))

    gaps = [F.abs(until(p, i) - until(q, i)) for i in range(bins - 1)]
    return F.greatest(*gaps) if len(gaps) > 1 else gaps[0] if gaps else F.lit(0.0)


def distribution_drift(df: DataFrame, period: str, edges: dict[str, Sequence[float]], before: Column, alarm: float = 0.2) -> DataFrame:
    """How far each column's distribution is from that in the period ``before`` (an expression of ``period``).

    (period, and for each column its histogram, <column>_psi, <column>_ks and <column>_drifted): the population stability
    index, the Kolmogorov-Smirnov distance at the edges, and whether the index is above ``alarm``. NULL where the
    other period has no rows. Periods are joined, so that a fine period fits too.
    """
    stats = histograms(df, period, edges)
    earlier = stats.select(F.col(period).alias("_period"), *[F.col(f"{c}_hist").alias(f"_{c}") for c in edges])
    joined = stats.withColumn("_before", before).join(earlier, F.col("_before") == F.col("_period"), "left")
    out = []
    for c, inner in edges.items():
        there = F.col(f"_{c}").isNotNull()
        psi = F.when(there, _stability(F.col(f"{c}_hist"), F.col(f"_{c}")))
        gap = F.when(there, _largest_gap(F.col(f"{c}_hist"), F.col(f"_{c}"), len(inner) + 1))
        out += [psi.alias(f"{c}_psi"), gap.alias(f"{c}_ks"), (psi > alarm).alias(f"{c}_drifted")]
    return joined.select(*stats.columns, *out)


def quarantine_split(df: DataFrame, expectations: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows meeting every expectation, other rows with the names of those they fail).

    An expectation that is NULL for a row is not met.
    """
    failed = F.filter(
        F.array(*[F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in expectations.items()]),
        lambda x: x.isNotNull(),
    )
    tagged = df.withColumn("_failed", failed)
    return tagged.where(F.size("_failed") == 0).drop("_failed"), tagged.where(F.size("_failed") > 0)


class Check(NamedTuple):
    name: str
    violations: DataFrame
    severity: str = "error"


class RowCheck(NamedTuple):
    """A check of single rows: those of ``table`` for which ``broken`` is true violate it."""

    name: str
    table: DataFrame
    broken: Column
    severity: str = "error"


class SuiteFailed(RuntimeError):
    """A check of severity 'error' has violating rows."""


def _row_counts(checks: Sequence[RowCheck]) -> list[DataFrame]:
    """The counts of row checks, one aggregate per table."""
    tables: dict[int, list[RowCheck]] = {}
    for c in checks:
        tables.setdefault(id(c.table), []).append(c)
    out = []
    for own in tables.values():
        counted = own[0].table.agg(*[F.count_if(c.broken).alias(f"c{i}") for i, c in enumerate(own)])
        rows = [F.struct(F.lit(c.name).alias("name"), F.lit(c.severity).alias("severity"), F.col(f"c{i}").alias("failing_rows")) for i, c in enumerate(own)]
        out.append(counted.select(F.explode(F.array(*rows)).alias("x")).select("x.*"))
    return out


def run_suite(checks: Sequence[Check | RowCheck], *, raise_on_error: bool = True) -> DataFrame:
    """(name, severity, failing_rows) of all checks, counted in one job.

    All checks of a table's single rows share one scan. Raises before any dependent step can run
    if an error-level check fails; only one counter per check reaches the driver.
    """
    first = checks[0]
    spark = (first.table if isinstance(first, RowCheck) else first.violations).sparkSession
    counts = _row_counts([c for c in checks if isinstance(c, RowCheck)])
    counts += [
        c.violations.agg(F.count(F.lit(1)).alias("failing_rows")).select(
            F.lit(c.name).alias("name"), F.lit(c.severity).alias("severity"), "failing_rows"
        )
        for c in checks
        if isinstance(c, Check)
    ]
    rows = reduce(DataFrame.unionByName, counts).collect()
    bad = [r for r in rows if r.severity == "error" and r.failing_rows]
    if bad and raise_on_error:
        raise SuiteFailed("; ".join(f"{r.name}: {r.failing_rows} rows" for r in bad))
    return spark.createDataFrame(rows, "name string, severity string, failing_rows long")
