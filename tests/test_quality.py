"""Data tests: NULL rules, and a suite that fails closed."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality, star


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(1, "a", 0.5), (1, "a", 1.0), (2, None, 1.5), (3, None, None)], "k int, s string, v double")


def test_nulls(df):
    assert quality.not_null(df, "s").count() == 2
    # NULLs are not duplicates of a unique column, but are equal within a combination
    assert [tuple(r) for r in quality.unique(df, "s").collect()] == [("a", 2)]
    assert sorted(map(tuple, quality.unique_combination(df, ["s"]).collect()), key=repr) == [("a", 2), (None, 2)]
    assert quality.accepted_values(df, "s", ["b"]).count() == 1
    assert quality.accepted_values(df, "s", ["a"]).isEmpty()


def test_range_is_inclusive_and_null_passes(df):
    assert [r.k for r in quality.accepted_range(df, "v", 0.5, 1.0).collect()] == [2]
    assert quality.accepted_range(df, "v", low=0.6).count() == 1
    with pytest.raises(ValueError):
        quality.accepted_range(df, "v")


def test_relationship(spark, df):
    parent = spark.createDataFrame([("b",), (None,)], "s string")
    assert quality.relationship(df, "s", parent, "s").count() == 2


def test_rows_per_key(df):
    assert sorted(map(tuple, quality.rows_per_key(df, "k", 2).collect())) == [(2, 1), (3, 1)]


def test_reconciliation_reports_only_both_sided_known_differences(spark):
    detail = spark.createDataFrame([(1, 2, True), (1, 3, None), (2, None, True), (3, 1, False)], "k int, v int, f boolean")
    total = spark.createDataFrame([(1, 6), (2, 1), (4, 1), (3, 1)], "k int, t int")
    sums = quality.reconcile_sum(detail, total, ["k"], "v", "t", as_name="a", total_name="b")
    assert [tuple(r) for r in sums.collect()] == [(1, 5, 6)]
    counts = quality.reconcile_count(detail, total, ["k"], "f", "t", as_name="a", total_name="b")
    assert sorted(map(tuple, counts.collect())) == [(1, 1, 6), (3, 0, 1)]


def test_suite_fails_closed(df):
    checks = [
        quality.Check("s known", quality.not_null(df, "s"), "warn"),
        quality.Check("k known", quality.not_null(df, "k")),
    ]
    got = {r.name: (r.severity, r.failing_rows) for r in quality.run_suite(checks).collect()}
    assert got == {"s known": ("warn", 2), "k known": ("error", 0)}
    with pytest.raises(quality.SuiteFailed, match="k unique: 1 rows"):
        quality.run_suite([*checks, quality.Check("k unique", quality.unique(df, "k"))])


def test_freshness_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "t timestamp")
    assert quality.freshness(empty, "t", F.current_timestamp()).count() == 1


def test_quarantine_is_complete_and_null_safe(df):
    good, bad = quality.quarantine_split(df, {"v": F.col("v") < 1.2, "s": F.col("s").isNotNull()})
    assert good.count() == 2
    assert sorted((r.k, tuple(r._failed)) for r in bad.collect()) == [(2, ("v", "s")), (3, ("v", "s"))]


def test_distribution_drift(spark):
    nan = float("nan")
    rows = [(1, float(v)) for v in range(10)] + [(2, float(v)) for v in range(10)] + [(3, 9.0)] * 10 + [(3, None), (3, nan)] + [(5, 1.0)]
    df = spark.createDataFrame(rows, "day int, v double")
    found = {r.day: r for r in quality.distribution_drift(df, "day", {"v": [2, 5]}, F.col("day") - 1).collect()}
    assert {d: (r.v_hist, r.v_nulls) for d, r in found.items()} == {1: ([2, 3, 5], 0), 2: ([2, 3, 5], 0), 3: ([0, 0, 10], 2), 5: ([1, 0, 0], 0)}
    assert (found[2].v_psi, found[2].v_ks, found[2].v_drifted) == (0.0, 0.0, False)
    assert found[3].v_drifted and abs(found[3].v_ks - 0.5) < 1e-12
    assert found[1].v_psi is None and found[5].v_drifted is None
    assert quality.quantile_edges(df.where("day = 1"), "v", 2) == [4.0]
    assert quality.quantile_edges(df.limit(0), "v", 4) == []
    one = quality.distribution_drift(df, "day", {"v": []}, F.col("day") - 1).where("day = 2").first()
    assert (one.v_hist, one.v_psi, one.v_ks) == ([10], 0.0, 0.0)


def test_repeated_sides_multiply(spark):
    rows = [(1, True, "h", 5), (1, True, "h", 5), (1, False, "a", 7), (2, True, "x", 1), (3, True, "y", 2), (3, False, "z", 3)]
    sides = spark.createDataFrame(rows, "game int, is_home boolean, team string, points int")
    got = sorted((r.game, r.team, r.opp_points) for r in star.opponent_columns(sides, "game", "is_home", ["points"]).collect())
    assert got == [(1, "a", 5), (1, "a", 5), (1, "h", 7), (1, "h", 7), (3, "y", 3), (3, "z", 2)]
