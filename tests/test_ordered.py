"""Sliced and plain ordered operators give what windows over whole groups give."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.efficiency import point_in_time_features, rolling_splits, stint_intervals
from tidemark.operators.history import asof_lookup, scd2_history
from tidemark.operators.ordered import Running, framed, running, sequence_within
from tidemark.operators.staging import event_sequence


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, another third without a key."""
    rng = random.Random(3)
    rows = []
    for i in range(1500):
        key = "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{rng.randrange(40)}"
        rows.append((key, rng.randrange(300), i, rng.choice([None, 1, 2, 3, 4, 5])))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "key string, at int, id int, v int").cache()


def order():
    return [F.col("at").desc(), F.col("id")]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("width", [1, 7, 500])
def test_running_over_slices(skewed, width):
    measures = {"s": Running("sum", F.col("v")), "m": Running("max", F.struct("v", "id"))}
    window = Window.partitionBy("key").orderBy(*order()).rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.select("*", F.sum("v").over(window).alias("s"), F.max(F.struct("v", "id")).over(window).alias("m"))
    assert rows_of(running(skewed, ["key"], order(), measures)) == rows_of(want)
    assert rows_of(running(skewed, ["key"], order(), measures, slice_by=F.floor(-F.col("at") / width))) == rows_of(want)


def test_sequence_and_frames(skewed):
    want = skewed.select("*", F.row_number().over(Window.partitionBy("key").orderBy(*order())).alias("n"))
    assert rows_of(sequence_within(skewed, ["key"], order(), "n")) == rows_of(want)

    def columns(w):
        return [F.lag("id").over(w).alias("before"), F.sum("v").over(w.rowsBetween(-4, 1)).alias("s")]

    want = skewed.select("*", *columns(Window.partitionBy("key").orderBy(*order())))
    assert rows_of(framed(skewed, ["key"], order(), columns)) == rows_of(want)


def test_event_sequence_drops_copies(skewed):
    plain = event_sequence(skewed.union(skewed), ["key"], ["at"])
    assert plain.count() == skewed.count() == plain.select("key", "action_seq").distinct().count()


def test_asof_equals_brute_force(spark, skewed):
    facts = skewed.select("key", F.date_add(F.lit("2020-01-01").cast("date"), F.col("at")).alias("day"), "id")
    rng = random.Random(8)
    versions = []
    for key in ("hot", "k1", "k2", "k3"):
        for i in range(60):  # overlapping, short and open versions, far more than 32 of a key
            start = rng.randrange(320)
            versions.append((key, start, None if rng.random() < 0.2 else start + rng.randrange(1, 90), f"{key}-{i}"))
    versions += [(None, 0, None, "none"), ("k1", None, None, "undated")]
    day = lambda c: F.date_add(F.lit("2020-01-01").cast("date"), F.col(c))
    dim = spark.createDataFrame(versions, "key string, a int, b int, v string").select("key", day("a").alias("valid_from"), day("b").alias("valid_to"), "v")
    want = []
    for key, at, i, _ in skewed.collect():
        started = [x for x in versions if x[0] == key and key is not None and x[1] is not None and x[1] <= at]
        last = max(started, key=lambda x: (x[1], x[2] is None, x[2] or 0, x[3]), default=None)
        want.append((i, last[3] if last and (last[2] is None or at < last[2]) else None))
    got = asof_lookup(facts, dim, "key", "day", "v", out="seen").select("id", "seen")
    assert rows_of(got) == sorted(want, key=repr)


def test_stints_equal_brute_force(skewed):
    presence = skewed.select(
        F.coalesce("key", F.lit("none")).alias("game"), "id", "at", (F.col("at") + F.coalesce("v", F.lit(0))).alias("out")
    )
    plain = stint_intervals(presence, "game", "id", "at", "out")
    brute = {}
    for game, member, start, stop in presence.collect():
        for t in range(start, stop):
            brute.setdefault((game, t), set()).add(member)
    got = {}
    for game, _, start, stop, lineup in plain.collect():
        for t in range(start, stop):
            got[(game, t)] = set(lineup)
    assert got == brute


def test_nothing_runs_while_planning(spark, skewed):
    """No operator here starts a job before its result is asked for."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "")
    log = skewed.groupBy(F.coalesce("key", F.lit("none")).alias("key"), "at").agg(F.max("v").alias("v"))
    history = scd2_history(log, "key", ["v"], "at")
    games = skewed.selectExpr("coalesce(key, 'none') AS team", "id % 3 AS opponent", "date_add('2020-01-01', at) AS day", "at % 2 AS season", "id", "v AS points", "v % 2 AS won")
    rolling_splits(games, "team", "season", ["day", "id"], "points")
    point_in_time_features(games, "team", "opponent", "day", ["day", "id"], "points", "won")
    event_sequence(skewed, ["key"], ["at"])
    asof_lookup(skewed.selectExpr("key", "date_add('2020-01-01', at) AS day"), history.selectExpr("key", "date_add('2020-01-01', valid_from) AS valid_from", "CAST(NULL AS date) AS valid_to", "v"), "key", "day", "v")
    assert not tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
