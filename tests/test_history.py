"""Type-2 history: replays, reappearing values, NULL changes, missing keys."""

import datetime

from pyspark.sql import functions as F

from tidemark.operators import history
from tidemark.session import cut_lineage

SCHEMA = "id long, name string, city string, note string"


def ts(day):
    return F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp")


def at(day):
    return datetime.datetime(2024, 1, day)


def apply(spark, current, rows, day):
    return cut_lineage(
        history.scd2_apply(current, spark.createDataFrame(rows, SCHEMA), "id", ["name", "city"], ts(day))
    )


def versions(df):
    return sorted(((r.id, r.name, r.city, r.note, r.valid_from, r.valid_to) for r in df.collect()), key=repr)


def test_first_run_opens_all(spark):
    v = apply(spark, None, [(1, "a", "x", "n")], 1)
    assert versions(v) == [(1, "a", "x", "n", at(1), None)]


def test_life_of_versions(spark):
    v = apply(spark, None, [(1, "a", "x", "n"), (2, "b", None, "n"), (3, "c", "z", "n")], 1)
    # a change; NULL to NULL is none; an unchecked column alone is none; a key goes missing; a new one comes
    v = apply(spark, v, [(1, "a", "y", "m"), (2, "b", None, "m"), (4, "d", None, "n")], 2)
    assert versions(v) == sorted(
        [
            (1, "a", "x", "n", at(1), at(2)),
            (1, "a", "y", "m", at(2), None),
            (2, "b", None, "n", at(1), None),
            (3, "c", "z", "n", at(1), None),
            (4, "d", None, "n", at(2), None),
        ],
        key=repr,
    )
    # the old value returns; NULL becomes a value; the missing key is back unchanged
    v = apply(spark, v, [(1, "a", "x", "o"), (2, "b", "w", "o"), (3, "c", "z", "o")], 3)
    got = versions(v)
    assert (1, "a", "x", "o", at(3), None) in got and (1, "a", "y", "m", at(2), at(3)) in got
    assert (2, "b", None, "n", at(1), at(3)) in got and (2, "b", "w", "o", at(3), None) in got
    assert (3, "c", "z", "n", at(1), None) in got
    assert len(got) == 7


def test_replay_changes_nothing(spark):
    rows = [(1, "a", "x", "n"), (2, "b", None, "n")]
    once = apply(spark, None, rows, 1)
    assert versions(apply(spark, once, rows, 2)) == versions(once)


def test_dim_marks_current_and_hashes_version(spark):
    v = apply(spark, apply(spark, None, [(1, "a", "x", "n")], 1), [(1, "b", "x", "n")], 2)
    dim = {r.name: r for r in history.scd2_dim(v, "id", "sk").collect()}
    assert (dim["a"].is_current, dim["b"].is_current) == (False, True)
    assert dim["a"].sk != dim["b"].sk


def test_history_of_a_log(spark):
    log = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "a"), (1, 3, None), (1, 4, None), (1, 5, "a"), (2, 1, None)], "id int, t int, v string"
    )
    got = sorted(map(tuple, history.scd2_history(log, "id", ["v"], "t").select("id", "valid_from", "valid_to", "v").collect()))
    assert got == [(1, 1, 3, "a"), (1, 3, 5, None), (1, 5, None, "a"), (2, 1, None, None)]


def test_asof_bounds(spark):
    dim = spark.createDataFrame([(1, 10, 20, "a"), (1, 20, None, "b"), (2, 5, 7, "c")], "k int, valid_from int, valid_to int, sk string")
    fact = spark.createDataFrame([(1, 9), (1, 10), (1, 19), (1, 20), (1, 99), (2, 7), (2, 6), (3, 1), (None, 1)], "k int, t int")
    want = [(1, 9, None), (1, 10, "a"), (1, 19, "a"), (1, 20, "b"), (1, 99, "b"), (2, 6, "c"), (2, 7, None), (3, 1, None), (None, 1, None)]
    got = history.asof_lookup(fact, dim, "k", "t", "sk")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
