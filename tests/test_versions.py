"""Tables of versions: publishing, tests before it, conflicts, merges that rewrite few parts."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history
from tidemark.operators.incremental import incremental_merge, merge_parts
from tidemark.operators.quality import RowCheck, SuiteFailed
from tidemark.session import new_path
from tidemark.sources import bronze, versions

SCHEMA = "k long, p string, v int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def stored(spark, path, of=None):
    return sorted((tuple(r) for r in versions.read(spark, path, frame(spark, []).schema, of).collect()), key=repr)


def test_parts_are_replaced_added_and_cleared(spark):
    path, part = new_path(spark, "versions"), F.col("p")
    assert versions.version(spark, path).number == 0 and stored(spark, path) == []
    rows = [(1, "a", 1), (2, "b/c=d %", 1), (3, None, 1), (4, "", 1), (5, "ü", 1)]
    first = versions.replace_parts(frame(spark, rows), path, part)
    assert set(first.parts) == {"a", "b/c=d %", None, "ü"} and stored(spark, path) == sorted(rows, key=repr)
    second = versions.replace_parts(frame(spark, [(9, "b/c=d %", 9)]), path, part, touched=["b/c=d %", None])
    assert stored(spark, path) == sorted([(1, "a", 1), (9, "b/c=d %", 9), (5, "ü", 1)], key=repr)
    assert second.parts["a"] == first.parts["a"] and None not in second.parts
    versions.replace_parts(frame(spark, [(10, "a", 2)]), path, part, add=True, about={"x": 1})
    assert (10, "a", 2) in stored(spark, path) and (1, "a", 1) in stored(spark, path)
    assert stored(spark, path, first) == sorted(rows, key=repr), "older versions stay readable"
    assert versions.version(spark, path).about == {"x": 1}
    with pytest.raises(ValueError):
        versions.replace_parts(frame(spark, [(1, "z", 1)]), path, part, touched=["a"])
    before = stored(spark, path)
    assert versions.expire(spark, path) > 0 and versions.numbers(spark, path) == [3] and stored(spark, path) == before
    versions.replace_parts(frame(spark, []), path, part)
    assert stored(spark, path) == []


def test_failed_and_late_runs_show_nothing(spark):
    path, part = new_path(spark, "versions"), F.col("p")
    first = versions.replace_parts(frame(spark, [(1, "a", 1)]), path, part)

    def tests(df):
        return [RowCheck("v", df, F.col("v") < 0)]

    with pytest.raises(SuiteFailed):
        versions.replace_parts(frame(spark, [(2, "b", -1)]), path, part, touched=["b"], tests=tests)
    assert stored(spark, path) == [(1, "a", 1)]
    second = versions.replace_parts(frame(spark, [(2, "b", 1)]), path, part, touched=["b"], tests=tests)
    with pytest.raises(versions.Conflict):  # it has read the first version
        versions.replace_parts(frame(spark, [(3, "c", 1)]), path, part, touched=["c"], after=first)
    assert versions.version(spark, path) == second and stored(spark, path) == [(1, "a", 1), (2, "b", 1)]
    # folders of runs that never got a number go
    versions.stage(frame(spark, [(7, "x", 7)]), path, part)
    assert versions.expire(spark, path, keep=2) == 1 and stored(spark, path) == [(1, "a", 1), (2, "b", 1)]


def test_slices_with_null_keys(spark):
    path = new_path(spark, "slices")
    schema = "a string, b string, v int"
    first = spark.createDataFrame([(None, None, 1), ("x", None, 2), (None, "y", 3), ("x", "y", 4)], schema)
    for _ in range(2):
        bronze.write_slices(first, path, keys=["a", "b"], parts=3)
    bronze.write_slices(spark.createDataFrame([(None, None, 9), (None, None, 10)], schema), path, keys=["a", "b"])
    got = sorted(r.v for r in bronze.read_slices(spark, path, first.schema).collect())
    assert got == [2, 3, 4, 9, 10] and versions.version(spark, path).about == {"parts": 3}


def test_merge_equals_the_whole_rewrite(spark):
    path = new_path(spark, "merge")
    schema = "k int, d date, v int"
    day = datetime.date
    target = [(i, day(2024, 1 + i % 4, 1 + i % 28), 0) for i in range(200)] + [(None, day(2024, 2, 2), 0)]
    source = [(i, day(2024, 4, 20 + i % 10), i) for i in range(0, 300, 7)] + [(None, day(2024, 4, 30), 5), (1, day(2024, 1, 1), 99), (500, None, 1), (500, None, 1)]
    target, source = spark.createDataFrame(target, schema), spark.createDataFrame(source, schema)
    month = F.date_format("d", "yyyy-MM")
    first = merge_parts(target, path, ["k"], "d", month)
    assert sorted(first.parts, key=str) == ["2024-01", "2024-02", "2024-03", "2024-04"] and first.about["mark"] == "2024-04-28"
    want = sorted((tuple(r) for r in incremental_merge(target, source, ["k"], "d", lookback_days=5).collect()), key=repr)
    second = merge_parts(source, path, ["k"], "d", month, lookback_days=5)
    assert sorted((tuple(r) for r in versions.read(spark, path, target.schema).collect()), key=repr) == want
    assert second.about["mark"] == "2024-04-30" and set(second.parts) == {*first.parts, None}
    # a new key in a new month touches that month alone
    third = merge_parts(spark.createDataFrame([(900, day(2024, 6, 1), 1)], schema), path, ["k"], "d", month)
    assert {p for p in third.parts if third.parts[p] != second.parts.get(p)} == {"2024-06"}
    assert versions.read(spark, path, target.schema).count() == len(want) + 1


def test_first_merge_of_nothing(spark):
    path = new_path(spark, "merge")
    empty = spark.createDataFrame([], "k int, d date, v int")
    assert merge_parts(empty, path, ["k"], "d", F.col("d")).parts == {}
    assert versions.read(spark, path, empty.schema).count() == 0


def history_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_history_by_storage(spark):
    """The same versions as rewriting all, but only parts with changes are written, and closed versions never again."""
    path, day = new_path(spark, "history"), datetime.date
    names = "k long, name string, team string, seen int"
    first = [(i, f"n{i}", "a", 1) for i in range(300)]
    second = [(i, f"n{i}", "b" if i in (7, 8) else "a", 2) for i in range(299)]
    third = [(i, None if i == 7 else f"n{i}", "b" if i in (7, 8) else "a", 3) for i in range(300)] + [(900, "new", None, 3)]
    current, kept = None, []
    for n, rows in enumerate((first, second, second, third), 1):
        df, ts = spark.createDataFrame(rows, names), F.lit(day(2024, n, 1)).cast("date")
        current = history.scd2_apply(current, df, "k", ["name", "team"], ts).cache()
        kept.append(history.scd2_store(df, path, "k", ["name", "team"], ts, buckets=16))
        stored = versions.read(spark, path, current.schema)
        assert history_rows(stored) == history_rows(current)
    opened = [{p: f for p, f in v.parts.items() if p.startswith("open")} for v in kept]
    closed = [{p: f for p, f in v.parts.items() if p.startswith("closed")} for v in kept]
    assert len(opened[0]) == 16 and 1 <= sum(opened[0][p] != opened[1][p] for p in opened[0]) <= 2
    assert opened[1] == opened[2] and [len(c) for c in closed] == [0, 1, 1, 2]
    assert all(closed[3][p] == f for p, f in closed[1].items())


def test_interleaved_files_skip_by_either_column(spark):
    path = new_path(spark, "interleaved")
    df = spark.range(40_000).select((F.col("id") % 200).alias("a"), F.expr("date_add(date '2020-01-01', cast(id / 200 as int))").alias("b"), F.concat(F.lit("n"), F.col("id") % 100).alias("c"))
    df = df.unionByName(df.limit(3).select(F.lit(None).cast("long").alias("a"), F.lit(None).cast("date").alias("b"), F.lit(None).cast("string").alias("c")))
    bronze.write_interleaved(df, path, ["a", "b"], files=16)
    assert bronze.read_table(spark, path, df.schema).exceptAll(df).isEmpty() and bronze.read_table(spark, path, df.schema).count() == 40_003
    for column, low, high in (("a", 10, 12), ("b", datetime.date(2020, 3, 1), datetime.date(2020, 3, 4))):
        r = bronze.files_read(spark, path, df.schema, column, low, high).first()
        assert r.files == 16 and r.read <= 9
    # sorted by the first column alone, every file has all values of the second
    linear = new_path(spark, "linear")
    df.repartitionByRange(16, "a", "b").sortWithinPartitions("a", "b").write.parquet(linear)
    assert bronze.files_read(spark, linear, df.schema, "b", datetime.date(2020, 3, 1), datetime.date(2020, 3, 4)).first().read >= 15
    text = new_path(spark, "interleaved")
    bronze.write_interleaved(df, text, ["c", "a"], files=8)
    assert bronze.files_read(spark, text, df.schema, "c", "n1", "n1").first().read <= 6
    empty = new_path(spark, "interleaved")
    bronze.write_interleaved(df.limit(0), empty, ["a", "b"], files=4)
    assert bronze.read_table(spark, empty, df.schema).count() == 0


def test_bucketed_tables_join_without_a_shuffle(spark):
    name = new_path(spark, "b").rpartition("-")[2]
    left = spark.range(5000).select((F.col("id") % 900).alias("game"), "id")
    facts = bronze.write_bucketed(left, f"l{name}", new_path(spark, "bucketed"), "game", buckets=6)
    games = bronze.write_bucketed(spark.range(900).withColumnRenamed("id", "game"), f"r{name}", new_path(spark, "bucketed"), "game", buckets=6)
    joined = facts.hint("merge").join(games.hint("merge"), "game").groupBy("game").count()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert joined.count() == 900 and joined.agg(F.sum("count")).first()[0] == 5000
