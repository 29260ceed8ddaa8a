"""Raw loads: slice replacement in memory and on disk, control table, contract, merges."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.incremental import incremental_merge
from tidemark.session import new_path, shared_dir
from tidemark.sources import bronze

STAMP = {"run_id": "r", "ingested_at": "2024-01-01T00:00:00+00:00"}


def landed(spark, rows, run="r"):
    df = spark.createDataFrame(rows, "day string, v int")
    return bronze.to_bronze(df, "e", "R", params_from={"day": "day"}, **{**STAMP, "run_id": run})


def content(df):
    return sorted((r.day, r.v, r._run_id) for r in df.collect())


def test_all_columns_are_text_with_lineage(spark):
    df = bronze.to_bronze(spark.range(1).select("id", F.lit(2.0).alias("d")), "e", "R", {"b": 1, "a": "x"}, **STAMP)
    assert df.columns == ["id", "d", *bronze.LINEAGE]
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}
    row = df.first()
    assert (row.id, row.d, row._params_json) == ("0", "2.0", '{"a": "x", "b": 1}')
    assert bronze.raw_table_name("e", "R") == "e__R"


def test_replace_append_and_empty_slice(spark):
    old = landed(spark, [("d1", 1), ("d1", 2), ("d2", 3), ("d3", 4)])
    new = landed(spark, [("d2", 9)], "s")
    assert content(bronze.slice_upsert(old, new)) == [("d1", "1", "r"), ("d1", "2", "r"), ("d2", "9", "s"), ("d3", "4", "r")]
    assert bronze.slice_upsert(old, new, replace=False).count() == 5
    # a slice that came back empty still clears its earlier rows
    fetched = landed(spark, [("d2", 0), ("d3", 0)])
    cleared = bronze.slice_upsert(old, new, slices=fetched)
    assert content(cleared) == [("d1", "1", "r"), ("d1", "2", "r"), ("d2", "9", "s")]


def test_written_slices_are_idempotent(spark):
    path = new_path(spark, "test-slices")
    bronze.write_slices(landed(spark, [("d1", 1), ("d2", 2)]), path)
    for _ in range(2):
        bronze.write_slices(landed(spark, [("d2", 7), ("d2", 8)], "s"), path)
    schema = landed(spark, [("d1", 1)]).schema
    assert content(bronze.read_slices(spark, path, schema)) == [("d1", "1", "r"), ("d2", "7", "s"), ("d2", "8", "s")]
    bronze.write_slices(landed(spark, [("d3", 5)]), path, replace=False)
    assert bronze.read_slices(spark, path, schema).count() == 4
    # a slice that came back empty is cleared, and hashes of digits keep their type
    fetched = landed(spark, [("d1", 0), ("d2", 0)])
    bronze.write_slices(fetched.limit(0), path, slices=fetched)
    left = bronze.read_slices(spark, path, schema)
    assert content(left) == [("d3", "5", "r")] and left.dtypes == spark.createDataFrame([], schema).dtypes


def test_another_column_set_is_refused(spark):
    old = landed(spark, [("d1", 1)])
    extra = bronze.to_bronze(spark.sql("select 'd2' day, 1 v, 2 w"), "e", "R", params_from={"day": "day"}, **STAMP)
    with pytest.raises(Exception, match="(?i)column"):
        bronze.slice_upsert(old, extra).collect()


def test_control_table(spark):
    schema = "endpoint string, param_hash string, season string, result_count int, status string, updated_at int"
    state = spark.createDataFrame(
        [("e", "a", "s", 1, "failed:X", 1), ("e", "a", "s", 2, "done", 2), ("e", "b", "s", 0, "empty", 1), ("e", "c", "s", 0, "failed:X", 1)],
        schema,
    )
    last = bronze.latest_state(state)
    assert sorted((r.param_hash, r.status) for r in last.collect()) == [("a", "done"), ("b", "empty"), ("c", "failed:X")]
    plan = spark.createDataFrame([("e", "a"), ("e", "b"), ("e", "c"), ("e", "d"), ("f", "a")], "endpoint string, param_hash string")
    pending = bronze.pending_slices(plan, last)
    assert sorted(map(tuple, pending.collect())) == [("e", "c"), ("e", "d"), ("f", "a")]
    only_done = bronze.pending_slices(plan, last, resolved=("done",))
    assert only_done.count() == 4
    marked = bronze.mark_state(last, spark.createDataFrame([("e", "c", "s", 5, "done", 9)], schema))
    assert sorted((r.param_hash, r.status) for r in marked.collect()) == [("a", "done"), ("b", "empty"), ("c", "done")]


def test_slice_plan(spark):
    teams = spark.createDataFrame([(1,), (2,), (1,)], "team int")
    got = sorted(map(tuple, bronze.slice_plan(teams, "team", ["2022-23", "2023-24"]).collect()))
    assert got == [(1, "2022-23"), (1, "2023-24"), (2, "2022-23"), (2, "2023-24")]


def test_contract(spark):
    declared = bronze.contract_rows(spark, {"e": {"R": ["a", "b"], "S": []}, "f": {"R": ["c"]}})
    s = bronze.contract_summary(declared).first()
    assert (s.endpoints, s.result_sets, s.bronze_tables) == (2, 3, 3)
    assert bronze.contract_duplicates(declared).isEmpty()
    assert [r.table_name for r in bronze.contract_duplicates(declared.union(declared.limit(1))).collect()] == ["e__R"]
    actual = spark.createDataFrame([("e__R", "a"), ("e__R", "z"), ("f__R", "c")], "table_name string, column_name string")
    got = {(r.table_name, r.column_name): r.status for r in bronze.contract_coverage(bronze.contract_columns(declared), actual).collect()}
    assert got == {("e__R", "a"): "present", ("e__R", "b"): "missing", ("e__R", "z"): "undeclared", ("f__R", "c"): "present"}


def test_rescued_columns(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": 1}',), ("not json",), (None,)], "raw string")
    got = [r._rescued_data for r in bronze.rescue_columns(df, "raw", ["a"]).collect()]
    assert got == ['{"b":"x"}', None, None, None]


def test_incremental_merge(spark):
    schema = "k int, d string, v int"
    target = spark.createDataFrame([(1, "2024-01-01", 1), (2, "2024-01-02", 1)], schema)
    source = spark.createDataFrame([(1, "2024-01-01", 9), (2, "2024-01-02", 9), (3, "2024-01-02", 9), (4, "2024-01-03", 9)], schema)

    def merged(**kw):
        return sorted((r.k, r.v) for r in incremental_merge(target, source, ["k"], "d", **kw).collect())

    assert merged() == [(1, 1), (2, 1), (4, 9)]
    assert merged(lookback_days=1) == [(1, 1), (2, 9), (3, 9), (4, 9)]
    assert incremental_merge(target.limit(0), source, ["k"], "d").count() == 4
    again = incremental_merge(target, source, ["k"], "d", lookback_days=1)
    assert sorted(map(tuple, incremental_merge(again, source, ["k"], "d", lookback_days=1).collect())) == sorted(map(tuple, again.collect()))


def test_clustered_write_and_snapshot(spark):
    path = new_path(spark, "test-clustered")
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), "id", F.array("id").alias("a"))
    bronze.write_clustered(df, path, ["g"])
    back = bronze.read_table(spark, path, df.schema)
    assert back.count() == 1000 and back.where("g = 3").count() == 143
    saved = new_path(spark, "test-snapshot")
    first = bronze.snapshot(df.where("g = 1"), saved, refresh=True)
    offline = bronze.snapshot(df.where("g = 1"), saved, refresh=False)
    assert first.schema == offline.schema and offline.count() == 143


def test_shared_folder_is_the_sessions(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    assert named is None or shared_dir(spark) == named
    assert new_path(spark, "a") != new_path(spark, "a")
