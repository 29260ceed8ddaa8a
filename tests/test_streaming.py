"""Streams land the same rows as batches, and replayed batches change nothing."""

import datetime
import random

from pyspark.sql import functions as F

from tidemark.operators.staging import dedupe_latest
from tidemark.session import new_path
from tidemark.sources import versions
from tidemark.sources.bronze import read_slices, to_bronze
from tidemark.streaming import ingest

STAMP = {"run_id": "r", "ingested_at": "2024-01-01T00:00:00+00:00"}


def drop_files(spark, path, frames):
    for df in frames:
        df.coalesce(1).write.mode("append").parquet(path)


def test_ingest_lands_every_row_once(spark):
    source, sink, log = (new_path(spark, n) for n in ("src", "sink", "log"))
    events = spark.range(90).select("id", (F.col("id") % 3).cast("int").alias("day"), (F.col("id") / 4).alias("v"))
    drop_files(spark, source, [events.where(f"day = {d}") for d in (0, 1)])

    def run():
        stream = ingest.file_stream(spark, source, events.schema, max_files=1)
        ingest.ingest_to_bronze(
            stream, sink, log, endpoint="e", result_set="R", params_from={"day": "day"}, **STAMP
        ).awaitTermination()
        return spark.read.parquet(sink)

    def batch(days):
        return to_bronze(events.where(F.col("day").isin(days)), "e", "R", params_from={"day": "day"}, **STAMP)

    assert run().exceptAll(batch([0, 1])).isEmpty() and run().count() == 60
    drop_files(spark, source, [events.where("day = 2")])
    assert run().count() == 90 and run().exceptAll(batch([0, 1, 2])).isEmpty()


def test_quarantine_replay_replaces_itself(spark):
    source, good, bad = (new_path(spark, n) for n in ("src", "good", "bad"))
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, -1.0)], "id int, v double")
    drop_files(spark, source, [df])
    for _ in range(2):  # a lost log makes the stream start over
        stream = ingest.file_stream(spark, source, df.schema)
        ingest.ingest_quarantined(stream, good, bad, new_path(spark, "log"), {"positive": F.col("v") > 0}).awaitTermination()
        assert [r.id for r in ingest.read_batches(spark, good, df.schema).collect()] == [1]
        assert sorted(r.id for r in spark.read.parquet(bad).collect()) == [2, 3]


def test_slice_stream_replaces_slices(spark):
    source, sink, log = (new_path(spark, n) for n in ("src", "table", "log"))
    schema = "day string, v int"

    def land(rows, run):
        drop_files(spark, source, [to_bronze(spark.createDataFrame(rows, schema), "e", "R", params_from={"day": "day"}, **{**STAMP, "run_id": run})])
        raw = spark.read.parquet(source).schema
        ingest.upsert_slices(ingest.file_stream(spark, source, raw, max_files=1), sink, log, ["_endpoint", "_param_hash"]).awaitTermination()
        return sorted((r.day, r.v, r._run_id) for r in read_slices(spark, sink, raw).collect())

    assert land([("a", 1), ("b", 2)], "r1") == [("a", "1", "r1"), ("b", "2", "r1")]
    assert land([("b", 3)], "r2") == [("a", "1", "r1"), ("b", "3", "r2")]


def test_latest_rows_equal_the_batch_in_any_order_of_files(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(20), datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=rng.randrange(3000)), i) for i in range(400)] + [(None, None, 900), (3, None, 901)]
    df = spark.createDataFrame(rows, "k int, t timestamp, v int")
    order = [F.col("t").desc_nulls_last(), F.col("v").desc()]
    want = sorted(map(tuple, dedupe_latest(df, ["k"], order).collect()), key=repr)
    for seed in (1, 2):
        source, table, late, log = (new_path(spark, n) for n in ("src", "latest", "late", "log"))
        drop_files(spark, source, df.orderBy(F.rand(seed)).randomSplit([0.3, 0.3, 0.4], seed))
        for _ in range(2):  # a second run finds nothing new
            ingest.keep_latest(ingest.file_stream(spark, source, df.schema, max_files=1), table, late, log, ["k"], order, "t", parts=3).awaitTermination()
        assert sorted(map(tuple, versions.read(spark, table, df.schema).collect()), key=repr) == want


def test_late_rows_are_set_apart_and_replays_change_nothing(spark):
    source, table, late, log = (new_path(spark, n) for n in ("src", "latest", "late", "log"))
    day = datetime.datetime
    batches = [[(1, day(2024, 1, 10), 1), (2, day(2024, 1, 1), 2)], [(1, day(2024, 1, 9), 3), (3, day(2024, 1, 2), 4), (4, None, 5), (2, day(2024, 1, 11), 6)]]
    schema = "k int, t timestamp, v int"

    def run(to):
        stream = ingest.file_stream(spark, source, spark.createDataFrame([], schema).schema, max_files=1)
        ingest.keep_latest(stream, table, late, to, ["k"], [F.col("t").desc()], "t", delay="3 days", parts=2).awaitTermination()
        df = spark.createDataFrame([], schema)
        return sorted(r.v for r in versions.read(spark, table, df.schema).collect()), sorted(r.v for r in ingest.read_batches(spark, late, df.schema).collect())

    for rows in batches:
        drop_files(spark, source, [spark.createDataFrame(rows, schema)])
        done = run(log)
    assert done == ([1, 6], [4, 5])
    before = versions.version(spark, table)
    assert run(new_path(spark, "log")) == done and versions.version(spark, table) == before, "all batches come again"
