"""Streams over arriving files: append-only raw tables, quarantine and slice replacement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators.quality import quarantine_split
from tidemark.operators.staging import dedupe_latest
from tidemark.sources import versions
from tidemark.sources.bronze import to_bronze, write_slices


def file_stream(spark: SparkSession, path: str, schema: StructType, *, max_files: int | None = None) -> DataFrame:
    """New parquet files below a path, each read once; the schema is declared, never inferred."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def ingest_to_bronze(
    stream: DataFrame,
    sink: str,
    log: str,
    *,
    endpoint: str,
    result_set: str,
    run_id: str,
    ingested_at: str,
    params: Mapping[str, object] | None = None,
    params_from: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Append every new row to a raw table, exactly once: the file sink's log drops replayed batches."""
    raw = to_bronze(
        stream, endpoint, result_set, params, run_id=run_id, ingested_at=ingested_at, params_from=params_from
    )
    return (
        raw.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", log)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def ingest_quarantined(
    stream: DataFrame, good: str, bad: str, log: str, expectations: Mapping[str, Column]
) -> StreamingQuery:
    """Split each batch into accepted and quarantined rows.

    Both sinks keep one folder per batch and overwrite it, so a replayed batch
    replaces itself.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # both sinks read it
        accepted, quarantined = quarantine_split(batch, dict(expectations))
        accepted.write.mode("overwrite").parquet(f"{good}/_batch={batch_id}")
        quarantined.write.mode("overwrite").parquet(f"{bad}/_batch={batch_id}")
        batch.unpersist()

    return stream.writeStream.foreachBatch(land).option("checkpointLocation", log).trigger(availableNow=True).start()


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All batches of a per-batch sink."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def upsert_slices(stream: DataFrame, table: str, log: str, keys: Sequence[str]) -> StreamingQuery:
    """Replace arriving slices of a raw table; replaying a batch leaves the same rows.

    A slice's rows must arrive in one batch, as they do when it is one file.
    """

    def load(batch: DataFrame, _: int) -> None:
        write_slices(batch, table, keys=keys)

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", log).trigger(availableNow=True).start()


def keep_latest(
    stream: DataFrame,
    table: str,
    quarantine: str,
    log: str,
    keys: Sequence[str],
    order: Sequence[Column],
    ts: str,
    *,
    delay: str | None = None,
    parts: int = 64,
) -> StreamingQuery:
    """Keep the first row of each key in ``order``, as ``dedupe_latest`` does with all rows, whatever the order of files.

    The state is a stored table in ``parts`` by a hash of the key; a batch rewrites the parts of its keys and appears at
    once, with its number, so that a replayed batch changes nothing. With ``delay`` (an interval), rows that are
    older by more than that than the latest row of the batches before are late: they go to ``quarantine``, a folder
    for each batch, and none is lost. Rows without a time are late then too. Read the table by ``versions.read``.
    """

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = versions.version(spark, table)
        if before.about.get("batch", -1) >= number:
            return
        limit = before.about.get("latest")
        if delay is not None:
            mark = F.lit(limit).cast("timestamp") - F.expr(f"interval {delay}")
            late = F.col(ts).isNull() | F.coalesce(F.col(ts).cast("timestamp") < mark, F.lit(False))
            batch = batch.withColumn("_late", late).persist()
            batch.where("_late").drop("_late").write.mode("overwrite").parquet(f"{quarantine}/_batch={number}")
            rows = batch.where("NOT _late").drop("_late")
        else:
            rows = batch
        about = {"batch": number, "parts": before.about.get("parts", parts)}
        part = F.pmod(F.xxhash64(*keys), F.lit(about["parts"]))
        touched = versions.parts_in(rows, part)
        held = versions.read(spark, table, rows.schema, before, touched)
        kept = dedupe_latest(held.unionByName(rows), keys, order)
        latest = rows.agg(F.max(F.col(ts).cast("timestamp")).cast("string")).first()[0]
        about["latest"] = max(filter(None, (limit, latest)), default=None)
        versions.replace_parts(kept, table, part, touched=touched, about=about, after=before)
        batch.unpersist()

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", log).trigger(availableNow=True).start()
