"""Shards that all have the corpus's mixture of sources.

Rows are ranked in a seeded shuffle within their source, sorted by rank as a
fraction of the source's size, and cut into runs of equal length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, pick

#: Rows that one window group holds on average.
ROWS_PER_BUCKET = 100_000


def stratified_shards(
    df: DataFrame, shards: int, seed: int = 0, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """(doc_id, source, size, text_crc32, shard, slot) for every row; shard sizes are at most one row apart.

    Ranks come from buckets of the shuffle hash and counts of the buckets, so that
    neither a source nor a run of the sorted order has to fit one task. Each source's
    ranks are shifted by a fraction hashed from its name, which spreads small
    sources over the shards. A shard holds its share of a source up to one row at
    either end.

    A null source is a source of its own; a null text has size 1 and the checksum of
    nothing. Rows equal in id, text size and checksum are interchangeable. Other
    columns are ignored. An empty table gives an empty table.
    """
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = pick(df, doc_id=id_col, source=source_col, text=text_col).select(
        "doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    total = df.count()
    buckets = max(partitions(df), -(-total // ROWS_PER_BUCKET))
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "size", "text_crc32")).withColumn("bucket", F.pmod("h", F.lit(buckets)))
    order = ["h", "doc_id", "size", "text_crc32"]

    by_source = Window.partitionBy("source")
    counts = (
        rows.groupBy("source", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("source").alias("s"),
            F.col("bucket").alias("b"),
            (F.sum("n").over(by_source.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
            F.sum("n").over(by_source).alias("of_source"),
        )
    )
    rank = F.row_number().over(Window.partitionBy("source", "bucket").orderBy(*order)) + F.col("before")
    shift = (F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(1 << 20)) + 0.5) / F.lit(float(1 << 20))
    ranked = rows.join(counts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).select(
        "doc_id", "source", "size", "text_crc32", "h", ((rank - shift) / F.col("of_source")).alias("part")
    )
    ranked = ranked.withColumn("cell", F.floor(F.col("part") * buckets))
    cells = ranked.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.select(
        F.col("cell").alias("c"),
        (F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
    )
    place = F.row_number().over(Window.partitionBy("cell").orderBy("part", "source", *order)) + F.col("before") - 1
    placed = ranked.join(cells, F.col("cell") == F.col("c")).select("doc_id", "source", "size", "text_crc32", place.cast("long").alias("place"))
    shard = F.expr(f"place * {shards} div {max(total, 1)}")
    start = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return (
        placed.withColumn("shard", shard.cast("int")).withColumn("slot", (F.col("place") - start).cast("long")).drop("place")
    )
