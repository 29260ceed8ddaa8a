"""Raw (Bronze) tables: all-text rows with lineage, replaceable slice by slice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.keys import params_json, row_params_json, slice_hash
from tidemark.functions.text import text_sql
from tidemark.operators.ordered import quantile_cell
from tidemark.sources import versions

# The lineage columns of every raw row.
LINEAGE = ("_endpoint", "_result_set", "_params_json", "_param_hash", "_ingested_at", "_run_id")
SLICE_KEYS = ("_endpoint", "_param_hash")

# A slice in one of these states is not fetched again.
RESOLVED = ("done", "empty")


def raw_table_name(endpoint: str, result_set: str) -> str:
    return f"{endpoint}__{result_set}"


def stringify(df: DataFrame) -> list[Column]:
    """Every column as the text it lands as."""
    return [F.expr(f"{text_sql(f.name, f.dataType)} as `{f.name}`") for f in df.schema]


def to_bronze(
    df: DataFrame,
    endpoint: str,
    result_set: str,
    params: Mapping[str, object] | None = None,
    *,
    run_id: str,
    ingested_at: str,
    params_from: Mapping[str, str] | None = None,
) -> DataFrame:
    """All columns as text plus lineage.

    ``params`` describe one slice; ``params_from`` (name -> column) lets a single
    job land many slices, each row hashed by its own parameters.
    """
    text = row_params_json(df, params_from) if params_from else F.lit(params_json(params or {}))
    lineage = [
        F.lit(endpoint).alias("_endpoint"),
        F.lit(result_set).alias("_result_set"),
        text.alias("_params_json"),
        slice_hash(text).alias("_param_hash"),
        F.lit(ingested_at).alias("_ingested_at"),
        F.lit(run_id).alias("_run_id"),
    ]
    return df.select(*stringify(df), *lineage)


def slice_upsert(
    existing: DataFrame,
    batch: DataFrame,
    *,
    slices: DataFrame | None = None,
    keys: Sequence[str] = SLICE_KEYS,
    replace: bool = True,
) -> DataFrame:
    """The raw table after a load: arriving slices replace their earlier rows.

    ``slices`` lists the slices that were fetched when some of them came back empty,
    which still clears them. ``replace=False`` only appends. The batch must have
    the table's columns: the first load fixes them.
    """
    if not replace:
        return existing.unionByName(batch)
    arrived = (batch if slices is None else slices).select(*keys).distinct()
    return existing.join(arrived, list(keys), "left_anti").select(*existing.columns).unionByName(batch)


# Parts of a new slice table; a slice's rows all lie in the part of its hash.
SLICE_PARTS = 64


def write_slices(
    batch: DataFrame,
    path: str,
    *,
    slices: DataFrame | None = None,
    replace: bool = True,
    keys: Sequence[str] = SLICE_KEYS,
    parts: int = SLICE_PARTS,
) -> None:
    """Load slices into a table of versions; re-running a load leaves the same rows.

    Only the parts of arriving slices are rewritten, with their other slices' rows carried over, and all of
    them change at once. ``slices`` lists the fetched slices when some of them came back empty, which clears
    them. A NULL key is a key. ``parts`` holds for a new table and is kept with it. The stored columns and types
    are the batch's. Read the table by ``read_slices``.
    """
    spark, schema = batch.sparkSession, batch.schema
    before = versions.version(spark, path)
    about = {"parts": before.about.get("parts", parts)}
    part = F.pmod(F.xxhash64(*keys), F.lit(about["parts"]))
    if not replace:
        versions.replace_parts(batch, path, part, add=True, about=about, after=before)
        return
    arrived = (batch if slices is None else batch.select(*keys).unionByName(slices.select(*keys))).select(*keys).distinct()
    touched = versions.parts_in(arrived, part)
    held = versions.read(spark, path, schema, before, touched)
    on = reduce(lambda a, b: a & b, [held[k].eqNullSafe(arrived[k]) for k in keys])
    rows = held.join(arrived, on, "left_anti").unionByName(batch)
    versions.replace_parts(rows, path, part, touched=touched, about=about, after=before)


def read_slices(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of a slice table under its own types; an absent table is empty."""
    return versions.read(spark, path, schema)


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A parquet table; with a schema no file is opened to plan the scan."""
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def write_clustered(df: DataFrame, path: str, cluster_by: Sequence[str], *, mode: str = "overwrite") -> None:
    """Write a table so that ranges of the clustering columns share files.

    Readers skip files and row groups by their min/max. Range partitions split a
    hot value by the further columns, so no file or task gets all of it.
    """
    order = [*cluster_by, *[c for c in df.columns if c not in cluster_by and not _nested(df, c)]]
    df.repartitionByRange(*order).sortWithinPartitions(*cluster_by).write.mode(mode).parquet(path)


def write_interleaved(df: DataFrame, path: str, cluster_by: Sequence[str], *, files: int, mode: str = "overwrite") -> None:
    """Write a table so that a range of any one of the columns lies in few files.

    Each value becomes its rank among 256 approximate quantiles of its column, and files hold ranges of a key that
    takes one bit of each rank in turn, the highest first. Readers skip files by their min/max whichever of
    the columns they filter. Columns are numbers, dates, timestamps or texts, of which the first six bytes count.
    """
    ranked, bits = df, 8
    for i, c in enumerate(cluster_by):
        kind = dict(df.dtypes)[c]
        if kind in ("date", "timestamp", "timestamp_ntz"):
            value = F.unix_micros(F.col(c).cast("timestamp")).cast("double")
        elif kind == "string":
            value = F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
        else:
            value = F.col(c).cast("double")
        ranked = quantile_cell(ranked, value, 1 << bits).withColumnRenamed("_cell", f"_rank{i}")
    places = [(b, i) for b in range(bits - 1, -1, -1) for i in range(len(cluster_by))]
    parts = [F.shiftleft(F.shiftright(F.col(f"_rank{i}"), b).bitwiseAND(F.lit(1)).cast("long"), len(places) - 1 - n) for n, (b, i) in enumerate(places)]
    keyed = ranked.withColumn("_key", reduce(lambda a, b: a.bitwiseOR(b), parts)).drop(*[f"_rank{i}" for i in range(len(cluster_by))])
    # equal keys are split by the columns themselves, so that no file gets all rows of a hot value
    dealt = keyed.repartitionByRange(files, "_key", *cluster_by).sortWithinPartitions("_key", *cluster_by)
    dealt.drop("_key").write.mode(mode).parquet(path)


def files_read(spark: SparkSession, path: str, schema: StructType, column: str, low, high) -> DataFrame:
    """(files, read): how many files a table has, and how many a reader must open for a range of a column by their min/max."""
    rows = spark.read.schema(schema).parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    return rows.agg(F.count(F.lit(1)).alias("files"), F.count_if((F.col("high") >= F.lit(low)) & (F.col("low") <= F.lit(high))).alias("read"))


def write_bucketed(df: DataFrame, table: str, path: str, key: str, *, buckets: int, mode: str = "overwrite") -> DataFrame:
    """Write a table in buckets of a key, sorted by it, and return its reader.

    Tables with as many buckets of the same key join, and are grouped by it, without a shuffle. ``table`` is its name in
    the session's catalog, which knows the buckets; the files are at ``path``. Rows are dealt to the buckets by
    one shuffle, so that each bucket is one file.
    """
    df.repartition(buckets, key).write.mode(mode).bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def _nested(df: DataFrame, c: str) -> bool:
    return dict(df.dtypes)[c].startswith(("map", "array", "struct", "variant", "binary"))


def snapshot(df: DataFrame, path: str, *, refresh: bool) -> DataFrame:
    """Keep a query's result for offline reuse: written on refresh, else read back with its types."""
    if refresh:
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- control table -----------------------------------------------------------


def latest_state(state: DataFrame) -> DataFrame:
    """One row per slice: the last written checkpoint, ties to the larger count, then status.

    An aggregate, so a slice that was checkpointed very often collapses before the shuffle.
    """
    rest = [c for c in state.columns if c not in ("endpoint", "param_hash")]
    last = F.max_by(F.struct(*rest), F.struct("updated_at", "result_count", "status"))
    return state.groupBy("endpoint", "param_hash").agg(last.alias("_s")).select("endpoint", "param_hash", "_s.*")


def mark_state(state: DataFrame, update: DataFrame) -> DataFrame:
    """The control table with the updated slices' rows replaced."""
    kept = state.join(update.select("endpoint", "param_hash").distinct(), ["endpoint", "param_hash"], "left_anti")
    return kept.select(*state.columns).unionByName(update)


def pending_slices(plan: DataFrame, state: DataFrame, resolved: Sequence[str] = RESOLVED) -> DataFrame:
    """Planned slices that no checkpoint has resolved; failed ones come back."""
    done = state.where(F.col("status").isin(*resolved)).select("endpoint", "param_hash").distinct()
    return plan.join(done, ["endpoint", "param_hash"], "left_anti")


def slice_plan(entities: DataFrame, entity: str, labels: Sequence[str], label: str = "season") -> DataFrame:
    """Every entity with every label of a short given list."""
    return entities.select(entity).distinct().withColumn(
        label, F.explode(F.array(*[F.lit(x) for x in labels]))
    )


# --- contract ----------------------------------------------------------------


def contract_rows(spark: SparkSession, contract: Mapping[str, Mapping[str, Sequence[str]]]) -> DataFrame:
    """The declared contract as a table: one row per (endpoint, result set) with its column list."""
    rows = [(e, r, list(cols)) for e, sets in contract.items() for r, cols in sets.items()]
    return spark.createDataFrame(rows, "endpoint string, result_set string, columns array<string>")


def contract_columns(contract: DataFrame) -> DataFrame:
    """One row per declared column with the raw table it lands in; empty lists have none."""
    return contract.select(
        F.concat("endpoint", F.lit("__"), "result_set").alias("table_name"), F.explode("columns").alias("column_name")
    )


def contract_summary(contract: DataFrame) -> DataFrame:
    """Number of endpoints, result sets and raw tables."""
    return contract.agg(
        F.count_distinct("endpoint").alias("endpoints"),
        F.count(F.lit(1)).alias("result_sets"),
        F.count_distinct(F.concat("endpoint", F.lit("__"), "result_set")).alias("bronze_tables"),
    )


def contract_duplicates(contract: DataFrame) -> DataFrame:
    """Raw tables that the contract declares more than once."""
    names = contract.groupBy(F.concat("endpoint", F.lit("__"), "result_set").alias("table_name"))
    return names.agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def contract_coverage(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """Compare declared and actual (table_name, column_name) rows: present, missing or undeclared."""
    keys = ["table_name", "column_name"]
    a = declared.select(*keys).distinct().withColumn("_d", F.lit(True))
    b = actual.select(*keys).distinct().withColumn("_a", F.lit(True))
    status = F.when(F.col("_a").isNull(), "missing").when(F.col("_d").isNull(), "undeclared").otherwise("present")
    return a.join(b, keys, "full").select(*keys, status.alias("status"))


def rescue_columns(df: DataFrame, raw: str, known: Sequence[str], out: str = "_rescued_data") -> DataFrame:
    """Keep fields of a JSON text that the contract does not know, as JSON; NULL when there are none."""
    fields = F.from_json(raw, "map<string,string>")
    extra = F.map_filter(fields, lambda k, v: ~k.isin(*known))
    return df.withColumn(out, F.when(F.size(extra) > 0, F.to_json(extra)))
