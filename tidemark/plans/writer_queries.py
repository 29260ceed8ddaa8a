"""Queries that write tables and read back what was stored."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import calibration, quality
from tidemark.plans.inputs import FORECASTS_SQL, INGESTED_AT, finely, forecasts, rounded, table
from tidemark.plans.loading_queries import CHECKPOINT_SQL
from tidemark.session import new_path
from tidemark.operators.incremental import merge_parts
from tidemark.sources import bronze, versions


def slice_write(spark, sf_dir):
    """Days of events as stored slices: some are loaded again, and one comes back empty."""
    days = table(spark, sf_dir, "events").select("event_id", "value", F.col("ts").cast("date").alias("day"))

    def landed(rows, run):
        return bronze.to_bronze(rows, "feed", "Events", run_id=run, ingested_at=INGESTED_AT, params_from={"day": "day"})

    path = new_path(spark, "slices")
    days = days.withColumn("day", F.when(F.col("event_id") % 97 != 0, F.col("day")))  # some without a day
    first = landed(days, "r1")
    keys = ["_endpoint", "day"]
    bronze.write_slices(first, path, keys=keys, parts=16)
    again = days.where("day >= date '2024-01-16'").withColumn("value", F.col("value") * 2)
    fetched = landed(days.where("day >= date '2024-01-16' OR day = date '2024-01-03'"), "r2")
    bronze.write_slices(landed(again, "r2"), path, slices=fetched, keys=keys)
    undated = landed(days.where("day is null").withColumn("value", -F.col("value")), "r3")
    bronze.write_slices(undated, path, keys=keys)
    stored = bronze.read_slices(spark, path, first.schema)
    return stored.select("event_id", "value", "day", "_param_hash", "_run_id")


SLICE_WRITE_SQL = """
select cast(event_id as varchar) as event_id,
       cast(case when d is null then -value when d >= date '2024-01-16' then value * 2 else value end as varchar) as value,
       cast(d as varchar) as day,
       substr(sha1('{"day": ' || coalesce('"' || cast(d as varchar) || '"', 'null') || '}'), 1, 12) as _param_hash,
       case when d is null then 'r3' when d >= date '2024-01-16' then 'r2' else 'r1' end as _run_id
from (select *, case when event_id % 97 <> 0 then cast(ts as date) end as d from events)
where d is distinct from date '2024-01-03'"""


def slice_append(spark, sf_dir):
    """Days of events appended in two batches, of which the second repeats some: an append keeps all rows."""
    days, path = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("date").alias("day")), new_path(spark, "appended")

    def landed(rows, run):
        return bronze.to_bronze(rows, "feed", "Events", run_id=run, ingested_at=INGESTED_AT, params_from={"day": "day"})

    first = landed(days.where("day <= date '2024-01-20'"), "r1")
    bronze.write_slices(first, path, replace=False, parts=8)
    bronze.write_slices(landed(days.where("day >= date '2024-01-18'"), "r2"), path, replace=False)
    return bronze.read_slices(spark, path, first.schema).select("event_id", "day", "_run_id")


SLICE_APPEND_SQL = """
select cast(event_id as varchar) as event_id, cast(cast(ts as date) as varchar) as day, run as _run_id
from events, (values ('r1'), ('r2')) as v (run)
where (run = 'r1' and cast(ts as date) <= date '2024-01-20') or (run = 'r2' and cast(ts as date) >= date '2024-01-18')"""


def _daily_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"), "o_totalprice")


def incremental_load(spark, sf_dir):
    """Orders by month: a later load corrects the last 30 days and some older orders, and leaves all other files as they are.

    ``rewritten`` says that the row lies in a file of the second load.
    """
    orders, path = _daily_orders(spark, sf_dir), new_path(spark, "orders")
    month = F.date_format("d", "yyyy-MM")
    first = merge_parts(orders.where("d <= date '2000-06-30'"), path, ["o_orderkey"], "d", month)
    # an order of 1996 comes again under a new date, so its old row goes
    moved = F.when((F.year("d") == 1996) & (F.col("o_orderkey") % 1000 == 7), F.date_add(F.lit("2000-07-01").cast("date"), 5)).otherwise(F.col("d"))
    later = orders.select("o_orderkey", moved.alias("d"), (F.col("o_totalprice") + 1).alias("o_totalprice"))
    merge_parts(later, path, ["o_orderkey"], "d", month, lookback_days=30)
    known = [f for own in first.parts.values() for f in own]
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"(run-[^/]+/[^/]+)/[^/]+$", 1)
    stored = versions.read(spark, path, orders.schema)
    return stored.select("o_orderkey", "d", "o_totalprice", (~folder.isin(known)).alias("rewritten"))


INCREMENTAL_SQL = """
with o as (select o_orderkey, cast(o_orderdate as date) as d, o_totalprice from orders),
mark as (select max(d) - 30 as m from o where d <= date '2000-06-30'),
later as (select o_orderkey, case when year(d) = 1996 and o_orderkey % 1000 = 7 then date '2000-07-06' else d end as d, o_totalprice + 1 as o_totalprice from o),
fresh as (select later.* from later, mark where d > m),
merged as (select *, true as new from fresh union all
         select *, false from o where d <= date '2000-06-30' and o_orderkey not in (select o_orderkey from fresh)),
touched as (select strftime(d, '%Y-%m') as p from fresh union
            select strftime(d, '%Y-%m') from o where d <= date '2000-06-30' and o_orderkey in (select o_orderkey from fresh))
select o_orderkey, d, o_totalprice, strftime(d, '%Y-%m') in (select p from touched) as rewritten from merged"""


def publish_after_gate(spark, sf_dir):
    """Versions of a table as readers see them after each run: one is published, one fails its test, one ends before it is shown."""
    orders, path = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), new_path(spark, "published")
    status = F.col("o_orderstatus")
    seen = []

    def run(name, rows, touched, limit, ends=False):
        def tests(new):
            if ends:
                raise KeyboardInterrupt
            return [quality.RowCheck("total", new, quality.outside("o_totalprice", 0, limit))]

        try:
            versions.replace_parts(rows, path, status, touched=touched, tests=tests)
        except (quality.SuiteFailed, KeyboardInterrupt):
            pass
        shown = versions.version(spark, path)
        seen.append(versions.read(spark, path, orders.schema, shown).select(F.lit(name).alias("run"), F.lit(shown.number).alias("version"), "*"))

    run("first", orders.where("o_orderstatus <> 'P'"), None, 1e12)
    run("bad", orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", -F.col("o_totalprice")), ["F"], 1e12)
    run("killed", orders.where("o_orderstatus = 'P'"), ["P"], 1e12, ends=True)
    run("good", orders.where("o_orderstatus = 'O'").withColumn("o_totalprice", F.col("o_totalprice") * 2), ["O"], 1e12)
    return reduce(DataFrame.unionAll, seen)


PUBLISH_SQL = """
select run, version, o_orderkey, o_orderstatus, case when version = 2 and o_orderstatus = 'O' then o_totalprice * 2 else o_totalprice end as o_totalprice
from orders, (values ('first', 1), ('bad', 1), ('killed', 1), ('good', 2)) as runs (run, version) where o_orderstatus <> 'P'"""


def clustered_write(spark, sf_dir):
    """Lines written in order of date and supplier, read back."""
    path = new_path(spark, "clustered")
    lines = table(spark, sf_dir, "lineitem")
    bronze.write_clustered(lines, path, ["l_shipdate", "l_suppkey"])
    return bronze.read_table(spark, path, lines.schema)


def interleaved_write(spark, sf_dir):
    """Lines written by both date and supplier: a range of either one is in less than three quarters of the files."""
    lines, path = table(spark, sf_dir, "lineitem"), new_path(spark, "interleaved")
    bronze.write_interleaved(lines, path, ["l_shipdate", "l_suppkey"], files=64)
    month = [F.lit(d).cast("timestamp") for d in ("1998-03-01", "1998-03-31")]
    found = [
        bronze.files_read(spark, path, lines.schema, c, low, high).select(F.lit(c).alias("filter"), (F.col("read") * 4 < F.col("files") * 3).alias("skips"))
        for c, (low, high) in (("l_shipdate", month), ("l_suppkey", (3, 3)))
    ]
    rows = bronze.read_table(spark, path, lines.schema).agg(F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").alias("quantity"))
    return found[0].unionAll(found[1]).select("*", rows.select("rows").scalar().alias("rows"), rows.select("quantity").scalar().alias("quantity"))


def bucketed_join(spark, sf_dir):
    """Facts stored in buckets of their game, joined and summed by game without a shuffle."""
    name = f"b{uuid.uuid4().hex}"
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    buckets = max(8, finely(lines) // 4)  # a task has one bucket of each table
    facts = bronze.write_bucketed(lines.withColumnRenamed("l_orderkey", "game_id"), f"{name}_lines", new_path(spark, "bucketed"), "game_id", buckets=buckets)
    games = bronze.write_bucketed(orders.withColumnRenamed("o_orderkey", "game_id"), f"{name}_orders", new_path(spark, "bucketed"), "game_id", buckets=buckets)
    joined = facts.join(games, "game_id").groupBy("game_id", "o_orderstatus")
    return joined.agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))


def full_replace(spark, sf_dir):
    """A table that a second write replaces whole."""
    path = new_path(spark, "replaced")
    orders = table(spark, sf_dir, "orders")
    bronze.write_clustered(orders, path, ["o_orderdate"])
    bronze.write_clustered(orders.where("o_orderstatus = 'F'"), path, ["o_orderdate"])
    return bronze.read_table(spark, path, orders.schema)


def snapshot_reuse(spark, sf_dir):
    """A stored result that is read again although its source has changed."""
    path = new_path(spark, "snapshot")
    events = table(spark, sf_dir, "events")
    daily = events.groupBy(F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    bronze.snapshot(daily, path, refresh=True)
    changed = daily.withColumn("n", F.col("n") * 2)
    return bronze.snapshot(changed, path, refresh=False)


def mark_state(spark, sf_dir):
    """The control table after the slices that failed are marked as done."""
    status = F.when(F.col("value") < 5, "failed:Timeout").when(F.col("value") < 20, "empty").otherwise("done")
    state = bronze.latest_state(
        table(spark, sf_dir, "events").select(
            F.col("event_type").alias("endpoint"),
            F.col("user_id").cast("string").alias("param_hash"),
            F.date_format("ts", "yyyy-MM").alias("season"),
            F.floor("value").cast("int").alias("result_count"),
            status.alias("status"),
            F.col("ts").alias("updated_at"),
        )
    )
    update = state.where("status LIKE 'failed%'").withColumns({"status": F.lit("done"), "result_count": F.lit(1)})
    return bronze.mark_state(state, update)


MARK_SQL = f"""
with state as ({CHECKPOINT_SQL})
select endpoint, param_hash, season, case when status like 'failed%' then 1 else result_count end as result_count,
       case when status like 'failed%' then 'done' else status end as status, updated_at
from state"""


def gate_blocks_write(spark, sf_dir):
    """Orders of each status are stored only if none is above a limit; what got through."""
    orders = table(spark, sf_dir, "orders")
    path = new_path(spark, "gated")
    for status in ("F", "O", "P"):
        rows = orders.where(F.col("o_orderstatus") == status)
        limit = {"F": 1e12, "O": 0.0, "P": 1e12}[status]
        check = quality.RowCheck(f"{status} total", rows, quality.outside("o_totalprice", 0, limit))
        try:
            quality.run_suite([check])
        except quality.SuiteFailed:
            continue
        rows.select("o_orderkey", "o_orderstatus").write.mode("append").parquet(path)
    return spark.read.schema("o_orderkey long, o_orderstatus string").parquet(path)


def contract_duplicates(spark, sf_dir):
    """Raw tables that are declared by more than one row: event types by day of the month."""
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("endpoint"), F.date_format("ts", "dd").alias("result_set"), F.array("props").alias("columns"))
    return bronze.contract_duplicates(rows)


def contract_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("endpoint"), F.date_format("ts", "dd").alias("result_set"), F.array("props").alias("columns"))
    return bronze.contract_summary(rows)


_SCORES = ["base_rate", "brier", "log_loss", "accuracy"]


def calibration_by_model(spark, sf_dir):
    """Two models side by side: the given forecasts, and their shrinkage to one half."""
    given = forecasts(spark, sf_dir).select("win_prob", "won")
    shrunk = given.select(((F.col("win_prob") + 0.5) / 2).alias("win_prob"), "won")
    both = given.withColumn("model", F.lit("given")).union(shrunk.withColumn("model", F.lit("shrunk")))
    out = calibration.calibration_summary(both, "win_prob", "won", by=["model"])
    return rounded(out.select("model", "n", *_SCORES), 9, *_SCORES)


MODEL_SQL = f"""
with {FORECASTS_SQL},
m as (select 'given' as model, win_prob as p, won from forecasts union all select 'shrunk', (win_prob + 0.5::double) / 2, won from forecasts)
select model, count(*) as n, round(avg(won), 9) as base_rate, round(avg(pow(p - won, 2)), 9) as brier,
       round(-avg(won * ln(greatest(least(p, 1 - 1e-12::double), 1e-12::double))
             + (1 - won) * ln(1 - greatest(least(p, 1 - 1e-12::double), 1e-12::double))), 9) as log_loss,
       round(avg(cast((p >= 0.5) = (won = 1) as int)), 9) as accuracy
from m group by model"""


def hash_of_line_ends(spark, sf_dir):
    """Slice hashes of texts that end in line breaks and other signs which need escaping."""
    ends = F.element_at(F.array(*[F.lit(e) for e in ("\n", "", "!", "\u0085", "\t", '"')]), (F.col("event_id") % 6 + 1).cast("int"))
    events = table(spark, sf_dir, "events").select("event_id", F.concat("event_type", ends).alias("label"))
    return bronze.to_bronze(events, "e", "R", run_id="r", ingested_at=INGESTED_AT, params_from={"label": "label"}).select("event_id", "_params_json", "_param_hash")


HASH_SQL = r"""
with t as (select event_id, '{"label": "' || event_type || (['\n', '', '!', '\u0085', '\t', '\"'])[event_id % 6 + 1] || '"}' as j from events)
select cast(event_id as varchar) as event_id, j as _params_json, substr(sha1(j), 1, 12) as _param_hash from t"""


QUERIES = {
    f.__name__: f
    for f in (
        slice_write, slice_append, incremental_load, publish_after_gate, clustered_write, interleaved_write, bucketed_join, full_replace, snapshot_reuse, mark_state, gate_blocks_write, contract_duplicates,
        contract_summary, calibration_by_model, hash_of_line_ends,
    )
}

ORACLE = {
    "slice_write": SLICE_WRITE_SQL,
    "slice_append": SLICE_APPEND_SQL,
    "incremental_load": INCREMENTAL_SQL,
    "publish_after_gate": PUBLISH_SQL,
    "clustered_write": "select * from lineitem",
    "interleaved_write": """select f as filter, true as skips, (select count(*) from lineitem) as rows, (select sum(l_quantity) from lineitem) as quantity
                            from (values ('l_shipdate'), ('l_suppkey')) as v (f)""",
    "bucketed_join": """select l_orderkey as game_id, o_orderstatus, count(*) as lines, sum(l_quantity) as quantity
                        from lineitem join orders on o_orderkey = l_orderkey group by 1, 2""",
    "full_replace": "select * from orders where o_orderstatus = 'F'",
    "snapshot_reuse": "select cast(ts as date) as day, count(*) as n from events group by 1",
    "mark_state": MARK_SQL,
    "gate_blocks_write": "select o_orderkey, o_orderstatus from orders where o_orderstatus in ('F', 'P')",
    "contract_duplicates": """select event_type || '__' || strftime(ts, '%d') as table_name, count(*) as n from events group by 1
                              having count(*) > 1""",
    "contract_summary": """select count(distinct event_type) as endpoints, count(*) as result_sets,
                                  count(distinct event_type || '__' || strftime(ts, '%d')) as bronze_tables from events""",
    "calibration_by_model": MODEL_SQL,
    "hash_of_line_ends": HASH_SQL,
}
