"""Queries over data tests, monitoring and stream ingestion."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tidemark.operators import quality
from tidemark.plans.inputs import INGESTED_AT, SIDES_SQL, rounded, sides, table
from tidemark.session import new_path
from tidemark.sources import versions
from tidemark.streaming import ingest


def _maybe(sf_dir, spark):
    """Line keys with gaps: no supplier on returned lines."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") != "R", F.col("l_suppkey")).alias("l_suppkey"),
        "l_quantity",
    )


_MAYBE_SQL = """
with m as (select l_orderkey, l_linenumber, case when l_returnflag <> 'R' then l_suppkey end as l_suppkey, l_quantity
           from lineitem)
"""


def dq_not_null(spark, sf_dir):
    return quality.not_null(_maybe(sf_dir, spark), "l_suppkey")


def dq_unique(spark, sf_dir):
    return quality.unique(_maybe(sf_dir, spark), "l_suppkey")


def dq_unique_combo(spark, sf_dir):
    return quality.unique_combination(_maybe(sf_dir, spark), ["l_orderkey", "l_linenumber", "l_suppkey"])


def dq_relationship(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return quality.relationship(orders, "o_orderkey", table(spark, sf_dir, "lineitem"), "l_orderkey")


def dq_accepted_values(spark, sf_dir):
    return quality.accepted_values(
        table(spark, sf_dir, "events"), "event_type", ["click", "view", "signup", "purchase"]
    )


def dq_accepted_range(spark, sf_dir):
    return quality.accepted_range(table(spark, sf_dir, "events").select("event_id", "value"), "value", 0.5, 150)


def dq_rows_per_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("game_id"))
    return quality.rows_per_key(lines, "game_id", 2)


def reconcile_measure(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("game_id"), F.col("l_suppkey").alias("team_id"), "l_quantity", "l_tax"
    )
    players = lines.where("l_tax > 0.01").withColumn("points", F.col("l_quantity").cast("long"))
    teams = sides(spark, sf_dir).select("game_id", "team_id", F.col("points").cast("long").alias("points"))
    return quality.reconcile_sum(
        players, teams, ["game_id", "team_id"], "points", "points", as_name="player_points", total_name="team_points"
    )


RECONCILE_SQL = f"""
with {SIDES_SQL},
pg as (select cast(l_orderkey as varchar) as game_id, l_suppkey as team_id, cast(sum(l_quantity) as bigint) as player_points
       from lineitem where l_tax > 0.01 group by 1, 2)
select game_id, team_id, player_points, cast(s.points as bigint) as team_points
from pg join sides s using (game_id, team_id) where player_points <> s.points"""


def reconcile_count(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("is_made", F.col("l_linestatus") == "O")
    other = lines.withColumn("fgm", (F.col("l_discount") < 0.06).cast("int"))
    return quality.reconcile_count(
        lines, other, ["l_orderkey", "l_suppkey"], "is_made", "fgm", as_name="made_fg", total_name="box_fgm"
    )


RECONCILE_COUNT_SQL = """
select l_orderkey, l_suppkey, count(*) filter (where l_linestatus = 'O') as made_fg,
       cast(sum(cast(l_discount < 0.06 as int)) as bigint) as box_fgm
from lineitem group by 1, 2
having count(*) filter (where l_linestatus = 'O') <> sum(cast(l_discount < 0.06 as int))"""


def dq_freshness(spark, sf_dir):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return quality.freshness(table(spark, sf_dir, "events"), "ts", now, 24, by=["user_id"])


def dq_row_count_band(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return quality.row_count_band(orders, ["month"], 180, 200)


def profile_drift(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("day"),
        "value",
        F.when(F.col("event_type") != "error", F.get_json_object("props", "$.k").cast("int")).alias("k"),
    )
    out = quality.profile_drift(events, "day", ["value", "k"], F.date_sub("day", 1))
    return rounded(out, 6, *[c for c in out.columns if c not in ("day", "n", "n_change")])


def _drift_sql():
    stats = {f"{c}_{m}": e.format(c=c) for c in ("value", "k") for m, e in
             (("null_rate", "count(*) filter (where {c} is null) / count(*)"), ("mean", "avg({c})"))}
    one = ", ".join(f"{e} as {n}" for n, e in stats.items())
    out = ", ".join(
        f"round(p.{n}, 6) as {n}, round(p.{n} - q.{n}, 6) + 0 as {n}_change" for n in stats
    )
    return f"""
with e as (select cast(ts as date) as day, value,
                  case when event_type <> 'error' then cast(props->>'$.k' as int) end as k from events),
p as (select day, count(*) as n, {one} from e group by day)
select p.day, p.n, p.n - q.n as n_change, {out} from p left join p q on q.day = p.day - 1"""


_EDGES = {"value": (5, 10, 20, 40, 80), "k": (3, 6)}


def distribution_drift(spark, sf_dir):
    """Distances of each day's values from those of the day before."""
    events = table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("day"), "value", F.when(F.col("event_type") != "error", F.get_json_object("props", "$.k").cast("int")).alias("k")
    )
    out = quality.distribution_drift(events, "day", _EDGES, F.date_sub("day", 1), alarm=0.02)
    return rounded(out, 6, *[f"{c}_{m}" for c in _EDGES for m in ("psi", "ks")])


def _distribution_sql():
    counts, shown = [], []
    for c, edges in _EDGES.items():
        cuts = [None, *edges, None]
        tests = [" and ".join([f"{c} >= {a}"] * (a is not None) + [f"{c} < {b}"] * (b is not None)) for a, b in zip(cuts, cuts[1:], strict=False)]
        counts.append(f"[{', '.join(f'count(*) filter ({t})' for t in tests)}] as {c}_hist, count(*) filter ({c} is null) as {c}_nulls")
        n = len(tests)
        p, q = ([f"({side}.{c}_hist[{i}] + 0.5::double) / (list_sum({side}.{c}_hist) + {n / 2}::double)" for i in range(1, n + 1)] for side in "pq")
        psi = " + ".join(f"({a} - {b}) * ln({a} / ({b}))" for a, b in zip(p, q, strict=True))
        until = [f"abs(list_sum(p.{c}_hist[1:{i}]) / list_sum(p.{c}_hist)::double - list_sum(q.{c}_hist[1:{i}]) / list_sum(q.{c}_hist)::double)" for i in range(1, n)]
        shown.append(f"round({psi}, 6) + 0 as {c}_psi, round(greatest({', '.join(until)}), 6) + 0 as {c}_ks, {psi} > 0.02 as {c}_drifted")
    return f"""
with e as (select cast(ts as date) as day, value, case when event_type <> 'error' then cast(props->>'$.k' as int) end as k from events),
h as (select day, {", ".join(counts)} from e group by day)
select p.*, {", ".join(shown)} from h p left join h q on q.day = p.day - 1"""


def suite_counts(spark, sf_dir):
    """A suite's failing rows per check, in one job."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    checks = [
        quality.RowCheck("orders_key_not_null", orders, F.col("o_orderkey").isNull()),
        quality.Check("orders_key_unique", quality.unique(orders, "o_orderkey")),
        quality.Check("line_order_exists", quality.relationship(lines, "l_orderkey", orders, "o_orderkey")),
        quality.Check(
            "line_key_unique", quality.unique_combination(lines, ["l_orderkey", "l_linenumber"]), severity="warn"
        ),
        quality.RowCheck("discount_range", lines, quality.outside("l_discount", 0, 0.08), severity="warn"),
    ]
    return quality.run_suite(checks)


SUITE_SQL = """
select 'orders_key_not_null' as name, 'error' as severity, count(*) as failing_rows
from orders where o_orderkey is null
union all
select 'orders_key_unique', 'error', count(*) from (select 1 from orders group by o_orderkey having count(*) > 1)
union all
select 'line_order_exists', 'error', count(*) from lineitem where l_orderkey not in (select o_orderkey from orders)
union all
select 'line_key_unique', 'warn', count(*)
from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
union all
select 'discount_range', 'warn', count(*) from lineitem where not l_discount between 0 and 0.08"""

# --- streams -------------------------------------------------------------------------


def stream_ingest(spark, sf_dir):
    """Every event file row lands once in an all-text table, through a stream that drains and stops."""
    source = f"{sf_dir}/events.parquet*"  # a pattern serves one file as well as a folder of them
    schema = table(spark, sf_dir, "events").schema
    sink = new_path(spark, "raw-events")
    query = ingest.ingest_to_bronze(
        ingest.file_stream(spark, source, schema),
        sink,
        new_path(spark, "log"),
        endpoint="feed",
        result_set="Events",
        run_id="s1",
        ingested_at=INGESTED_AT,
        params={"feed": "events"},
    )
    query.awaitTermination()
    return spark.read.parquet(sink)


STREAM_SQL = f"""
select cast(event_id as varchar) as event_id, cast(ts as varchar) as ts, cast(user_id as varchar) as user_id, event_type,
       cast(value as varchar) as value, props, 'feed' as _endpoint, 'Events' as _result_set,
       '{{"feed": "events"}}' as _params_json, substr(sha1('{{"feed": "events"}}'), 1, 12) as _param_hash,
       '{INGESTED_AT}' as _ingested_at, 's1' as _run_id
from events"""


def stream_quarantine(spark, sf_dir):
    source = f"{sf_dir}/events.parquet*"  # a pattern serves one file as well as a folder of them
    schema = table(spark, sf_dir, "events").schema
    good, bad = new_path(spark, "accepted"), new_path(spark, "quarantine")
    tests = {"value_in_range": F.col("value").between(1, 200), "not_an_error": F.col("event_type") != "error"}
    query = ingest.ingest_quarantined(
        ingest.file_stream(spark, source, schema), good, bad, new_path(spark, "log"), tests
    )
    query.awaitTermination()
    kept = ingest.read_batches(spark, good, schema).select("event_id", F.lit("").alias("failed"))
    held = ingest.read_batches(spark, bad, StructType([*schema, StructField("_failed", ArrayType(StringType()))]))
    return kept.unionByName(held.select("event_id", F.array_join("_failed", ",").alias("failed")))


STREAM_QUARANTINE_SQL = """
select event_id, concat_ws(',', case when not value between 1 and 200 then 'value_in_range' end,
                                case when event_type = 'error' then 'not_an_error' end) as failed
from events"""



def stream_keep_latest(spark, sf_dir):
    """Each user's and type's latest event, from a stream of files in no order; rows more than ten days late are set apart."""
    events = table(spark, sf_dir, "events")
    source, kept, late = (new_path(spark, n) for n in ("mixed-events", "latest-events", "late-events"))
    for i in range(3):  # a third of the days in each file, the earliest ones last
        day = F.dayofmonth("ts")
        events.where((day > 20, (day > 10) & (day <= 20), day <= 10)[i]).coalesce(1).write.mode("append").parquet(f"{source}/{i}")
    for i in range(3):  # a run takes the files that are new
        stream = ingest.file_stream(spark, f"{source}/[0-{i}]", events.schema)
        order = [F.col("ts").desc(), F.col("event_id").desc()]
        ingest.keep_latest(stream, kept, late, f"{kept}-log", ["user_id", "event_type"], order, "ts", delay="20 days", parts=4).awaitTermination()
    state = versions.read(spark, kept, events.schema).select("event_id", "ts", "value", F.lit("latest").alias("what"))
    return state.unionByName(ingest.read_batches(spark, late, events.schema).select("event_id", "ts", "value", F.lit("late").alias("what")))


STREAM_LATEST_SQL = """
with e as (select *, case when day(ts) > 20 then 0 when day(ts) > 10 then 1 else 2 end as run from events),
marked as (select *, (select max(ts) from e f where f.run < e.run) as mark from e),
timely as (select * from marked where mark is null or ts >= mark - interval 20 days)
select event_id, ts, value, 'latest' as what from timely
qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1
union all select event_id, ts, value, 'late' from marked where ts < mark - interval 20 days"""

QUERIES = {
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_unique_combo": dq_unique_combo,
    "dq_relationship": dq_relationship,
    "dq_accepted_values": dq_accepted_values,
    "dq_accepted_range": dq_accepted_range,
    "dq_rows_per_key": dq_rows_per_key,
    "reconcile_measure": reconcile_measure,
    "reconcile_count": reconcile_count,
    "dq_freshness": dq_freshness,
    "dq_row_count_band": dq_row_count_band,
    "dq_suite": suite_counts,
    "profile_drift": profile_drift,
    "distribution_drift": distribution_drift,
    "stream_ingest": stream_ingest,
    "stream_quarantine": stream_quarantine,
    "stream_keep_latest": stream_keep_latest,
}

ORACLE = {
    "dq_not_null": _MAYBE_SQL + "select * from m where l_suppkey is null",
    "dq_unique": _MAYBE_SQL
    + "select l_suppkey, count(*) as n from m where l_suppkey is not null group by 1 having count(*) > 1",
    "dq_unique_combo": _MAYBE_SQL
    + "select l_orderkey, l_linenumber, l_suppkey, count(*) as n from m group by 1, 2, 3 having count(*) > 1",
    "dq_relationship": """select o_orderkey, o_custkey from orders
                          where o_orderkey not in (select l_orderkey from lineitem)""",
    "dq_accepted_values": "select event_type, count(*) as n from events where event_type = 'error' group by 1",
    "dq_accepted_range": "select event_id, value from events where value < 0.5 or value > 150",
    "dq_rows_per_key": """select l_orderkey as game_id, count(*) as team_rows from lineitem group by 1
                          having count(*) <> 2""",
    "reconcile_measure": RECONCILE_SQL,
    "reconcile_count": RECONCILE_COUNT_SQL,
    "dq_freshness": """select user_id, max(ts) as last_loaded from events group by 1
                       having max(ts) < timestamp '2024-01-30 00:00:00'""",
    "dq_row_count_band": """select strftime(o_orderdate, '%Y-%m') as month, count(*) as n from orders group by 1
                            having count(*) not between 180 and 200""",
    "dq_suite": SUITE_SQL,
    "profile_drift": _drift_sql(),
    "distribution_drift": _distribution_sql(),
    "stream_ingest": STREAM_SQL,
    "stream_keep_latest": STREAM_LATEST_SQL,
    "stream_quarantine": STREAM_QUARANTINE_SQL,
}
