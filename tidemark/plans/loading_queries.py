"""Queries over raw loads: text landing, slice hashes and replacement, control tables, generated inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.keys import row_params_json, slice_hash
from tidemark.operators.incremental import incremental_merge
from tidemark.operators.staging import last_periods, most_recent, union_distinct
from tidemark.operators.star import lookup, season_dim
from tidemark.plans.inputs import INGESTED_AT, SIDES_SQL, key_sql, sides, table
from tidemark.sources import bronze, generated


def bronze_stringify(spark, sf_dir):
    return bronze.to_bronze(
        table(spark, sf_dir, "lineitem"), "orders", "Lines", {"source": "lineitem"}, run_id="r1", ingested_at=INGESTED_AT
    )


_LINE_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()

BRONZE_SQL = f"""
select {", ".join(f"cast({c} as varchar) as {c}" for c in _LINE_COLUMNS)},
       'orders' as _endpoint, 'Lines' as _result_set, '{{"source": "lineitem"}}' as _params_json,
       substr(sha1('{{"source": "lineitem"}}'), 1, 12) as _param_hash,
       '{INGESTED_AT}' as _ingested_at, 'r1' as _run_id
from lineitem"""


def _order_slices(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.col("o_orderkey").cast("string").alias("game"),
        F.year("o_orderdate").alias("season"),
    )
    text = row_params_json(orders, {"game_id": "game", "season": "season"})
    return orders.select("o_orderkey", "o_orderstatus", text.alias("params_json"), slice_hash(text).alias("param_hash"))


_SLICES_SQL = """
    texts as (
        select o_orderkey, o_orderstatus, '{"game_id": "' || cast(o_orderkey as varchar) || '", "season": '
               || cast(year(o_orderdate) as varchar) || '}' as params_json from orders),
    slices as (select *, substr(sha1(params_json), 1, 12) as param_hash from texts)"""


def param_hash(spark, sf_dir):
    return _order_slices(spark, sf_dir).select("o_orderkey", "params_json", "param_hash")


def _event_days(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.col("ts").cast("date").alias("day")
    )


def slice_upsert(spark, sf_dir):
    days = _event_days(spark, sf_dir)
    land = {"params_from": {"day": "day"}, "ingested_at": INGESTED_AT}
    existing = bronze.to_bronze(days, "feed", "Events", run_id="r1", **land)
    again = days.where((F.col("day") >= F.lit("2024-01-16").cast("date")) & (F.col("event_type") != "error"))
    batch = bronze.to_bronze(again.withColumn("value", F.col("value") * 2), "feed", "Events", run_id="r2", **land)
    return bronze.slice_upsert(existing, batch)


SLICE_UPSERT_SQL = f"""
with days as (
    select event_id, event_type, value, cast(ts as date) as day,
           '{{"day": "' || cast(cast(ts as date) as varchar) || '"}}' as p from events),
arrived as (select * from days where day >= date '2024-01-16' and event_type <> 'error'),
landed as (
    select event_id, event_type, value, day, p, 'r1' as run from days
    where day not in (select day from arrived)
    union all
    select event_id, event_type, value * 2, day, p, 'r2' from arrived)
select cast(event_id as varchar) as event_id, event_type, cast(value as varchar) as value, cast(day as varchar) as day,
       'feed' as _endpoint, 'Events' as _result_set, p as _params_json, substr(sha1(p), 1, 12) as _param_hash,
       '{INGESTED_AT}' as _ingested_at, run as _run_id
from landed"""


def _state(spark, sf_dir):
    status = F.when(F.col("value") < 5, "failed:Timeout").when(F.col("value") < 20, "empty").otherwise("done")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("endpoint"),
        F.col("user_id").cast("string").alias("param_hash"),
        F.date_format("ts", "yyyy-MM").alias("season"),
        F.floor("value").cast("int").alias("result_count"),
        status.alias("status"),
        F.col("ts").alias("updated_at"),
    )


def checkpoint_latest(spark, sf_dir):
    return bronze.latest_state(_state(spark, sf_dir))


CHECKPOINT_SQL = """
select endpoint, param_hash, season, result_count, status, updated_at from (
    select event_type as endpoint, cast(user_id as varchar) as param_hash, strftime(ts, '%Y-%m') as season,
           cast(floor(value) as int) as result_count,
           case when value < 5 then 'failed:Timeout' when value < 20 then 'empty' else 'done' end as status,
           ts as updated_at,
           row_number() over (partition by event_type, user_id
                              order by ts desc, floor(value) desc, 5 desc) as rn
    from events) where rn = 1"""


def pending_slices(spark, sf_dir):
    slices = _order_slices(spark, sf_dir)
    plan = slices.select(F.lit("detail").alias("endpoint"), "param_hash", "o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", "done")
        .when(F.col("o_orderstatus") == "P", "empty")
        .otherwise("failed:KeyError")
    )
    state = slices.select(F.lit("detail").alias("endpoint"), "param_hash", status.alias("status"))
    return bronze.pending_slices(plan, state)


PENDING_SQL = f"""
with {_SLICES_SQL}
select 'detail' as endpoint, param_hash, o_orderkey from slices s
where not exists (select 1 from slices d where d.param_hash = s.param_hash and d.o_orderstatus in ('F', 'P'))"""


def slice_plan(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return bronze.slice_plan(lines, "l_suppkey", generated.season_labels(1995, 2001))


SLICE_PLAN_SQL = """
select t.l_suppkey, cast(y as varchar) || '-' || right(cast(y + 1 as varchar), 2) as season
from (select distinct l_suppkey from lineitem) t, range(1995, 2002) r(y)"""


def contract_coverage(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    name = F.date_format("ts", "yyyyMMdd")
    declared = bronze.contract_columns(
        events.select(F.col("event_type").alias("endpoint"), name.alias("result_set"))
        .distinct()
        .withColumn(
            "columns",
            F.when(F.col("endpoint") == "error", F.array().cast("array<string>")).otherwise(
                F.array(F.lit("k"), F.lit("high_value"))
            ),
        )
    )
    fields = F.map_keys(F.from_json("props", "map<string,string>"))
    seen = F.when(F.col("value") > 250, F.array_append(fields, F.lit("high_value"))).otherwise(fields)
    actual = events.select(
        F.concat("event_type", F.lit("__"), name).alias("table_name"), F.explode(seen).alias("column_name")
    )
    return bronze.contract_coverage(declared, actual)


CONTRACT_SQL = """
with tables as (select distinct event_type, strftime(ts, '%Y%m%d') as d from events),
declared as (
    select event_type || '__' || d as table_name, unnest(['k', 'high_value']) as column_name
    from tables where event_type <> 'error'),
actual as (
    select distinct event_type || '__' || strftime(ts, '%Y%m%d') as table_name,
           unnest(json_keys(props) || case when value > 250 then ['high_value'] else [] end) as column_name
    from events)
select coalesce(d.table_name, a.table_name) as table_name, coalesce(d.column_name, a.column_name) as column_name,
       case when a.table_name is null then 'missing' when d.table_name is null then 'undeclared' else 'present' end
           as status
from declared d full join actual a on d.table_name = a.table_name and d.column_name = a.column_name"""


def seed_dim(spark, sf_dir):
    value = F.col("value")
    zone = F.when(value <= 4, "Restricted Area").when(value <= 14, "Paint (Non-RA)").otherwise("Mid-Range")
    shots = table(spark, sf_dir, "events").groupBy(zone.alias("zone")).agg(F.count(F.lit(1)).alias("attempts"))
    zones = generated.zone_dim(generated.zone_rows(spark))
    return lookup(zones, shots, [("shot_zone", "zone")], [("attempts", "attempts")])


SEED_SQL = f"""
with zones(shot_zone, zone_group, typical_value) as (values
    ('Three Point', 'Perimeter', 3), ('Restricted Area', 'Rim', 2), ('Paint (Non-RA)', 'Paint', 2),
    ('Mid-Range', 'Mid-Range', 2), ('Unknown', 'Unknown', 2)),
shots as (
    select case when value <= 4 then 'Restricted Area' when value <= 14 then 'Paint (Non-RA)' else 'Mid-Range' end as z,
           count(*) as attempts from events group by 1)
select {key_sql("shot_zone")} as shot_zone_key, shot_zone, zone_group, typical_value, attempts
from zones left join shots on z = shot_zone"""


def date_dim(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    days = generated.date_dim(generated.spine_of(orders, "o_orderdate"))
    daily = orders.groupBy(F.col("o_orderdate").cast("date").alias("d")).agg(F.count(F.lit(1)).alias("orders"))
    return lookup(days, daily, [("full_date", "d")], [("orders", "orders")])


DATE_SQL = """
with spine as (
    select cast(unnest(generate_series(min(cast(o_orderdate as date)), max(cast(o_orderdate as date)), interval 1 day))
                as date) as d from orders),
daily as (select cast(o_orderdate as date) as d, count(*) as orders from orders group by 1)
select cast(strftime(s.d, '%Y%m%d') as int) as date_key, s.d as full_date, cast(year(s.d) as int) as year,
       cast(month(s.d) as int) as month, cast(day(s.d) as int) as day_of_month,
       cast(dayofweek(s.d) + 1 as int) as day_of_week, dayname(s.d) as day_name,
       cast(weekofyear(s.d) as int) as week_of_year, cast(quarter(s.d) as int) as quarter,
       dayofweek(s.d) in (0, 6) as is_weekend, orders
from spine s left join daily using (d)"""


def season_range(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    lo, hi = orders.agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    labels = generated.season_range(spark, f"{lo}-{lo + 1}:{hi}-{hi + 1}")
    counts = orders.groupBy(generated.period_label(F.year("o_orderdate")).alias("label")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return lookup(labels, counts, [("season", "label")], [("orders", "orders")])


SEASON_RANGE_SQL = """
select cast(y as varchar) || '-' || right(cast(y + 1 as varchar), 2) as season, count(*) as orders
from (select year(o_orderdate) as y from orders) group by 1"""


def recent_topn(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return most_recent(orders, "o_orderdate", "o_orderkey", 100)


def last_n_periods(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("season"))
    return last_periods(orders, "season", 3)


LAST_PERIODS_SQL = """
with o as (select o_orderkey, o_custkey, cast(year(o_orderdate) as int) as season from orders)
select * from o where season in (select distinct season from o order by season desc limit 3)"""


def union_distinct_ids(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    explicit = orders.where("o_totalprice > 400000").select("o_orderkey")
    recent = most_recent(orders, "o_orderdate", "o_orderkey", 500).select("o_orderkey")
    season = orders.where(F.year("o_orderdate") == 1998).select("o_orderkey")
    return union_distinct(explicit, recent, season)


UNION_SQL = """
select o_orderkey from orders where o_totalprice > 400000
union
select o_orderkey from (select o_orderkey from orders order by o_orderdate desc, o_orderkey limit 500)
union
select o_orderkey from orders where year(o_orderdate) = 1998"""


def season_game_ids(spark, sf_dir):
    games = sides(spark, sf_dir).where("is_home").select("game_id", "game_date", "season_id")
    seasons = season_dim(games, "season_id")
    wanted = lookup(games, seasons, [("season_id", "season_id")], [("season", "season")], how="inner")
    return wanted.where("season = '1998-99'").select("game_id", "game_date").orderBy("game_date", "game_id")


SEASON_GAMES_SQL = f"""
with {SIDES_SQL}
select game_id, game_date from sides where is_home and substr(season_id, 2, 4) = '1998'"""


def incremental_merge_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"), "o_totalprice")
    target = orders.where(F.col("d") <= F.lit("2000-06-30").cast("date"))
    corrected = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return incremental_merge(target, corrected, ["o_orderkey"], "d", lookback_days=30)


MERGE_SQL = """
with o as (select o_orderkey, cast(o_orderdate as date) as d, o_totalprice from orders),
mark as (select max(d) - 30 as m from o where d <= date '2000-06-30')
select o_orderkey, d, case when d > m then o_totalprice + 1 else o_totalprice end as o_totalprice from o, mark"""


QUERIES = {
    "bronze_stringify": bronze_stringify,
    "param_hash": param_hash,
    "slice_upsert": slice_upsert,
    "checkpoint_latest": checkpoint_latest,
    "pending_slices": pending_slices,
    "slice_plan": slice_plan,
    "contract_coverage": contract_coverage,
    "seed_dim": seed_dim,
    "date_dim": date_dim,
    "season_range": season_range,
    "recent_topn": recent_topn,
    "last_n_periods": last_n_periods,
    "union_distinct_ids": union_distinct_ids,
    "season_game_ids": season_game_ids,
    "incremental_merge": incremental_merge_orders,
}

ORACLE = {
    "bronze_stringify": BRONZE_SQL,
    "param_hash": f"with {_SLICES_SQL} select o_orderkey, params_json, param_hash from slices",
    "slice_upsert": SLICE_UPSERT_SQL,
    "checkpoint_latest": CHECKPOINT_SQL,
    "pending_slices": PENDING_SQL,
    "slice_plan": SLICE_PLAN_SQL,
    "contract_coverage": CONTRACT_SQL,
    "seed_dim": SEED_SQL,
    "date_dim": DATE_SQL,
    "season_range": SEASON_RANGE_SQL,
    "recent_topn": """select o_orderkey, o_orderdate, o_totalprice from orders
                      order by o_orderdate desc, o_orderkey limit 100""",
    "last_n_periods": LAST_PERIODS_SQL,
    "union_distinct_ids": UNION_SQL,
    "season_game_ids": SEASON_GAMES_SQL,
    "incremental_merge": MERGE_SQL,
}
