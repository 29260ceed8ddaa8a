"""The given tables in the roles the operators work on, as DataFrames and as SQL.

``*_SQL`` are common table expressions for the SQL form of the same input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import NULL_KEY
from tidemark.operators.ordered import dealt, dealt_once

INGESTED_AT = "2024-02-01T00:00:00+00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def finely(df: DataFrame) -> int:
    """Tasks for steps that make much of each row of a scanned table: 16 for each of its splits, which grow in number with it."""
    return 16 * df.rdd.getNumPartitions()


def key_sql(*cols: str) -> str:
    """SQL text of a surrogate key."""
    parts = [f"coalesce(cast({c} as varchar), '{NULL_KEY}')" for c in cols]
    return "md5(" + " || '-' || ".join(parts) + ")"


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Round doubles whose last bits depend on the order of summation."""
    return df.withColumns({c: F.round(c, digits) for c in cols})


# --- contests: an order's first supplier against all its others ----------------

_SIDE_COUNTS = {
    "points": "qty",
    "fgm": "n_qty",
    "fga": "qty",
    "fg3m": "a_qty",
    "fta": "2 * lines",
    "ftm": "lines",
    "oreb": "o_lines",
    "dreb": "f_lines",
    "tov": "d_lines",
}


def sides_of(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per side of a contest, from all line rows.

    The lines of an order's smallest supplier are the home side, those of its other
    suppliers the away side, named by the largest of them. Orders of one supplier give a
    single side without an opponent. Lines are dealt by order once; there they collapse per (order, supplier), and both
    sides meet in one aggregate per order, so no table is joined to itself.
    """

    def amount(test: Column) -> Column:
        return F.sum(F.when(test, F.col("l_quantity")).otherwise(0.0))

    measures = {
        "qty": F.sum("l_quantity"),
        "n_qty": amount(F.col("l_returnflag") == "N"),
        "a_qty": amount(F.col("l_returnflag") == "A"),
        "lines": F.count(F.lit(1)),
        "o_lines": F.count_if(F.col("l_linestatus") == "O"),
        "f_lines": F.count_if(F.col("l_linestatus") == "F"),
        "d_lines": F.count_if(F.col("l_discount") > 0.05),
    }
    totals = dealt_once(lines, "l_orderkey").groupBy("l_orderkey", "l_suppkey").agg(*[m.alias(k) for k, m in measures.items()])
    both = totals.groupBy("l_orderkey").agg(
        F.min_by(F.struct("l_suppkey", *measures), "l_suppkey").alias("h"),
        F.max("l_suppkey").alias("last"),
        *[F.sum(k).alias(f"all_{k}") for k in measures],
    )
    away = F.struct(F.col("last").alias("l_suppkey"), *[(F.col(f"all_{k}") - F.col(f"h.{k}")).alias(k) for k in measures])
    pairs = both.select("l_orderkey", "h", F.when(F.col("last") != F.col("h.l_suppkey"), away).alias("a"))
    games = pairs.join(orders, pairs["l_orderkey"] == orders["o_orderkey"])

    def side(own: str, other: str, home: bool) -> Column:
        mine, theirs = F.col(f"{own}.qty"), F.col(f"{other}.qty")
        return F.struct(
            F.col(f"{own}.l_suppkey").alias("team_id"),
            F.col(f"{other}.l_suppkey").alias("opponent_team_id"),
            F.lit(home).alias("is_home"),
            *[
                F.expr(expr.replace("lines", f"{own}.lines") if expr.endswith(" lines") or expr == "lines" else f"{own}.{expr}")
                .cast("int")
                .alias(name)
                for name, expr in _SIDE_COUNTS.items()
            ],
            F.when(mine > theirs, 1).when(mine < theirs, 0).alias("win_flag"),
        )

    year = F.year("o_orderdate")
    kind = F.when(F.col("o_orderstatus") == "F", "2").when(F.col("o_orderstatus") == "O", "4").otherwise("9")
    return games.select(
        F.col("l_orderkey").cast("string").alias("game_id"),
        F.col("o_orderdate").cast("date").alias("game_date"),
        year.alias("season_start_year"),
        F.concat(kind, year.cast("string")).alias("season_id"),
        F.col("o_orderpriority").alias("league"),
        (240 + 25 * (F.col("l_orderkey") % 3)).cast("int").alias("team_minutes"),
        F.explode(F.filter(F.array(side("h", "a", True), side("a", "h", False)), lambda s: s.team_id.isNotNull())).alias("s"),
    ).select("*", "s.*").drop("s")


def sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sides_of(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


def sides_sql(lines: str = "lineitem") -> str:
    counts = ", ".join(f"cast({('t.' + e) if ' ' not in e else '2 * t.lines'} as int) as {n}" for n, e in _SIDE_COUNTS.items())
    return f"""
    order_teams as (
        select l_orderkey as k, min(l_suppkey) as h, max(l_suppkey) as a from {lines} group by l_orderkey),
    line_totals as (
        select l_orderkey, case when l_suppkey = h then h else a end as l_suppkey, sum(l_quantity) as qty,
               sum(case when l_returnflag = 'N' then l_quantity else 0 end) as n_qty,
               sum(case when l_returnflag = 'A' then l_quantity else 0 end) as a_qty,
               count(*) as lines,
               count(*) filter (where l_linestatus = 'O') as o_lines,
               count(*) filter (where l_linestatus = 'F') as f_lines,
               count(*) filter (where l_discount > 0.05) as d_lines
        from {lines} join order_teams on l_orderkey = k group by l_orderkey, case when l_suppkey = h then h else a end),
    sides as (
        select cast(t.l_orderkey as varchar) as game_id, cast(o.o_orderdate as date) as game_date,
               cast(year(o.o_orderdate) as int) as season_start_year,
               (case o.o_orderstatus when 'F' then '2' when 'O' then '4' else '9' end)
                   || cast(year(o.o_orderdate) as varchar) as season_id,
               o.o_orderpriority as league, cast(240 + 25 * (t.l_orderkey % 3) as int) as team_minutes,
               t.l_suppkey as team_id, u.l_suppkey as opponent_team_id, t.l_suppkey = c.h as is_home,
               {counts},
               case when t.qty > u.qty then 1 when t.qty < u.qty then 0 end as win_flag
        from line_totals t
        join order_teams c on t.l_orderkey = c.k
        left join line_totals u on u.l_orderkey = t.l_orderkey and u.l_suppkey <> t.l_suppkey
        join orders o on o.o_orderkey = t.l_orderkey)"""


SIDES_SQL = sides_sql()


# --- careers: customers buying from suppliers, year by year -------------------


def careers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer, year and supplier with summed lines.

    Lines collapse per (order, supplier) before they meet their order.
    """
    raw = table(spark, sf_dir, "lineitem")
    lines = dealt(raw.select("l_orderkey", "l_suppkey", "l_quantity"), "l_orderkey", finely(raw)).groupBy("l_orderkey", "l_suppkey").agg(
        F.count(F.lit(1)).alias("gp"), F.sum("l_quantity").alias("points")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("season"))
    spells = (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .groupBy(F.col("o_custkey").alias("player_id"), "season", F.col("l_suppkey").alias("team_id"))
        .agg(F.sum("gp").alias("gp"), F.sum("points").cast("long").alias("points"))
    )
    names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("team_id"), F.col("s_name").alias("label"))
    return spells.join(names, "team_id", "left")


CAREERS_SQL = """
    careers as (
        select o.o_custkey as player_id, cast(year(o.o_orderdate) as int) as season, l.l_suppkey as team_id,
               count(*) as gp, cast(sum(l.l_quantity) as bigint) as points, any_value(s.s_name) as label
        from lineitem l join orders o on l.l_orderkey = o.o_orderkey
        left join supplier s on l.l_suppkey = s.s_suppkey
        group by 1, 2, 3)"""


# --- a slowly changing customer state -----------------------------------------


def state_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer and order year the last priority and status, valid from the year's first day."""
    orders = table(spark, sf_dir, "orders")
    last = F.max_by(F.struct("o_orderpriority", "o_orderstatus"), F.struct("o_orderdate", "o_orderkey"))
    return (
        orders.groupBy(F.col("o_custkey").alias("player_id"), F.year("o_orderdate").alias("season"))
        .agg(last.alias("s"))
        .select(
            "player_id",
            F.make_date("season", F.lit(1), F.lit(1)).alias("ts"),
            F.col("s.o_orderpriority").alias("priority"),
            F.col("s.o_orderstatus").alias("status"),
        )
    )


STATE_LOG_SQL = """
    state_log as (
        select player_id, make_date(y, 1, 1) as ts, priority, status from (
            select o_custkey as player_id, cast(year(o_orderdate) as int) as y, o_orderpriority as priority,
                   o_orderstatus as status,
                   row_number() over (partition by o_custkey, year(o_orderdate)
                                      order by o_orderdate desc, o_orderkey desc) as rn
            from orders) where rn = 1)"""

STATE_VERSIONS_SQL = (
    STATE_LOG_SQL
    + """,
    state_changes as (
        select *, lag(struct_pack(p := priority, s := status)) over w as before, lag(ts) over w as before_ts
        from state_log window w as (partition by player_id order by ts)),
    state_versions as (
        select player_id, ts as valid_from, priority, status,
               lead(ts) over (partition by player_id order by ts) as valid_to
        from state_changes
        where before_ts is null or before is distinct from struct_pack(p := priority, s := status)),
    state_dim as (
        select *, valid_to is null as is_current,
               md5(cast(player_id as varchar) || '-' || cast(valid_from as varchar)) as player_sk
        from state_versions)"""
)


# --- probability forecasts -----------------------------------------------------


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as forecasts: p from the value in steps of 0.01, outcome = purchase, grouped by day."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.least(F.lit(1.0), F.floor(F.col("value") / 4.0) / 100.0).alias("win_prob"),
        (F.col("event_type") == "purchase").cast("int").alias("won"),
        F.col("ts").cast("date").alias("season"),
        "value",
    )


FORECASTS_SQL = """
    forecasts as (
        select least(1.0::double, floor(value / 4.0) / 100.0::double) as win_prob,
               cast(event_type = 'purchase' as int) as won, cast(ts as date) as season, value
        from events)"""


# --- events with a reused natural key ------------------------------------------


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by user and day; the type stands in for a number that is reused within the game."""
    return table(spark, sf_dir, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("game_id"),
        F.col("event_type").alias("action_number"),
        "value",
        "props",
        "ts",
        "event_id",
    )


ACTIONS_SQL = """
    actions as (
        select cast(user_id as varchar) || '-' || strftime(ts, '%Y%m%d') as game_id, event_type as action_number,
               value, props, ts, event_id from events)"""
