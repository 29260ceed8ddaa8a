"""Queries over pairs, dimensions, lookups and efficiency measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.keys import date_key, surrogate_key
from tidemark.functions.text import period_label
from tidemark.operators import efficiency, history, staging, star
from tidemark.plans.inputs import (
    SIDES_SQL,
    STATE_VERSIONS_SQL,
    STATE_LOG_SQL,
    key_sql,
    rounded,
    sides,
    sides_of,
    sides_sql,
    state_log,
    table,
)
from tidemark.plans.typing_queries import LATEST_LINES_SQL, latest_lines
from tidemark.session import new_path
from tidemark.sources import versions

# --- pairs ---------------------------------------------------------------------


def _collapsed(spark, sf_dir, unique_sides):
    games = star.pair_collapse(
        sides(spark, sf_dir),
        "game_id",
        "is_home",
        ["game_date", "season_id"],
        ["team_id", "points", "win_flag"],
        unique_sides=unique_sides,
    )
    return games.select(
        "game_id",
        "game_date",
        "season_id",
        "home_team_id",
        "away_team_id",
        "home_points",
        "away_points",
        F.col("home_win_flag").alias("home_win"),
        (F.col("home_points") + F.col("away_points")).alias("total_points"),
    )


def pair_collapse(spark, sf_dir):
    return _collapsed(spark, sf_dir, unique_sides=False)


def pair_collapse_unique(spark, sf_dir):
    return _collapsed(spark, sf_dir, unique_sides=True)


PAIR_SQL = f"""
with {SIDES_SQL}
select h.game_id, h.game_date, h.season_id, h.team_id as home_team_id, a.team_id as away_team_id,
       h.points as home_points, a.points as away_points, h.win_flag as home_win, h.points + a.points as total_points
from sides h join sides a on h.game_id = a.game_id where h.is_home and not a.is_home"""


def opponent_join(spark, sf_dir):
    base = sides(spark, sf_dir).select("game_id", "team_id", "opponent_team_id", "points", "fgm", "tov")
    return star.opponent_join(base, "game_id", "team_id", "opponent_team_id", ["points", "fgm", "tov"])


OPPONENT_SQL = f"""
with {SIDES_SQL}
select t.game_id, t.team_id, t.opponent_team_id, t.points, t.fgm, t.tov, o.points as opp_points, o.fgm as opp_fgm,
       o.tov as opp_tov
from sides t join sides o on t.game_id = o.game_id and t.opponent_team_id = o.team_id"""


def opponent_case(spark, sf_dir):
    both = sides(spark, sf_dir).select("game_id", "team_id")
    games = _collapsed(spark, sf_dir, unique_sides=True)
    with_ids = star.lookup(
        both, games, [("game_id", "game_id")], [("home_team_id", "home"), ("away_team_id", "away")], how="inner"
    )
    other = star.opponent_id(F.col("team_id"), F.col("home"), F.col("away"))
    return with_ids.select("game_id", "team_id", other.alias("opponent_team_id"))


_FACTORS = (
    "poss opp_poss pace off_rating def_rating net_rating efg_pct tov_pct oreb_pct ft_rate "
    "opp_efg_pct opp_tov_pct opp_oreb_pct opp_ft_rate"
).split()


def _factors(base):
    paired = star.opponent_columns(base, "game_id", "is_home", efficiency.OPPONENT_INPUTS)
    out = efficiency.four_factors(paired, ["game_id", "team_id", "opponent_team_id", "game_date", "is_home", "win_flag"])
    return rounded(out, 9, *_FACTORS)


def four_factors(spark, sf_dir):
    return _factors(sides(spark, sf_dir))


def team_efficiency(spark, sf_dir):
    """The whole chain: land as text, type, keep the latest line, form sides, pair, four factors."""
    return _factors(sides_of(latest_lines(spark, sf_dir), table(spark, sf_dir, "orders")))


def factor_columns_sql(without=()):
    """The measures of side t against side o."""

    def poss(p=""):
        return f"({p}fga + 0.44::double * {p}fta - {p}oreb + {p}tov)"

    def quotient(a, b):
        return f"(cast({a} as double) / nullif(cast({b} as double), 0))"

    t, o = poss("t."), poss("o.")
    exprs = {
        "poss": t,
        "opp_poss": o,
        "pace": quotient(f"48.0::double * ({t} + {o})", "2.0::double * (t.team_minutes / 5.0::double)"),
        "off_rating": quotient("100.0::double * t.points", t),
        "def_rating": quotient("100.0::double * o.points", o),
        "net_rating": quotient("100.0::double * t.points", t) + " - " + quotient("100.0::double * o.points", o),
        "efg_pct": quotient("t.fgm + 0.5::double * t.fg3m", "t.fga"),
        "tov_pct": quotient("t.tov", "t.fga + 0.44::double * t.fta + t.tov"),
        "oreb_pct": quotient("t.oreb", "t.oreb + o.dreb"),
        "ft_rate": quotient("t.ftm", "t.fga"),
        "opp_efg_pct": quotient("o.fgm + 0.5::double * o.fg3m", "o.fga"),
        "opp_tov_pct": quotient("o.tov", "o.fga + 0.44::double * o.fta + o.tov"),
        "opp_oreb_pct": quotient("o.oreb", "o.oreb + t.dreb"),
        "opp_ft_rate": quotient("o.ftm", "o.fga"),
    }
    return ", ".join(f"round({e}, 9) as {n}" for n, e in exprs.items() if n not in without)


def _factors_sql(ctes):
    return f"""
with {ctes}
select t.game_id, t.team_id, t.opponent_team_id, t.game_date, t.is_home, t.win_flag, {factor_columns_sql()}
from sides t join sides o on t.game_id = o.game_id and t.opponent_team_id = o.team_id"""


FOUR_FACTORS_SQL = _factors_sql(SIDES_SQL)
TEAM_EFFICIENCY_SQL = _factors_sql(LATEST_LINES_SQL + "," + sides_sql("latest_lines"))

# --- dimensions and lookups ------------------------------------------------------


def season_dim(spark, sf_dir):
    return star.season_dim(sides(spark, sf_dir), "season_id")


_SEASONS = f"""
    seasons as (
        select {key_sql("season_id")} as season_key, season_id,
               substr(season_id, 2, 4) || '-' || right(cast(cast(substr(season_id, 2, 4) as int) + 1 as varchar), 2) as season,
               cast(substr(season_id, 2, 4) as int) as season_start_year,
               case substr(season_id, 1, 1) when '2' then 'Regular Season' when '4' then 'Playoffs' else 'Unknown' end
                   as season_type
        from (select distinct season_id from sides))"""


def unify_variants(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus"))
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))
    )
    return staging.unify_variants(orders, lines, ["o_orderkey", "o_orderstatus"], ["lines", "quantity"])


UNIFY_SQL = """
select o_orderkey, o_orderstatus, o_totalprice, lines, quantity
from orders left join (select l_orderkey, l_linestatus, count(*) as lines, sum(l_quantity) as quantity
                       from lineitem group by 1, 2) on l_orderkey = o_orderkey and l_linestatus = o_orderstatus"""


def variant_fallback(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    newer = orders.where("o_orderstatus <> 'F'").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")).alias("price"), "o_orderpriority"
    )
    older = orders.where("o_orderstatus <> 'O'").select(
        "o_orderkey", (F.col("o_totalprice") + 1).alias("price"), F.lit("old").alias("o_orderpriority")
    )
    return staging.variant_fallback(newer, older, ["o_orderkey"], ["price", "o_orderpriority"])


FALLBACK_SQL = """
select o_orderkey, case when o_orderstatus = 'O' then o_totalprice else o_totalprice + 1 end as price,
       case when o_orderstatus = 'F' then 'old' else o_orderpriority end as o_orderpriority
from orders"""


def fact_inner_dim(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumns(
        {"order_sk": surrogate_key("o_orderkey"), "date_key": date_key("o_orderdate")}
    )
    dim = orders.where("o_orderstatus <> 'P'")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return star.lookup(
        lines, dim, [("l_orderkey", "o_orderkey")], [("order_sk", "order_sk"), ("date_key", "date_key")], how="inner"
    )


FACT_INNER_SQL = f"""
select l_orderkey, l_linenumber, l_quantity, {key_sql("o_orderkey")} as order_sk,
       cast(strftime(o_orderdate, '%Y%m%d') as int) as date_key
from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus <> 'P'"""


def _customer_dim(spark, sf_dir):
    log = state_log(spark, sf_dir)
    return history.scd2_dim(history.scd2_history(log, "player_id", ["priority", "status"], "ts"), "player_id", "player_sk")


def scd2_current_lookup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("player_id"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("player_id"))
    # customers without any order have no version and keep a NULL key
    facts = orders.unionByName(customers.select(F.lit(None).cast("long").alias("o_orderkey"), "player_id"))
    return star.current_lookup(facts, _customer_dim(spark, sf_dir), "player_id", "player_sk")


CURRENT_SQL = f"""
with {STATE_VERSIONS_SQL}
select o_orderkey, f.player_id, player_sk
from (select o_orderkey, o_custkey as player_id from orders union all select null, c_custkey from customer) f
left join (select * from state_dim where is_current) d on f.player_id = d.player_id"""


def scd2_asof_lookup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("player_id"), F.add_months(F.col("o_orderdate").cast("date"), -6).alias("as_of")
    )
    return history.asof_lookup(orders, _customer_dim(spark, sf_dir), "player_id", "as_of", "player_sk")


def scd2_asof_merge(spark, sf_dir):
    """The same lookup by merging facts and versions in time order."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("player_id"), F.add_months(F.col("o_orderdate").cast("date"), -6).alias("as_of")
    )
    return history.asof_lookup(orders, _customer_dim(spark, sf_dir), "player_id", "as_of", "player_sk")


ASOF_SQL = f"""
with {STATE_VERSIONS_SQL},
f as (select o_orderkey, o_custkey as player_id, cast(cast(o_orderdate as date) - interval 6 month as date) as as_of
      from orders)
select o_orderkey, f.player_id, as_of, player_sk
from f left join state_dim d
  on f.player_id = d.player_id and as_of >= valid_from and (valid_to is null or as_of < valid_to)"""


def role_playing_dim(spark, sf_dir):
    teams = table(spark, sf_dir, "supplier").select("s_suppkey", surrogate_key("s_suppkey", "s_name").alias("team_sk"))
    games = _collapsed(spark, sf_dir, unique_sides=True).select("game_id", "home_team_id", "away_team_id")
    home = star.lookup(games, teams, [("home_team_id", "s_suppkey")], [("team_sk", "home_team_sk")])
    return star.lookup(home, teams, [("away_team_id", "s_suppkey")], [("team_sk", "away_team_sk")])


ROLE_SQL = f"""
with {SIDES_SQL},
teams as (select s_suppkey, {key_sql("s_suppkey", "s_name")} as team_sk from supplier)
select game_id, team_id as home_team_id, opponent_team_id as away_team_id, h.team_sk as home_team_sk,
       a.team_sk as away_team_sk
from sides left join teams h on h.s_suppkey = team_id left join teams a on a.s_suppkey = opponent_team_id
where is_home and opponent_team_id is not null"""


def filtered_dim_join(spark, sf_dir):
    base = sides(spark, sf_dir)
    regular = star.season_dim(base, "season_id").where("season_type = 'Regular Season' and season_start_year > 1996")
    years = base.select("game_id", "team_id", period_label("season_start_year").alias("season"))
    return star.lookup(years, regular, [("season", "season")], [("season_key", "season_key")])


FILTERED_SQL = f"""
with {SIDES_SQL}, {_SEASONS}
select game_id, team_id, l.season, s.season_key
from (select game_id, team_id,
             cast(season_start_year as varchar) || '-' || right(cast(season_start_year + 1 as varchar), 2) as season
      from sides) l
left join (select * from seasons where season_type = 'Regular Season' and season_start_year > 1996) s
  on l.season = s.season"""

# --- history ---------------------------------------------------------------------


def scd2_history(spark, sf_dir):
    return history.scd2_history(state_log(spark, sf_dir), "player_id", ["priority", "status"], "ts")


def scd2_dim(spark, sf_dir):
    return _customer_dim(spark, sf_dir)


RUNS = ("1996-06-30", "1998-06-30", "2000-06-30", "2002-06-30")


def _seen_until(log, day):
    """The source as a run on that day finds it: each customer's latest state, if any."""
    known = log.where(F.col("ts") <= F.lit(day).cast("date"))
    last = F.max_by(F.struct("priority", "status", F.col("ts").alias("source_day")), "ts")
    return known.groupBy("player_id").agg(last.alias("s")).select("player_id", "s.*")


def scd2_apply(spark, sf_dir):
    log, found = state_log(spark, sf_dir), None
    for day in RUNS:
        found = history.scd2_apply(found, _seen_until(log, day), "player_id", ["priority", "status"], F.lit(day).cast("date"))
    return found


def scd2_store(spark, sf_dir):
    """The same runs into a stored table."""
    log, path = state_log(spark, sf_dir), new_path(spark, "history")
    for day in RUNS:
        snapshot = _seen_until(log, day)
        history.scd2_store(snapshot, path, "player_id", ["priority", "status"], F.lit(day).cast("date"), buckets=8)
    schema = snapshot.select("*", F.lit(day).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to")).schema
    return versions.read(spark, path, schema)


APPLY_SQL = f"""
with {STATE_LOG_SQL},
runs(run) as (values (date '1996-06-30'), (date '1998-06-30'), (date '2000-06-30'), (date '2002-06-30')),
snaps as (
    select run, player_id, priority, status, ts as source_day from (
        select *, row_number() over (partition by run, player_id order by ts desc) as rn
        from runs join state_log on ts <= run) where rn = 1),
flagged as (
    select *, lag(struct_pack(p := priority, s := status)) over w as before, lag(run) over w as before_run
    from snaps window w as (partition by player_id order by run))
select player_id, priority, status, source_day, run as valid_from,
       lead(run) over (partition by player_id order by run) as valid_to
from flagged where before_run is null or before is distinct from struct_pack(p := priority, s := status)"""

QUERIES = {
    "team_efficiency": team_efficiency,
    "pair_collapse": pair_collapse,
    "pair_collapse_unique": pair_collapse_unique,
    "opponent_join": opponent_join,
    "opponent_case": opponent_case,
    "four_factors": four_factors,
    "season_dim": season_dim,
    "unify_variants": unify_variants,
    "variant_fallback": variant_fallback,
    "fact_inner_dim": fact_inner_dim,
    "scd2_current_lookup": scd2_current_lookup,
    "scd2_asof_lookup": scd2_asof_lookup,
    "scd2_asof_merge": scd2_asof_merge,
    "role_playing_dim": role_playing_dim,
    "filtered_dim_join": filtered_dim_join,
    "scd2_history": scd2_history,
    "scd2_dim": scd2_dim,
    "scd2_apply": scd2_apply,
    "scd2_store": scd2_store,
}

ORACLE = {
    "team_efficiency": TEAM_EFFICIENCY_SQL,
    "pair_collapse": PAIR_SQL,
    "pair_collapse_unique": PAIR_SQL,
    "opponent_join": OPPONENT_SQL,
    "opponent_case": f"with {SIDES_SQL} select game_id, team_id, opponent_team_id from sides where opponent_team_id is not null",
    "four_factors": FOUR_FACTORS_SQL,
    "season_dim": f"with {SIDES_SQL}, {_SEASONS} select * from seasons",
    "unify_variants": UNIFY_SQL,
    "variant_fallback": FALLBACK_SQL,
    "fact_inner_dim": FACT_INNER_SQL,
    "scd2_current_lookup": CURRENT_SQL,
    "scd2_asof_lookup": ASOF_SQL,
    "scd2_asof_merge": ASOF_SQL,
    "role_playing_dim": ROLE_SQL,
    "filtered_dim_join": FILTERED_SQL,
    "scd2_history": f"with {STATE_VERSIONS_SQL} select player_id, valid_from, priority, status, valid_to from state_versions",
    "scd2_dim": f"""with {STATE_VERSIONS_SQL}
                    select player_id, valid_from, priority, status, valid_to, is_current, player_sk from state_dim""",
    "scd2_apply": APPLY_SQL,
    "scd2_store": APPLY_SQL,
}
