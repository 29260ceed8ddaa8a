"""Queries that run the warehouse's tables on raw tables derived from the given ones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import functions as F

from tidemark.functions.rates import ratio
from tidemark.functions.text import period_label
from tidemark.operators.ordered import dealt_once
from tidemark.plans import table_functions
from tidemark.plans import warehouse as wh
from tidemark.plans.inputs import CAREERS_SQL, SIDES_SQL, careers, key_sql, rounded, sides, table
from tidemark.plans.star_queries import factor_columns_sql
from tidemark.session import written
from tidemark.sources.bronze import stringify

RUN_DAY = "2002-01-01"


def _tag(c):
    return F.concat(F.lit("T"), F.lpad((F.col(c) % 100).cast("string"), 2, "0"))


class RawTables(Mapping):
    """The nine raw tables: suppliers as teams, customers and parts as players, shared orders as games.

    Each is planned when first asked for, with every column as text.
    """

    def __init__(self, spark, sf_dir):
        self._spark, self._dir, self._done = spark, sf_dir, {}

    def __getitem__(self, name):
        if name not in self._done:
            df = _RAW[name](self._spark, self._dir)
            self._done[name] = df.select(*stringify(df))
        return self._done[name]

    def __iter__(self):
        return iter(_RAW)

    def __len__(self):
        return len(_RAW)


col, lit = F.col, F.lit


def _no_text(*names):
    return [F.expr(f"cast(null as string) as {n}") for n in names]


def _blank(*names):
    return [F.expr(f"'' as {n}") for n in names]


def _raw_teams(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(
        col("s_suppkey").alias("ID"),
        col("s_name").alias("FULL_NAME"),
        _tag("s_suppkey").alias("ABBREVIATION"),
        F.concat(lit("N"), "s_nationkey").alias("NICKNAME"),
        F.concat(lit("City "), "s_nationkey").alias("CITY"),
        *_no_text("STATE"),
        (col("s_nationkey") + 1946).alias("YEAR_FOUNDED"),
    )


def _raw_players(spark, sf_dir):
    person = table(spark, sf_dir, "customer").select(
        col("c_custkey").alias("PERSON_ID"),
        col("c_name").alias("DISPLAY_FIRST_LAST"),
        F.concat("c_mktsegment", lit(", "), "c_name").alias("DISPLAY_LAST_COMMA_FIRST"),
        (col("c_acctbal") > 0).cast("int").alias("ROSTERSTATUS"),
        col("c_nationkey").alias("TEAM_ID"),
        _tag("c_nationkey").alias("TEAM_ABBREVIATION"),
        (col("c_nationkey") + 1980).alias("FROM_YEAR"),
        F.lower("c_name").alias("PLAYER_SLUG"),
    )
    earlier = person.where("ROSTERSTATUS = 1").withColumns({"TO_YEAR": lit(1999), "TEAM_ABBREVIATION": lit("OLD")})
    return person.withColumn("TO_YEAR", lit(2000)).unionByName(earlier)


def _raw_team_games(spark, sf_dir):
    return sides(spark, sf_dir).select(
        col("game_id").alias("GAME_ID"),
        col("team_id").alias("TEAM_ID"),
        _tag("team_id").alias("TEAM_ABBREVIATION"),
        col("season_id").alias("SEASON_ID"),
        col("game_date").alias("GAME_DATE"),
        F.concat(_tag("team_id"), F.when(col("is_home"), " vs. ").otherwise(" @ "), _tag("opponent_team_id")).alias("MATCHUP"),
        F.when(col("win_flag") == 1, "W").when(col("win_flag") == 0, "L").alias("WL"),
        col("team_minutes").alias("MIN"),
        col("points").alias("PTS"),
        *[col(c).alias(c.upper()) for c in ("fgm", "fga", "fg3m", "ftm", "fta", "oreb", "dreb", "tov")],
        ratio(col("fgm"), col("fga")).alias("FG_PCT"),
        (col("fg3m") + 1).alias("FG3A"),
        ratio(col("fg3m"), col("fg3m") + 1).alias("FG3_PCT"),
        ratio(col("ftm"), col("fta")).alias("FT_PCT"),
        (col("oreb") + col("dreb")).alias("REB"),
        *_no_text("AST", "STL", "BLK", "PF", "PLUS_MINUS"),
    )


def _lines(spark, sf_dir):
    # numbers in place of the flag's text keep the aggregate hashed; dealt by the game's text, the rows stay where they are
    rank = F.when(col("l_returnflag") == "R", 3).when(col("l_returnflag") == "N", 2).otherwise(1)
    game = col("l_orderkey").cast("string")
    lines = dealt_once(table(spark, sf_dir, "lineitem").withColumn("rank", rank), game)
    lines = lines.groupBy(game.alias("game"), "l_suppkey", "l_partkey").agg(
        F.sum("l_quantity").cast("int").alias("q"),
        F.max("rank").alias("rank"),
        F.count(lit(1)).alias("n"),
        F.max("l_linenumber").alias("no"),
    )
    return lines.withColumn("flag", F.element_at(F.array(lit("A"), lit("N"), lit("R")), col("rank")))


def _raw_box(spark, sf_dir):
    unset = [
        "fieldGoalsPercentage", "threePointersMade", "threePointersAttempted", "threePointersPercentage",
        "freeThrowsMade", "freeThrowsAttempted", "freeThrowsPercentage", "reboundsOffensive", "reboundsDefensive",
        "reboundsTotal", "assists", "steals", "blocks", "turnovers", "foulsPersonal", "plusMinusPoints",
    ]
    return _lines(spark, sf_dir).select(
        col("game").alias("gameId"),
        col("l_suppkey").alias("teamId"),
        _tag("l_suppkey").alias("teamTricode"),
        col("l_partkey").alias("personId"),
        F.concat(lit("P"), col("l_partkey").cast("string")).alias("nameI"),
        F.when(col("n") > 1, "G").otherwise("").alias("position"),
        F.when(col("flag") == "R", "DNP").otherwise("").alias("comment"),
        col("no").alias("jerseyNum"),
        F.concat(lit("PT"), col("q").cast("string"), lit("M30.00S")).alias("minutes"),
        F.when(col("flag") == "N", col("q")).otherwise(0).alias("fieldGoalsMade"),
        col("q").alias("fieldGoalsAttempted"),
        (col("q") * 10_000 + col("l_suppkey") % 10_000).cast("int").alias("points"),  # no ties in the deduplication
        *_blank(*unset),
    )


def _raw_advanced(spark, sf_dir):
    unset = [
        "defensiveRating", "netRating", "assistPercentage", "assistToTurnover", "offensiveReboundPercentage",
        "defensiveReboundPercentage", "reboundPercentage", "turnoverRatio", "effectiveFieldGoalPercentage",
        "trueShootingPercentage", "usagePercentage", "pace",
    ]
    return _lines(spark, sf_dir).where("flag <> 'A'").select(
        col("game").alias("gameId"),
        col("l_partkey").alias("personId"),
        (col("q") / 2).alias("offensiveRating"),
        col("q").cast("double").alias("possessions"),
        (col("l_suppkey") / 4).alias("PIE"),
        *_blank(*unset),
    )


def _raw_events(spark, sf_dir):
    kind = col("event_type")
    return table(spark, sf_dir, "events").select(
        F.floor(col("event_id") / 10).alias("gameId"),
        F.get_json_object("props", "$.k").alias("actionNumber"),
        F.date_format("ts", "HH:mm").alias("clock"),
        (F.floor(F.hour("ts") / 6) + 1).alias("period"),
        F.when(kind == "signup", 0).otherwise(col("user_id")).alias("teamId"),
        F.when(kind == "view", 0).otherwise(col("user_id")).alias("personId"),
        F.concat(lit("U"), col("user_id").cast("string")).alias("playerName"),
        kind.alias("actionType"),
        F.when(kind == "error", "Jump 3PT shot").when(kind != "click", F.concat(lit("Shot "), kind)).alias("description"),
        F.when(kind == "signup", "0").when(kind == "view", "TRUE").otherwise("1").alias("isFieldGoal"),
        F.when(col("value") > 30, "Made").when(col("value") > 5, "Missed").alias("shotResult"),
        F.when(col("value") < 100, col("value")).alias("shotDistance"),
        *_no_text("teamTricode", "subType"),
        *_blank("scoreHome", "scoreAway", "xLegacy", "yLegacy"),
    )


def _raw_career(spark, sf_dir):
    return careers(spark, sf_dir).select(
        col("player_id").alias("PLAYER_ID"),
        period_label("season").alias("SEASON_ID"),
        col("team_id").alias("TEAM_ID"),
        F.when(col("points") < 5, "TOT").otherwise(col("label")).alias("TEAM_ABBREVIATION"),
        lit("23.0").alias("PLAYER_AGE"),
        col("gp").alias("GP"),
        col("points").alias("PTS"),
        *_blank("GS", "MIN", "REB", "AST", "STL", "BLK", "TOV", "FGM", "FGA", "FG3M", "FG3A", "FTM", "FTA"),
    )


def _raw_roster(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        col("c_nationkey").alias("TeamID"),
        lit("1999").alias("SEASON"),
        col("c_custkey").alias("PLAYER_ID"),
        col("c_name").alias("PLAYER"),
        F.when(col("c_acctbal") < 0, "R").otherwise(F.floor("c_acctbal").cast("string")).alias("EXP"),
        *_no_text("NICKNAME", "PLAYER_SLUG", "NUM", "POSITION", "HEIGHT", "BIRTH_DATE", "SCHOOL"),
        col("c_mktsegment").alias("HOW_ACQUIRED"),
        lit("n/a").alias("WEIGHT"),
        col("c_acctbal").alias("AGE"),
    )


def _raw_coaches(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(
        col("s_nationkey").alias("TEAM_ID"),
        lit("2009").alias("SEASON"),
        col("s_suppkey").alias("COACH_ID"),
        *_no_text("FIRST_NAME", "LAST_NAME"),
        col("s_name").alias("COACH_NAME"),
        F.when(col("s_acctbal") > 5000, "Head Coach").when(col("s_acctbal") > 0, "Assistant Coach").alias("COACH_TYPE"),
        lit("2").alias("IS_ASSISTANT"),
        *_blank("SORT_SEQUENCE"),
        lit("3").alias("SUB_SORT_SEQUENCE"),
    )


_RAW = {
    wh.TEAMS: _raw_teams,
    wh.PLAYERS: _raw_players,
    wh.TEAM_GAMES: _raw_team_games,
    wh.BOX_SCORE: _raw_box,
    wh.BOX_SCORE_ADVANCED: _raw_advanced,
    wh.PLAY_BY_PLAY: _raw_events,
    wh.CAREER: _raw_career,
    wh.ROSTER: _raw_roster,
    wh.COACHES: _raw_coaches,
}


def warehouse(spark, sf_dir, stored=("stg_team_game",)):
    """The warehouse of one run; tables that its queries read several times are written first."""
    w = wh.Warehouse(spark, RawTables(spark, sf_dir), F.lit(f"{RUN_DAY} 00:00:00").cast("timestamp_ntz"))
    for name in stored:
        setattr(w, name, written(getattr(w, name), name))
    return w


def _table(name, stored=("stg_team_game",)):
    def query(spark, sf_dir):
        return getattr(warehouse(spark, sf_dir, stored), name)

    query.__name__ = name
    return query


def mart_team_four_factors(spark, sf_dir):
    out = warehouse(spark, sf_dir).mart_team_four_factors
    return rounded(out, 9, *[c for c in out.columns if c not in wh.EFFICIENCY_KEYS])


def int_team_game__advanced(spark, sf_dir):
    out = warehouse(spark, sf_dir).int_team_game__advanced
    return rounded(out, 9, *[c for c in out.columns if c not in wh.EFFICIENCY_KEYS])


def top_scorers(spark, sf_dir):
    return wh.top_scorers(warehouse(spark, sf_dir).fact_player_season, "1998-99", 50)


def top_scorers_sql(spark, sf_dir):
    """The same by a table function of SQL."""
    table_functions.register(spark, {"fact_player_season": warehouse(spark, sf_dir).fact_player_season}, "asked_")
    return spark.sql("SELECT player_id, player_name, points, games FROM top_scorers('1998-99', 50)")


def shot_profiles_sql(spark, sf_dir):
    """A table function asked for every player and season in a lateral join."""
    table_functions.register(spark, {"fact_shot": warehouse(spark, sf_dir).fact_shot}, "asked_")
    out = spark.sql(
        """SELECT p.player_id, p.season_key, t.* FROM (
             SELECT DISTINCT player_id, season_key FROM asked_fact_shot WHERE player_id IS NOT NULL AND season_key IS NOT NULL) p,
           LATERAL player_shot_profile(p.player_id, p.season_key) t"""
    )
    return rounded(out, 9, "make_pct")


QUERIES = {name: _table(name, stored=()) for name in ("stg_team_roster", "stg_team_coach", "dim_team", "dim_player")}
QUERIES |= {
    name: _table(name)
    for name in (
        "dim_game", "fact_team_game", "fact_player_game", "fact_play_by_play", "fact_shot", "fact_player_season",
        "mart_player_team_tenure",
    )
}
QUERIES |= {"int_team_game__advanced": int_team_game__advanced, "mart_team_four_factors": mart_team_four_factors}
QUERIES |= {"top_scorers": top_scorers, "top_scorers_sql": top_scorers_sql, "shot_profiles_sql": shot_profiles_sql}

# --- the same in SQL --------------------------------------------------------------

_VERSION = f"timestamp '{RUN_DAY} 00:00:00'"


def _sk(key):
    return f"md5(cast({key} as varchar) || '-{RUN_DAY} 00:00:00')"


def _tag_sql(c):
    return f"'T' || lpad(cast({c} % 100 as varchar), 2, '0')"


def _label_sql(year):
    return f"cast({year} as varchar) || '-' || right(cast({year} + 1 as varchar), 2)"


_BASE = f"""
with recursive {SIDES_SQL}, {CAREERS_SQL},
season as (
    select season_id, {key_sql("season_id")} as season_key, {_label_sql("cast(substr(season_id, 2, 4) as int)")} as season,
           case substr(season_id, 1, 1) when '2' then 'Regular Season' when '4' then 'Playoffs' else 'Unknown' end
               as season_type
    from (select distinct season_id from sides)),
team as (select s_suppkey as team_id, {_sk("s_suppkey")} as team_sk from supplier),
player as (select c_custkey as player_id, {_sk("c_custkey")} as player_sk, c_name as player_name from customer),
game as (
    select {key_sql("h.game_id")} as game_sk, h.game_id, h.game_date, cast(strftime(h.game_date, '%Y%m%d') as int) as date_key,
           {key_sql("h.season_id")} as season_key, h.team_id as home_team_id, h.opponent_team_id as away_team_id,
           ht.team_sk as home_team_sk, aw.team_sk as away_team_sk, {_tag_sql("h.team_id")} as home_abbreviation,
           {_tag_sql("h.opponent_team_id")} as away_abbreviation, h.points as home_points, a.points as away_points,
           h.win_flag as home_win, h.points + a.points as total_points
    from sides h join sides a on h.game_id = a.game_id and not a.is_home
    left join team ht on ht.team_id = h.team_id left join team aw on aw.team_id = h.opponent_team_id
    where h.is_home),
team_game as (
    select {key_sql("s.game_id", "s.team_id")} as team_game_sk, {key_sql("s.game_id")} as game_sk, s.game_id, s.team_id,
           s.opponent_team_id, t.team_sk, o.team_sk as opponent_team_sk,
           cast(strftime(s.game_date, '%Y%m%d') as int) as date_key, {key_sql("s.season_id")} as season_key, s.game_date,
           s.is_home, case s.win_flag when 1 then 'W' when 0 then 'L' end as win_loss, s.win_flag, s.team_minutes, s.points,
           s.fgm, s.fga, s.fgm / nullif(s.fga, 0) as fg_pct, s.fg3m, s.fg3m + 1 as fg3a, s.fg3m / (s.fg3m + 1) as fg3_pct,
           s.ftm, s.fta, s.ftm / nullif(s.fta, 0) as ft_pct, s.oreb, s.dreb, s.oreb + s.dreb as reb,
           cast(null as int) as ast, cast(null as int) as stl, cast(null as int) as blk, s.tov, cast(null as int) as pf,
           cast(null as double) as plus_minus, s.season_start_year
    from sides s left join team t on t.team_id = s.team_id left join team o on o.team_id = s.opponent_team_id),
line as (
    select l_orderkey, l_suppkey, l_partkey, cast(sum(l_quantity) as int) as q, max(l_returnflag) as flag, count(*) as n
    from lineitem group by 1, 2, 3),
box as (
    select * from (select *, row_number() over (partition by l_orderkey, l_partkey order by q desc, l_suppkey desc) as rn from line)
    where rn = 1),
adv as (
    select * from (select *, row_number() over (partition by l_orderkey, l_partkey order by l_suppkey desc) as rn
                   from line where flag <> 'A') where rn = 1),
events_typed as (
    select cast(event_id // 10 as varchar) as game_id, cast(props->>'$.k' as int) as action_number,
           strftime(ts, '%H:%M') as clock, cast(hour(ts) // 6 + 1 as int) as period,
           nullif(case when event_type = 'signup' then 0 else user_id end, 0) as team_id,
           nullif(case when event_type = 'view' then 0 else user_id end, 0) as player_id,
           'U' || cast(user_id as varchar) as player_name, event_type as action_type,
           case when event_type = 'error' then 'Jump 3PT shot' when event_type <> 'click' then 'Shot ' || event_type end
               as description,
           event_type <> 'signup' as is_field_goal,
           case when value > 30 then 'Made' when value > 5 then 'Missed' end as shot_result,
           case when value < 100 then value end as shot_distance
    from events),
event as (
    select *, cast(row_number() over (
               partition by game_id, action_number
               order by description nulls last, shot_result nulls last, team_id nulls last, player_id nulls last,
                        clock, period, player_name, action_type, is_field_goal, shot_distance nulls last) as int) as action_seq
    from (select distinct * from events_typed)),
career as (
    select player_id, {_label_sql("season")} as season, team_id,
           case when points < 5 then 'TOT' else label end as team_abbreviation, gp, points
    from careers),
player_season as (
    select {key_sql("c.player_id", "c.season", "c.team_id")} as player_season_sk, c.player_id, p.player_sk, p.player_name,
           c.season, s.season_key, c.team_id, t.team_sk, c.team_abbreviation, cast(null as int) as player_age,
           cast(c.gp as int) as gp, cast(c.points as int) as points
    from career c left join player p on p.player_id = c.player_id left join team t on t.team_id = c.team_id
    left join (select * from season where season_type = 'Regular Season') s on s.season = c.season
    where c.team_abbreviation <> 'TOT' and c.team_id <> 0)
"""


def _nulls(kind, *names):
    return ", ".join(f"cast(null as {kind}) as {n}" for n in names)


_BOX_EMPTY_INT = ("fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb", "ast", "stl", "blk", "tov", "pf")
_BOX_EMPTY = ("fg_pct", "fg3_pct", "ft_pct", "plus_minus", "defensive_rating", "net_rating", "usage_pct", "efg_pct", "ts_pct", "pace")
_TEAM_GAME_COLUMNS = "* exclude (season_start_year)"

_PLAYER_GAME = f"""
select {key_sql("b.l_orderkey", "b.l_partkey")} as player_game_sk, g.game_sk, g.game_id, b.l_partkey as player_id,
       b.l_suppkey as team_id, case when b.l_suppkey = g.home_team_id then g.away_team_id else g.home_team_id end
           as opponent_team_id,
       p.player_sk, t.team_sk, g.date_key, g.season_key, g.game_date, 'P' || cast(b.l_partkey as varchar) as player_name,
       case when b.n > 1 then 'G' else '' end as position, case when b.flag = 'R' then 'DNP' else '' end as comment,
       b.flag <> 'R' as did_play, b.q * 60 + 30 as seconds_played, case when b.flag = 'N' then b.q else 0 end as fgm,
       b.q as fga, cast(b.q * 10000 + b.l_suppkey % 10000 as int) as points, {_nulls("int", *_BOX_EMPTY_INT)}, {_nulls("double", *_BOX_EMPTY)},
       a.q / 2 as offensive_rating, cast(a.q as double) as possessions, a.l_suppkey / 4 as pie
from box b join game g on g.game_id = cast(b.l_orderkey as varchar)
left join adv a on a.l_orderkey = b.l_orderkey and a.l_partkey = b.l_partkey
left join team t on t.team_id = b.l_suppkey left join player p on p.player_id = b.l_partkey"""

_EVENT_KEY = key_sql("e.game_id", "e.action_number", "e.action_seq")
_PLAY_BY_PLAY = f"""
select {_EVENT_KEY} as event_sk, g.game_sk, e.game_id, e.action_number, e.action_seq, e.period, e.clock, e.team_id,
       t.team_sk, e.player_id, p.player_sk, g.date_key, g.season_key, e.action_type, {_nulls("varchar", "sub_type")},
       e.description, {_nulls("int", "score_home", "score_away")}, e.is_field_goal, e.shot_result
from event e join game g on g.game_id = e.game_id
left join team t on t.team_id = e.team_id left join player p on p.player_id = e.player_id"""

_SHOT = f"""
select {_EVENT_KEY} as shot_sk, g.game_sk, e.game_id, e.player_id, p.player_sk, e.team_id, t.team_sk,
       md5(e.shot_zone) as shot_zone_key, g.date_key, g.season_key, g.game_date, e.period, e.shot_zone, e.is_three,
       e.shot_result = 'Made' as is_made, case when e.is_three then 3 else 2 end as shot_value,
       case when e.shot_result = 'Made' then case when e.is_three then 3 else 2 end else 0 end as points,
       e.shot_distance, {_nulls("double", "x_legacy", "y_legacy")}, e.description
from (select *, lower(description) like '%3pt%' as is_three,
             case when lower(description) like '%3pt%' then 'Three Point' when shot_distance is null then 'Unknown'
                  when shot_distance <= 4 then 'Restricted Area' when shot_distance <= 14 then 'Paint (Non-RA)'
                  else 'Mid-Range' end as shot_zone
      from event where is_field_goal) e
join game g on g.game_id = e.game_id
left join team t on t.team_id = e.team_id left join player p on p.player_id = e.player_id"""

_CAREER_EMPTY = ("gs", "reb", "ast", "stl", "blk", "tov", "fgm", "fga", "fg3m", "fg3a", "ftm", "fta")

ORACLE = {
    "stg_team_roster": f"""
select c_nationkey::bigint as team_id, '1999-00' as season, c_custkey as player_id, c_name as player_name,
       {_nulls("varchar", "nickname", "player_slug", "jersey_number", "position", "height", "birth_date", "school")},
       cast(null as int) as weight_lbs, c_acctbal as age,
       case when c_acctbal < 0 then 0 else cast(floor(c_acctbal) as int) end as experience_years,
       c_mktsegment as how_acquired
from customer""",
    "stg_team_coach": f"""
select s_nationkey::bigint as team_id, '2009-10' as season, s_suppkey as coach_id,
       {_nulls("varchar", "first_name", "last_name")}, s_name as coach_name,
       case when s_acctbal > 5000 then 'Head Coach' when s_acctbal > 0 then 'Assistant Coach' end as coach_type,
       2 as is_assistant_code, s_acctbal > 5000 as is_head_coach, s_acctbal > 0 and s_acctbal <= 5000 as is_assistant_coach,
       cast(null as int) as sort_sequence, 3 as sub_sort_sequence
from supplier""",
    "dim_team": f"""
select {_sk("s_suppkey")} as team_sk, s_suppkey as team_id, s_name as team_name, {_tag_sql("s_suppkey")} as team_abbreviation,
       'City ' || cast(s_nationkey as varchar) as team_city, 'N' || cast(s_nationkey as varchar) as team_nickname,
       cast(null as varchar) as team_state, 1946 + s_nationkey as year_founded, {_VERSION} as valid_from,
       cast(null as timestamp) as valid_to, true as is_current
from supplier""",
    "dim_player": f"""
select {_sk("c_custkey")} as player_sk, c_custkey as player_id, c_name as player_name,
       c_mktsegment || ', ' || c_name as player_name_last_first, cast(c_acctbal > 0 as int) as roster_status,
       cast(nullif(c_nationkey, 0) as bigint) as team_id, {_tag_sql("c_nationkey")} as team_abbreviation,
       1980 + c_nationkey as from_year, 2000 as to_year, lower(c_name) as player_slug, {_VERSION} as valid_from,
       cast(null as timestamp) as valid_to, true as is_current
from customer""",
    "dim_game": _BASE + "select * from game",
    "fact_team_game": _BASE + f"select {_TEAM_GAME_COLUMNS} from team_game where opponent_team_id is not null",
    "fact_player_game": _BASE + _PLAYER_GAME,
    "fact_play_by_play": _BASE + _PLAY_BY_PLAY,
    "fact_shot": _BASE + _SHOT,
    "fact_player_season": _BASE
    + f"select *, {_nulls('int', *_CAREER_EMPTY)}, {_nulls('double', 'minutes')} from player_season",
    "mart_player_team_tenure": _BASE
    + """
select player_id, any_value(player_name) as player_name, team_id, any_value(team_abbreviation) as team_abbreviation,
       count(distinct season) as seasons, min(season) as first_season, max(season) as last_season,
       cast(sum(gp) as bigint) as games_played, cast(sum(points) as bigint) as total_points
from player_season group by player_id, team_id""",
    "int_team_game__advanced": _BASE
    + f"""
select {", ".join("t." + c for c in wh.EFFICIENCY_KEYS)}, {factor_columns_sql()}
from team_game t join team_game o on t.game_id = o.game_id and t.opponent_team_id = o.team_id""",
    "mart_team_four_factors": _BASE
    + f"""
select {", ".join("t." + c for c in wh.EFFICIENCY_KEYS)}, {factor_columns_sql(without=["opp_poss"])}
from team_game t join team_game o on t.game_id = o.game_id and t.opponent_team_id = o.team_id""",
    "top_scorers": _BASE
    + """
select player_id, max(player_name) as player_name, cast(sum(points) as bigint) as points, cast(sum(gp) as bigint) as games
from player_season where season = '1998-99' group by player_id order by points desc, player_id limit 50""",
}
ORACLE["top_scorers_sql"] = ORACLE["top_scorers"]
ORACLE["shot_profiles_sql"] = f"""{_BASE}
select player_id, season_key, shot_zone, count(*) as attempts, count(*) filter (where is_made) as makes, cast(sum(points) as bigint) as points,
       round(count(*) filter (where is_made) / count(*), 9) as make_pct
from ({_SHOT}) as f where player_id is not null and season_key is not null group by 1, 2, 3"""
