"""Queries over marts, cohorts, calibration and the analytics features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import calibration, efficiency, incremental, marts, ridge, similarity, staging, stints
from tidemark.plans.inputs import (
    CAREERS_SQL,
    FORECASTS_SQL,
    SIDES_SQL,
    careers,
    finely,
    forecasts,
    rounded,
    sides,
    table,
)
from tidemark.plans.typing_queries import ZONED_SHOTS_SQL, zoned_shots
from tidemark.functions.ratings import win_expectation
from tidemark.session import written

# --- tenure and cohorts ------------------------------------------------------------


def tenure_rollup(spark, sf_dir):
    return marts.tenure_rollup(
        careers(spark, sf_dir).withColumn("name", F.concat(F.lit("Player "), F.col("player_id").cast("string"))),
        "player_id",
        "team_id",
        "season",
        name="name",
        label="label",
        tie="label",
        measures={"gp": "games_played", "points": "total_points"},
    )


TENURE_SQL = f"""
with {CAREERS_SQL}
select player_id, team_id, 'Player ' || cast(player_id as varchar) as name, any_value(label) as label,
       count(distinct season) as seasons, min(season) as first_season, max(season) as last_season,
       cast(sum(gp) as bigint) as games_played, cast(sum(points) as bigint) as total_points
from careers group by player_id, team_id"""


def latest_label(spark, sf_dir):
    rows = careers(spark, sf_dir).withColumn(
        "label", F.when(F.col("season") <= 2000, F.concat_ws("/", "label", F.col("season").cast("string")))
    )
    return marts.latest_label(rows, "team_id", "label", "season", "player_id")


LATEST_SQL = f"""
with {CAREERS_SQL}
select team_id, arg_max(label || '/' || cast(season as varchar), season) as label
from careers where season <= 2000 group by team_id"""

_COHORT = f"""
with {CAREERS_SQL},
active as (select player_id, season, row_number() over (partition by player_id order by season) as nth
           from (select distinct player_id, season from careers)),
latest as (select distinct season from careers order by season desc limit 20),
spells as (
    select c.player_id, c.team_id, count(*) as periods, min(c.season) as first
    from (select distinct player_id, team_id, season from careers) c
    join active a on a.player_id = c.player_id and a.season = c.season and a.nth <= 4 group by 1, 2),
best as (
    select * exclude (rn) from (
        select *, row_number() over (partition by player_id order by periods desc, first, team_id) as rn from spells)
    where rn = 1),
attribution as (
    select b.player_id, b.team_id, b.periods, b.first, a.season as established_by
    from best b join active a on a.player_id = b.player_id and a.nth = 4),
summary as (
    select season, count(*) as active, count(*) filter (where nth >= 4) as vets,
           count(*) filter (where nth < 4) as below,
           round_even(100.0::double * count(*) filter (where nth >= 4) / count(*), 1) as vet_pct
    from active where season in (select season from latest) group by season),
labels as (select team_id, arg_max(label, season) as label from careers where label is not null group by 1),
counts as (
    select l.label, a.season, count(*) as n
    from active a join attribution b on a.player_id = b.player_id join labels l on l.team_id = b.team_id
    where a.nth >= 4 and a.season in (select season from latest) group by 1, 2)
"""


def _spells(spark, sf_dir):
    """The careers' keys as a written table: the cohort matrix and shares read them several times."""
    return written(careers(spark, sf_dir).select("player_id", "team_id", "season", "label"), "careers")


def _counts(spells, tasks):
    return marts.cohort_counts(spells, "player_id", "team_id", "season", "label", tasks=tasks)


def cohort_attribution(spark, sf_dir):
    return marts.attribute_cohort(careers(spark, sf_dir), "player_id", "team_id", "season", tasks=finely(table(spark, sf_dir, "lineitem")))


def cohort_summary(spark, sf_dir):
    return marts.cohort_summary(careers(spark, sf_dir), "player_id", "season")


def cohort_pivot(spark, sf_dir):
    spells = _spells(spark, sf_dir)
    return marts.cohort_matrix(_counts(spells, finely(table(spark, sf_dir, "lineitem"))), "label", "season", marts.latest_values(spells, "season"))


# the reports' columns are the years of the orders
PIVOT_SQL = _COHORT + """
select label, {cols} from counts group by label""".format(
    cols=", ".join(f'cast(coalesce(sum(n) filter (where season = {y}), 0) as bigint) as "{y}"' for y in range(1995, 2002))
)


def cohort_share(spark, sf_dir):
    spells = _spells(spark, sf_dir)
    summary = marts.cohort_summary(spells, "player_id", "season")
    return marts.cohort_share(_counts(spells, finely(table(spark, sf_dir, "lineitem"))), summary, "label", "season")


def running_distinct(spark, sf_dir):
    return marts.completed_periods(careers(spark, sf_dir), "player_id", "season")


def threshold_crossing(spark, sf_dir):
    return marts.established_in(careers(spark, sf_dir), "player_id", "season")


# --- calibration ---------------------------------------------------------------------

_MEASURES = "base_rate brier brier_baseline brier_skill log_loss auc accuracy ece".split()


def calibration_summary(spark, sf_dir):
    return rounded(calibration.calibration_summary(forecasts(spark, sf_dir), "win_prob", "won"), 9, *_MEASURES)


def calibration_by_group(spark, sf_dir):
    out = calibration.calibration_summary(forecasts(spark, sf_dir), "win_prob", "won", by=["season"])
    return rounded(out, 9, *_MEASURES)


def reliability_table(spark, sf_dir):
    return rounded(calibration.reliability_table(forecasts(spark, sf_dir), "win_prob", "won"), 9, "mean_pred", "actual")


def auc_score(spark, sf_dir):
    return rounded(calibration.auc_score(forecasts(spark, sf_dir), "win_prob", "won", by=["season"]), 9, "auc")


def ece_score(spark, sf_dir):
    return rounded(calibration.ece_score(forecasts(spark, sf_dir), "win_prob", "won", by=["season"]), 9, "ece")


_BIN = "least(greatest(cast(trunc(win_prob * 10) as int), 0), 9)"
RELIABILITY_SQL = f"""
with {FORECASTS_SQL}
select {_BIN} as bin, count(*) as n, round(avg(win_prob), 9) as mean_pred, round(avg(won), 9) as actual,
       {_BIN} / 10.0::double as bin_lo, ({_BIN} + 1) / 10.0::double as bin_hi
from forecasts group by {_BIN}"""


def _calibration_sql(by, columns, source=f"with {FORECASTS_SQL}", digits=9):
    key = "season" if by else "1"
    part = "partition by season" if by else ""
    cols = ", ".join(columns)
    text = f"""
{source},
ranked as (
    select *, rank() over (p order by win_prob) + (count(*) over (p, win_prob) - 1) / 2.0::double as midrank
    from (select *, 0 as x from forecasts)),
base as (select {key} as season, avg(won) as b from forecasts group by 1),
rows_ as (
    select r.*, base.b from ranked r join base on {"r.season = base.season" if by else "true"}),
bins as (
    select {key} as season, {_BIN} as bin, count(*) as n, abs(avg(win_prob) - avg(won)) as gap from forecasts group by 1, 2),
eces as (select season, sum(n * gap) / sum(n) as ece from bins group by 1),
measures as (
    select {key} as season, count(*) as n, avg(won) as base_rate, avg(pow(win_prob - won, 2)) as brier,
           avg(pow(b - won, 2)) as brier_baseline,
           -avg(won * ln(greatest(least(win_prob, 1 - 1e-12::double), 1e-12::double))
                + (1 - won) * ln(1 - greatest(least(win_prob, 1 - 1e-12::double), 1e-12::double))) as log_loss,
           avg(cast((win_prob >= 0.5) = (won = 1) as int)) as accuracy,
           (sum(midrank) filter (where won = 1) - sum(won) * (sum(won) + 1) / 2.0::double)
               / (sum(won) * (count(*) - sum(won))) as auc
    from rows_ group by 1),
result as (
    select {"m.season," if by else ""} m.n, round(base_rate, {digits}) as base_rate, round(brier, {digits}) as brier,
           round(brier_baseline, {digits}) as brier_baseline, round(1 - brier / brier_baseline, {digits}) as brier_skill,
           round(log_loss, {digits}) as log_loss, round(auc, {digits}) as auc, round(accuracy, {digits}) as accuracy, round(ece, {digits}) as ece
    from measures m join eces e on m.season = e.season)
select {cols} from result""".replace("(p order by win_prob)", f"({part} order by win_prob)").replace(
        "(p, win_prob)", f"(partition by {'season, ' if by else ''}win_prob)"
    )
    return text


def weighted_error(spark, sf_dir):
    rows = forecasts(spark, sf_dir)
    return rounded(calibration.weighted_error(rows, "win_prob", "won", "value", by=["season"]), 6, "weight", "rmse", "mae")


WEIGHTED_SQL = f"""
with {FORECASTS_SQL}
select season, round(sum(value), 6) as weight,
       round(sqrt(sum(value * pow(win_prob - won, 2)) / sum(value)), 6) as rmse,
       round(sum(value * abs(win_prob - won)) / sum(value), 6) as mae
from forecasts group by season"""


# penalties that are tried, and steps of the SQL counterpart's descent, enough for 9 digits
PENALTIES = (0.1, 0.3, 1.0)
_STEPS = 110


def lineups(spark, sf_dir):
    """Orders as contests of two lineups: the suppliers of open lines against those of finished ones."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("season"))
    rows = lines.groupBy(F.col("l_orderkey").alias("id")).agg(
        *[F.collect_set(F.when(F.col("l_linestatus") == c, F.col("l_suppkey"))).alias(n) for c, n in (("O", "off"), ("F", "def"))],
        F.sum("l_quantity").alias("y"),
        F.count(F.lit(1)).alias("w"),
    )
    return rows.join(orders, F.col("id") == F.col("o_orderkey")).withColumn("terms", ridge.terms("off", "def"))


def ridge_by_split(spark, sf_dir):
    """Errors on held-out contests by split: at random, the last seasons, and pairs that the fit has not seen.

    The penalty is the one of least error on further rows held out in the same way; ``naive_rmse`` is the
    error of the training rows' mean.
    """
    rows = written(ridge.pair_holdout(lineups(spark, sf_dir), "off", "def", 10).withColumn("last", F.greatest(2000 - F.col("season"), F.lit(0))), "lineups")
    found = []
    for name, number in (("pairs", "fold"), ("random", "tenth"), ("temporal", "last")):
        part = rows.withColumn("tenth", F.col("id") % 10)
        test, valid, train = (part.where(c) for c in (F.col(number) == 0, F.col(number) == 1, F.col(number) > 1))
        chosen = ridge.choose_penalty(train, valid, "terms", "y", "w", PENALTIES)
        model = ridge.fit_ridge(train, "terms", "y", "w", chosen)
        mean = train.agg(F.sum(F.col("w") * F.col("y")) / F.sum("w")).scalar()
        scored = ridge.predicted(test, "terms", model).withColumn("mean", mean)
        errors = [calibration.weighted_error(scored, p, "y", "w").withColumnRenamed("rmse", f"{p}_rmse") for p in ("predicted", "mean")]
        shown = [F.lit(name).alias("split"), F.lit(chosen).alias("penalty"), F.col("weight").cast("long").alias("weight")]
        found.append(errors[0].join(errors[1], "weight").select(*shown, F.col("predicted_rmse").alias("ridge_rmse"), F.col("mean_rmse").alias("naive_rmse")))
    return rounded(reduce(DataFrame.unionAll, found), 5, "ridge_rmse", "naive_rmse")


RIDGE_SQL = f"""
with recursive members as (
    select l_orderkey as id, l_suppkey as m, l_linestatus as side, sum(l_quantity) as q, count(*) as n from lineitem group by 1, 2, 3),
c as (
    select id, sum(q) as y, sum(n) as w, (min(m) * 31 + max(m)) % 10 as fold, greatest(2000 - year(any_value(o_orderdate)), 0) as last
    from members join orders on o_orderkey = id group by id),
t as (select id, case side when 'O' then 'o' else 'd' end || m as term from members),
s as (select 'pairs' as split, least(fold, 2) as part, * from c union all select 'random', least(id % 10, 2), * from c
      union all select 'temporal', least(last, 2), * from c),
mean as (select split, sum(w) as total, sum(w * y) / sum(w) as mean from s where part = 2 group by 1),
x as (select split, term, id, y - mean as y, w / total as w from s join mean using (split) join t using (id) where part = 2),
centre as (select split, term, sum(w) as share from x group by 1, 2),
descent as (
    select 0 as step, split, penalty, term, 0.0::double as beta from centre, (values {", ".join(f"({p}::double)" for p in PENALTIES)}) as v (penalty)
    union all
    select step + 1, split, penalty, d.term, d.beta + (g.g - penalty * d.beta) / (0.5 + penalty)
    from descent d join (
        select split, penalty, x.term, sum(x.w * (x.y - fit + shift)) as g
        from x join (select split, penalty, id, sum(beta) as fit from x join descent using (split, term) group by 1, 2, 3) f using (split, id)
             join (select split, penalty, sum(share * beta) as shift from centre join descent using (split, term) group by 1, 2) using (split, penalty)
        group by 1, 2, 3) g using (split, penalty, term)
    where step < {_STEPS}),
beta as (select * from descent where step = {_STEPS}),
shift as (select split, penalty, sum(share * beta) as shift from centre join beta using (split, term) group by 1, 2),
held as (
    select split, part, penalty, w, y - mean as y, coalesce((select sum(beta) from t join beta b on b.split = s.split and b.penalty = shift.penalty and b.term = t.term where t.id = s.id), 0) - shift as p
    from s join mean using (split) join shift using (split) where part < 2),
errors as (select split, part, penalty, sum(w) as weight, sqrt(sum(w * pow(y - p, 2)) / sum(w)) as ridge_rmse, sqrt(sum(w * y * y) / sum(w)) as naive_rmse from held group by 1, 2, 3)
select e.split, e.penalty, cast(e.weight as bigint) as weight, round(e.ridge_rmse, 5) as ridge_rmse, round(e.naive_rmse, 5) as naive_rmse
from errors e join (select split, arg_min(penalty, ridge_rmse) as penalty from errors where part = 1 group by 1) using (split, penalty) where e.part = 0"""

# --- expectations ------------------------------------------------------------------


def elo_calibration(spark, sf_dir):
    """Expectations of home sides under given strengths, the suppliers' balances, scored per season."""
    teams = table(spark, sf_dir, "supplier")
    own = teams.select(F.col("s_suppkey").alias("team_id"), (1500 + F.col("s_acctbal") / 20).alias("own"))
    other = teams.select(F.col("s_suppkey").alias("opponent_team_id"), (1500 + F.col("s_acctbal") / 20).alias("other"))
    games = sides(spark, sf_dir).where("is_home and win_flag is not null").join(own, "team_id").join(other, "opponent_team_id")
    scored = games.select(
        F.round(win_expectation(F.col("own") + 100.0, F.col("other")), 4).alias("p"), F.col("win_flag").alias("won"), F.col("season_start_year").alias("season")
    )
    return rounded(calibration.calibration_summary(scored, "p", "won", by=["season"]), 6, *_MEASURES)


GIVEN_SQL = f"""
with {SIDES_SQL},
forecasts as (
    select round(1 / (1 + pow(10::double, ((1500 + o.s_acctbal / 20) - (1600 + s.s_acctbal / 20)) / 400.0::double)), 4) as win_prob,
           win_flag as won, season_start_year as season
    from sides join supplier s on s.s_suppkey = team_id join supplier o on o.s_suppkey = opponent_team_id
    where is_home and win_flag is not null)"""

# --- features --------------------------------------------------------------------------


def rolling_splits(spark, sf_dir):
    base = sides(spark, sf_dir).select("game_id", "team_id", "game_date", "season_start_year", "points")
    out = efficiency.rolling_splits(base, "team_id", "season_start_year", ["game_date", "game_id"], "points")
    return rounded(out, 9, "points_last5", "points_last10", "points_period")


ROLLING_SQL = f"""
with {SIDES_SQL}
select game_id, team_id, game_date, season_start_year, points,
       round(avg(points) over (w rows between 4 preceding and current row), 9) as points_last5,
       round(avg(points) over (w rows between 9 preceding and current row), 9) as points_last10,
       round(avg(points) over (partition by team_id, season_start_year order by game_date, game_id
                               rows between unbounded preceding and current row), 9) as points_period
from sides window w as (partition by team_id order by game_date, game_id)"""


def point_in_time_features(spark, sf_dir):
    base = sides(spark, sf_dir).select("game_id", "team_id", "opponent_team_id", "game_date", "points", "win_flag")
    out = efficiency.point_in_time_features(
        base, "team_id", "opponent_team_id", "game_date", ["game_date", "game_id"], "points", "win_flag"
    )
    return rounded(out, 9, "points_prior5")


POINT_IN_TIME_SQL = f"""
with {SIDES_SQL}
select game_id, team_id, opponent_team_id, game_date, points, win_flag,
       cast(game_date - lag(game_date) over w as int) as rest_days,
       round(avg(points) over (w rows between 5 preceding and 1 preceding), 9) as points_prior5,
       count(*) over (h rows between unbounded preceding and 1 preceding) as h2h_games,
       cast(coalesce(sum(win_flag) over (h rows between unbounded preceding and 1 preceding), 0) as bigint) as h2h_wins
from sides
window w as (partition by team_id order by game_date, game_id),
       h as (partition by team_id, opponent_team_id order by game_date, game_id)"""


def zone_efficiency(spark, sf_dir):
    shots = zoned_shots(spark, sf_dir)
    out = efficiency.zone_efficiency(shots, "user_id", "shot_zone", "is_made", "shot_value")
    rates = ["make_pct", "points_per_attempt", "league_make_pct", "league_points_per_attempt", "points_over_expected"]
    return rounded(out, 9, *rates)


ZONE_SQL = f"""
with {ZONED_SHOTS_SQL},
t as (select user_id, shot_zone, count(*) as attempts, count(*) filter (where is_made) as makes, sum(points) as pts
      from zoned group by 1, 2),
b as (select shot_zone, sum(makes) / sum(attempts) as m, sum(pts) / sum(attempts) as p from t group by 1)
select user_id, shot_zone, attempts, makes, round(makes / attempts, 9) as make_pct,
       round(pts / attempts, 9) as points_per_attempt, round(m, 9) as league_make_pct,
       round(p, 9) as league_points_per_attempt, round(pts - attempts * p, 9) as points_over_expected
from t join b using (shot_zone)"""


def zscore_impute(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance")
    )
    out = efficiency.zscore_impute(customer, "c_mktsegment", "balance")
    return rounded(out, 6, "balance_imputed", "balance_z")


ZSCORE_SQL = """
with c as (select c_custkey, c_mktsegment, case when c_acctbal > 0 then c_acctbal end as balance from customer),
s as (select c_mktsegment, avg(balance) as m, stddev_pop(balance) as sd from c group by 1)
select c_custkey, c_mktsegment, balance, balance is null as balance_missing,
       round(coalesce(balance, m), 6) as balance_imputed, round((coalesce(balance, m) - m) / sd, 6) + 0 as balance_z
from c join s using (c_mktsegment)"""


def unpivot_long(spark, sf_dir):
    base = sides(spark, sf_dir).select("game_id", "team_id", "points", "fgm", "oreb", "dreb", "tov")
    return staging.unpivot_long(base, ["game_id", "team_id"], ["points", "fgm", "oreb", "dreb", "tov"], "measure", "amount")


UNPIVOT_SQL = f"""
with {SIDES_SQL}
select game_id, team_id, unnest(['points', 'fgm', 'oreb', 'dreb', 'tov']) as measure,
       unnest([points, fgm, oreb, dreb, tov]) as amount from sides"""


def stint_intervals(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem")
    lines = raw.select(
        "l_orderkey",
        "l_suppkey",
        F.col("l_shipdate").cast("date").alias("enters"),
        F.date_add(F.col("l_shipdate").cast("date"), (F.col("l_quantity") * 20).cast("int")).alias("leaves"),
    )
    return efficiency.stint_intervals(lines, "l_orderkey", "l_suppkey", "enters", "leaves", finely(raw))


STINT_SQL = """
with p as (select l_orderkey, l_suppkey, cast(l_shipdate as date) as s,
                  cast(l_shipdate as date) + cast(l_quantity * 20 as int) as e from lineitem),
points as (select l_orderkey, s as t from p union select l_orderkey, e from p),
numbered as (select *, row_number() over w as no, lead(t) over w as nxt from points
             window w as (partition by l_orderkey order by t))
select n.l_orderkey, cast(no as int) as stint_no, t as stint_start, nxt as stint_end,
       list_sort(list(distinct l_suppkey)) as lineup
from numbered n join p on p.l_orderkey = n.l_orderkey and p.s <= n.t and p.e > n.t
group by 1, 2, 3, 4"""


def _presences(spark, sf_dir):
    """Lines as presences of their suppliers, even ids at home, and as events a week per line number after the order's first."""
    lines = table(spark, sf_dir, "lineitem")
    day = F.col("l_shipdate").cast("date")
    present = lines.select(
        "l_orderkey", "l_suppkey", (F.col("l_suppkey") % 2 == 0).alias("is_home"), day.alias("enters"), F.date_add(day, (F.col("l_quantity") * 20).cast("int")).alias("leaves")
    )

    def flag(test):
        return test.cast("int")

    happened = lines.select(
        "l_orderkey",
        (F.col("l_suppkey") % 2 == 0).alias("is_home"),
        F.date_add(day, F.col("l_linenumber") * 7 - 10).alias("day"),
        (F.col("l_quantity").cast("int") % 4).alias("points"),
        flag(F.col("l_returnflag") == "N").alias("fga"),
        flag(F.col("l_returnflag") == "A").alias("fta"),
        flag((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")).alias("oreb"),
        flag(F.col("l_discount") > 0.05).alias("tov"),
    )
    return present, happened, finely(lines)


def stint_events(spark, sf_dir):
    """Both lineups of every stint, with the points and possessions of the events in it."""
    present, happened, tasks = _presences(spark, sf_dir)
    found = stints.two_sided_stints(present, "l_orderkey", "is_home", "l_suppkey", "enters", "leaves", tasks)
    assigned = stints.events_in_stints(happened, found, "l_orderkey", "day", tasks)
    return rounded(stints.stint_totals(assigned, found, "l_orderkey", "is_home", ["points", "fga", "fta", "oreb", "tov"]), 6, "home_poss", "away_poss")


_EVENTS_SQL = """
p as (select l_orderkey, l_suppkey, l_suppkey % 2 = 0 as is_home, cast(l_shipdate as date) as s,
             cast(l_shipdate as date) + cast(l_quantity * 20 as int) as e from lineitem),
points as (select l_orderkey, s as t from p union select l_orderkey, e from p),
numbered as (select l_orderkey, cast(row_number() over w as int) as no, t, lead(t) over w as nxt from points window w as (partition by l_orderkey order by t)),
stints as (
    select n.l_orderkey, no as stint_no, t as stint_start, nxt as stint_end,
           coalesce(list_sort(list(distinct l_suppkey) filter (is_home)), []) as home_lineup,
           coalesce(list_sort(list(distinct l_suppkey) filter (not is_home)), []) as away_lineup
    from numbered n left join p on p.l_orderkey = n.l_orderkey and p.s <= n.t and p.e > n.t where nxt is not null group by 1, 2, 3, 4),
happened as (
    select l_orderkey, l_suppkey % 2 = 0 as is_home, cast(l_shipdate as date) + cast(l_linenumber * 7 - 10 as int) as day, cast(trunc(l_quantity) as int) % 4 as points,
           cast(l_returnflag = 'N' as int) as fga, cast(l_returnflag = 'A' as int) as fta,
           cast(l_returnflag = 'R' and l_linestatus = 'O' as int) as oreb, cast(l_discount > 0.05 as int) as tov from lineitem),
assigned as (
    select h.*, s.stint_no from happened h left join stints s on s.l_orderkey = h.l_orderkey and h.day >= stint_start and h.day < stint_end),
totals as (
    select l_orderkey, stint_no, {sums} from assigned where stint_no is not null group by 1, 2)""".format(
    sums=", ".join(f"sum({c}) filter ({'is_home' if s == 'home' else 'not is_home'}) as {s}_{c}" for s in ("home", "away") for c in ("points", "fga", "fta", "oreb", "tov"))
)

STINT_EVENTS_SQL = f"""
with {_EVENTS_SQL}
select s.*, {", ".join(f"cast(coalesce({x}_points, 0) as bigint) as {x}_points" for x in ("home", "away"))},
       {", ".join(f"round(coalesce({x}_fga, 0) + 0.44::double * coalesce({x}_fta, 0) - coalesce({x}_oreb, 0) + coalesce({x}_tov, 0), 6) as {x}_poss" for x in ("home", "away"))}
from stints s left join totals t using (l_orderkey, stint_no)"""


def stint_reconcile(spark, sf_dir):
    """Events that fall into no stint, and games whose points do not add up, of which there must be none."""
    present, happened, tasks = _presences(spark, sf_dir)
    found = stints.two_sided_stints(present, "l_orderkey", "is_home", "l_suppkey", "enters", "leaves", tasks)
    assigned = stints.events_in_stints(happened, found, "l_orderkey", "day", tasks)
    totals = stints.stint_totals(assigned, found, "l_orderkey", "is_home", ["points", "fga", "fta", "oreb", "tov"])
    wrong = stints.unreconciled_games(totals, happened, assigned, "l_orderkey", "points")
    outside = assigned.where("stint_no is null").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("events"), F.sum("points").alias("points"))
    return outside.select("l_orderkey", "events", "points", F.lit("outside").alias("what")).unionByName(
        wrong.select("l_orderkey", F.lit(None).cast("long").alias("events"), (F.col("game_points") - F.col("stint_points")).alias("points"), F.lit("wrong").alias("what"))
    )


STINT_RECONCILE_SQL = f"""
with {_EVENTS_SQL}
select l_orderkey, count(*) as events, cast(sum(points) as bigint) as points, 'outside' as what from assigned where stint_no is null group by 1"""


def situation_flag(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    core = efficiency.core_members(lines, ["l_suppkey"], "l_partkey", "l_quantity").withColumn("core", F.lit(True))
    tagged = lines.join(core, ["l_suppkey", "l_partkey"], "left")
    per_order = tagged.groupBy("l_orderkey").agg(
        F.count_if(F.col("core").isNull()).alias("bench"),
        F.max("l_linenumber").alias("period"),
        (F.max("l_quantity") - F.min("l_quantity")).alias("margin"),
    )
    flag = efficiency.situation_flag(F.col("period"), F.col("margin"), F.col("bench"))
    return per_order.withColumn("is_garbage", flag)


SITUATION_SQL = """
with usage as (select l_suppkey, l_partkey, sum(l_quantity) as q from lineitem group by 1, 2),
core as (select l_suppkey, l_partkey from (
    select *, row_number() over (partition by l_suppkey order by q desc, l_partkey) as rn from usage) where rn <= 10),
o as (
    select l_orderkey, count(*) filter (where c.l_partkey is null) as bench, max(l_linenumber) as period,
           max(l_quantity) - min(l_quantity) as margin
    from lineitem l left join core c on c.l_suppkey = l.l_suppkey and c.l_partkey = l.l_partkey group by 1)
select *, (period = 4 and margin >= 19) or (period = 3 and margin >= 25) or bench >= 4 as is_garbage from o"""


def with_without(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("game"), F.col("o_custkey").alias("team"), F.floor("o_totalprice").alias("rating")
    )
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("game"), F.col("l_suppkey").alias("member"))
    appearances = lines.distinct().join(orders.select("team", "game"), "game")
    out = efficiency.with_without(orders, appearances, "team", "game", "member", "rating")
    return rounded(out, 6, "avg_with", "avg_without", "impact")


WITH_SQL = """
with g as (select o_orderkey as game, o_custkey as team, cast(floor(o_totalprice) as bigint) as rating from orders),
a as (select distinct g.team, g.game, l.l_suppkey as member, g.rating from lineitem l join g on g.game = l.l_orderkey),
w as (select team, member, count(*) as games_with, sum(rating) as s from a group by 1, 2),
t as (select team, count(*) as n, sum(rating) as s from g group by 1)
select w.team, w.member, games_with, t.n - games_with as games_without, round(w.s / games_with, 6) as avg_with,
       round((t.s - w.s) / nullif(t.n - games_with, 0), 6) as avg_without,
       round(w.s / games_with - (t.s - w.s) / nullif(t.n - games_with, 0), 6) as impact
from w join t using (team)"""


def similarity_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return rounded(similarity.similar_to(vectors, "vec_id", "embedding", 7, 20), 6, "similarity")


SIMILARITY_SQL = """
with q as (select cast(embedding as double[]) as v from embeddings where vec_id = 7),
s as (select vec_id, list_inner_product(cast(embedding as double[]), v)
             / sqrt(list_inner_product(cast(embedding as double[]), cast(embedding as double[])))
             / sqrt(list_inner_product(v, v)) as similarity from embeddings, q where vec_id <> 7)
select vec_id, round(similarity, 6) as similarity from s order by s.similarity desc, vec_id limit 20"""


def similarity_blocks(spark, sf_dir):
    """The ten nearest vectors of every hundredth one, compared with all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    return rounded(similarity.nearest(vectors, "vec_id", "embedding", F.col("vec_id") % 100 == 0), 6, "similarity")


_NEAREST_SQL = """
u as (select vec_id, cast(embedding as double[]) as v from embeddings),
n as (select vec_id, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) as v from u),
s as (select q.vec_id as query, n.vec_id as neighbour, round(list_inner_product(q.v, n.v), 9) as similarity
      from n q join n on n.vec_id <> q.vec_id where q.vec_id % 100 = 0),
nearest as (
    select query, neighbour, round(similarity, 6) as similarity,
           cast(row_number() over (partition by query order by s.similarity desc, neighbour) as int) as rank from s
    qualify row_number() over (partition by query order by s.similarity desc, neighbour) <= 10)"""


def similarity_index(spark, sf_dir):
    """The same queries through an index of random hyperplanes, held against the exact answer: at least 0.9 must be found."""
    vectors, wanted = table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0
    planes = similarity.fit_planes(vectors, "vec_id", "embedding")
    index = similarity.index_of(vectors, "vec_id", "embedding", planes)
    found = similarity.search(vectors, "vec_id", "embedding", wanted, index, planes)
    exact = similarity.nearest(vectors, "vec_id", "embedding", wanted)
    return similarity.recall_of(found, exact).select("pairs", (F.col("recall") >= 0.9).alias("recall_reached"))


def holdout_split(spark, sf_dir):
    games = sides(spark, sf_dir).select("game_id", "team_id", "opponent_team_id", "game_date")
    tagged = incremental.temporal_split(games, "team_id", ["game_date", "game_id"], 60)
    train, test = tagged.where("split = 'train'"), tagged.where("split = 'test'")
    novel = incremental.novel_pairs(train, test, "team_id", "opponent_team_id")
    return novel.unionByName(train.withColumn("is_novel", F.lit(None).cast("boolean")))


HOLDOUT_SQL = f"""
with {SIDES_SQL},
t as (select game_id, team_id, opponent_team_id, game_date,
             case when row_number() over (partition by team_id order by game_date, game_id) <= 60
                  then 'train' else 'test' end as split from sides),
seen as (select distinct least(team_id, opponent_team_id) as lo, greatest(team_id, opponent_team_id) as hi
         from t where split = 'train')
select t.*, case when split = 'test' then lo is null end as is_novel
from t left join seen on lo = least(team_id, opponent_team_id) and hi = greatest(team_id, opponent_team_id)"""

QUERIES = {
    "tenure_rollup": tenure_rollup,
    "latest_label": latest_label,
    "cohort_attribution": cohort_attribution,
    "cohort_summary": cohort_summary,
    "cohort_pivot": cohort_pivot,
    "cohort_share": cohort_share,
    "running_distinct": running_distinct,
    "threshold_crossing": threshold_crossing,
    "reliability_table": reliability_table,
    "calibration_summary": calibration_summary,
    "calibration_by_group": calibration_by_group,
    "auc_score": auc_score,
    "ece_score": ece_score,
    "weighted_error": weighted_error,
    "ridge_by_split": ridge_by_split,
    "elo_calibration": elo_calibration,
    "rolling_splits": rolling_splits,
    "point_in_time_features": point_in_time_features,
    "zone_efficiency": zone_efficiency,
    "zscore_impute": zscore_impute,
    "unpivot_long": unpivot_long,
    "stint_intervals": stint_intervals,
    "stint_events": stint_events,
    "stint_reconcile": stint_reconcile,
    "situation_flag": situation_flag,
    "with_without": with_without,
    "similarity_topk": similarity_topk,
    "similarity_blocks": similarity_blocks,
    "similarity_index": similarity_index,
    "holdout_split": holdout_split,
}

_ALL = ["n", *_MEASURES]

ORACLE = {
    "tenure_rollup": TENURE_SQL,
    "latest_label": LATEST_SQL,
    "cohort_attribution": _COHORT + "select * from attribution",
    "cohort_summary": _COHORT + "select * from summary",
    "cohort_pivot": PIVOT_SQL,
    "cohort_share": _COHORT
    + """select season, label, n, case when vets > 0 then round(100.0::double * n / vets, 1) else 0 end as share
         from counts join summary using (season)""",
    "running_distinct": _COHORT + "select player_id, season, cast(nth as int) as completed from active",
    "threshold_crossing": _COHORT + "select player_id, season as established_by from active where nth = 4",
    "reliability_table": RELIABILITY_SQL,
    "calibration_summary": _calibration_sql(False, _ALL),
    "calibration_by_group": _calibration_sql(True, ["season", *_ALL]),
    "auc_score": _calibration_sql(True, ["season", "auc"]),
    "ece_score": _calibration_sql(True, ["season", "ece"]),
    "weighted_error": WEIGHTED_SQL,
    "ridge_by_split": RIDGE_SQL,
    "elo_calibration": _calibration_sql(
        True,
        ["season", *_ALL],
        GIVEN_SQL,
        6,
    ),
    "rolling_splits": ROLLING_SQL,
    "point_in_time_features": POINT_IN_TIME_SQL,
    "zone_efficiency": ZONE_SQL,
    "zscore_impute": ZSCORE_SQL,
    "unpivot_long": UNPIVOT_SQL,
    "stint_intervals": STINT_SQL,
    "stint_events": STINT_EVENTS_SQL,
    "stint_reconcile": STINT_RECONCILE_SQL,
    "situation_flag": SITUATION_SQL,
    "with_without": WITH_SQL,
    "similarity_topk": SIMILARITY_SQL,
    "similarity_blocks": f"with {_NEAREST_SQL} select * from nearest",
    "similarity_index": f"with {_NEAREST_SQL} select count(*) as pairs, true as recall_reached from nearest",
    "holdout_split": HOLDOUT_SQL,
}
