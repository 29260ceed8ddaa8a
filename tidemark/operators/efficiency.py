"""Derived measures of contests and their participants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import rates
from tidemark.operators.ordered import Running, covered, framed, numbered_stretches, running

OPPONENT_INPUTS = ("points", "fgm", "fga", "fg3m", "fta", "ftm", "oreb", "dreb", "tov")


def four_factors(paired: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Tempo, ratings per 100 possessions and the four factors of both sides.

    ``paired`` has the side's counts plus the opponent's with an ``opp_`` prefix.
    """
    c = F.col
    own = rates.possessions(c("fga"), c("fta"), c("oreb"), c("tov"))
    opp = rates.possessions(c("opp_fga"), c("opp_fta"), c("opp_oreb"), c("opp_tov"))
    poss = paired.withColumns({"poss": own, "opp_poss": opp})
    off = rates.per_hundred(c("points"), c("poss"))
    dfn = rates.per_hundred(c("opp_points"), c("opp_poss"))
    return poss.select(
        *keep,
        "poss",
        "opp_poss",
        rates.pace(c("poss"), c("opp_poss"), c("team_minutes")).alias("pace"),
        off.alias("off_rating"),
        dfn.alias("def_rating"),
        (off - dfn).alias("net_rating"),
        rates.effective_shooting(c("fgm"), c("fg3m"), c("fga")).alias("efg_pct"),
        rates.turnover_share(c("tov"), c("fga"), c("fta")).alias("tov_pct"),
        rates.rebound_share(c("oreb"), c("opp_dreb")).alias("oreb_pct"),
        rates.free_throw_rate(c("ftm"), c("fga")).alias("ft_rate"),
        rates.effective_shooting(c("opp_fgm"), c("opp_fg3m"), c("opp_fga")).alias("opp_efg_pct"),
        rates.turnover_share(c("opp_tov"), c("opp_fga"), c("opp_fta")).alias("opp_tov_pct"),
        rates.rebound_share(c("opp_oreb"), c("dreb")).alias("opp_oreb_pct"),
        rates.free_throw_rate(c("opp_ftm"), c("opp_fga")).alias("opp_ft_rate"),
    )


def rolling_splits(
    df: DataFrame,
    entity: str,
    period: str,
    order: Sequence[str],
    measure: str,
    spans: Sequence[int] = (5, 10),
) -> DataFrame:
    """Averages over the last n rows of the entity and over its period so far, the row included."""
    ranking = [F.col(c) for c in order]
    recent = framed(
        df,
        [entity],
        ranking,
        lambda w: [F.avg(measure).over(w.rowsBetween(1 - n, 0)).alias(f"{measure}_last{n}") for n in spans],
    )
    total = running(
        recent,
        [entity, period],
        ranking,
        {
            "_sum": Running("sum", F.col(measure).cast("double")),
            "_n": Running("sum", F.when(F.col(measure).isNotNull(), 1).otherwise(0)),
        },
    )
    return total.withColumn(f"{measure}_period", rates.ratio(F.col("_sum"), F.col("_n"))).drop("_sum", "_n")


def point_in_time_features(
    df: DataFrame,
    entity: str,
    opponent: str,
    date: str,
    order: Sequence[str],
    measure: str,
    won: str,
    span: int = 5,
) -> DataFrame:
    """Features known before the row: rest days, prior rolling average, record against the opponent."""
    ranking = [F.col(c) for c in order]
    prior = framed(
        df,
        [entity],
        ranking,
        lambda w: [
            F.date_diff(F.col(date), F.lag(date).over(w)).alias("rest_days"),
            F.avg(measure).over(w.rowsBetween(-span, -1)).alias(f"{measure}_prior{span}"),
        ],
    )
    wins = F.coalesce(F.col(won), F.lit(0)).cast("long")
    meetings = running(
        prior,
        [entity, opponent],
        ranking,
        {"_met": Running("sum", F.lit(1)), "_won": Running("sum", wins)},
    )
    # the running values include the row itself, which is not known beforehand
    return meetings.select(
        *prior.columns,
        (F.col("_met") - 1).cast("long").alias("h2h_games"),
        (F.col("_won") - wins).alias("h2h_wins"),
    )


def zone_efficiency(df: DataFrame, entity: str, zone: str, made: str, value: str) -> DataFrame:
    """Make rate and points per attempt by entity and zone, against the zone's overall baseline.

    The baseline is summed from the per-entity totals, so the raw rows are read once.
    """
    totals = df.groupBy(entity, zone).agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.col(made)).alias("makes"),
        F.sum(F.when(F.col(made), F.col(value)).otherwise(0)).alias("points"),
    )
    base = totals.groupBy(zone).agg(
        rates.ratio(F.sum("makes"), F.sum("attempts")).alias("league_make_pct"),
        rates.ratio(F.sum("points"), F.sum("attempts")).alias("league_points_per_attempt"),
    )
    return totals.join(base, zone).select(
        entity,
        zone,
        "attempts",
        "makes",
        rates.ratio(F.col("makes"), F.col("attempts")).alias("make_pct"),
        rates.ratio(F.col("points"), F.col("attempts")).alias("points_per_attempt"),
        "league_make_pct",
        "league_points_per_attempt",
        (F.col("points") - F.col("attempts") * F.col("league_points_per_attempt")).alias("points_over_expected"),
    )


def zscore_impute(df: DataFrame, group: str, measure: str) -> DataFrame:
    """Missing flag, group-mean imputation and z-score within the group."""
    stats = df.groupBy(group).agg(F.avg(measure).alias("_mean"), F.stddev_pop(measure).alias("_sd"))
    filled = F.coalesce(F.col(measure), F.col("_mean"))
    return (
        df.join(stats.withColumnRenamed(group, "_group"), F.col(group).eqNullSafe(F.col("_group")))
        .withColumn(f"{measure}_missing", F.col(measure).isNull())
        .withColumn(f"{measure}_imputed", filled)
        .withColumn(f"{measure}_z", rates.ratio(filled - F.col("_mean"), F.col("_sd")))
        .drop("_group", "_mean", "_sd")
    )


def stint_intervals(df: DataFrame, game: str, member: str, start: str, stop: str, tasks: int | None = None) -> DataFrame:
    """Stretches of a game with an unchanged set of members, as sorted id arrays.

    Every change point gets its number within the game, so a presence becomes a range of numbers and is
    expanded to rows of the stretches it covers. A game's change points, and a stretch's
    members, are bounded by their meaning. ``tasks`` is the number of parts that the games are dealt to.
    """
    there = covered(df.where(F.col(start) < F.col(stop)), game, [F.col(member).alias("_member")], start, stop, tasks)
    found = numbered_stretches(there, {"lineup": F.array_sort(F.collect_set("_member"))}).where(F.size("lineup") > 0)
    return found.select(F.col("_game").alias(game), "stint_no", "stint_start", "stint_end", "lineup")


# A stretch no longer decides the game from these margins on, by period,
# or with this many players outside the team's most used ones.
DECIDED_MARGIN = {4: 19, 3: 25}
BENCH_COUNT = 4
CORE_SIZE = 10


def situation_flag(period: Column, margin: Column, bench: Column) -> Column:
    """True where the margin for the period, or the number of reserves, says the game is decided."""
    tests = [(period == p) & (F.abs(margin) >= m) for p, m in DECIDED_MARGIN.items()]
    decided = bench >= BENCH_COUNT
    for t in tests:
        decided = decided | t
    return F.coalesce(decided, F.lit(False))


def core_members(df: DataFrame, group: Sequence[str], member: str, usage: str, size: int = CORE_SIZE) -> DataFrame:
    """The most used members of each group, ties by id; pruned to ``size`` rows per task before the shuffle."""
    total = df.groupBy(*group, member).agg(F.sum(usage).alias("_usage"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("_usage").desc(), F.col(member)))
    return total.withColumn("_rank", rank).where(F.col("_rank") <= size).select(*group, member)


def with_without(team_games: DataFrame, appearances: DataFrame, team: str, game: str, member: str, measure: str) -> DataFrame:
    """Average measure of a team in games with and without each member.

    'Without' is the team's total minus the member's part, so the grid of members
    and missed games is never built. ``team_games`` has one row per team and game;
    games without the measure do not count.
    """
    team_games = team_games.select(team, game, measure).where(F.col(measure).isNotNull())
    scored = appearances.select(team, game, member).distinct().join(team_games, [team, game])
    part = scored.groupBy(team, member).agg(
        F.count(F.lit(1)).alias("games_with"), F.sum(measure).alias("_with")
    )
    whole = team_games.groupBy(team).agg(F.count(F.lit(1)).alias("_games"), F.sum(measure).alias("_all"))
    without = F.col("_games") - F.col("games_with")
    avg_with = rates.ratio(F.col("_with"), F.col("games_with"))
    avg_without = rates.ratio(F.col("_all") - F.col("_with"), without)
    return part.join(whole, team).select(
        team,
        member,
        "games_with",
        without.alias("games_without"),
        avg_with.alias("avg_with"),
        avg_without.alias("avg_without"),
        (avg_with - avg_without).alias("impact"),
    )
