"""Star-schema building: pairs, dimensions, surrogate-key lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import surrogate_key
from tidemark.functions.text import decode, period_label

# First character of a season id.
SEASON_TYPES = {
    "1": "Pre Season",
    "2": "Regular Season",
    "3": "All-Star",
    "4": "Playoffs",
    "5": "Play-In",
}


def pair_collapse(
    sides: DataFrame,
    game: str,
    is_home: str,
    shared: Sequence[str],
    carry: Sequence[str],
    *,
    unique_sides: bool = False,
) -> DataFrame:
    """One row per game from its home and its away row.

    ``shared`` columns come from the home row, ``carry`` columns from both with a
    ``home_`` / ``away_`` prefix. Games that lack a side vanish; repeated sides
    multiply. Where sides are known to be unique, ``unique_sides=True`` reads the
    table once and shuffles partial aggregates instead of joining it to itself.
    """
    home_cols = [F.col(c).alias(f"home_{c}") for c in carry]
    away_cols = [F.col(c).alias(f"away_{c}") for c in carry]
    flag = F.col(is_home)
    if unique_sides:
        home = F.struct(*shared, *home_cols)
        packed = sides.groupBy(game).agg(
            F.max(F.when(flag, home)).alias("_h"), F.max(F.when(~flag, F.struct(*away_cols))).alias("_a")
        )
        return packed.where("_h is not null and _a is not null").select(game, "_h.*", "_a.*")
    home = sides.where(flag).select(game, *shared, *home_cols)
    away = sides.where(~flag).select(game, *away_cols)
    return home.join(away, game)


def opponent_id(team: Column, home: Column, away: Column) -> Column:
    """The other team of a game; a team that is not the home team plays against it."""
    return F.when(team == home, away).otherwise(home)


def opponent_columns(sides: DataFrame, game: str, is_home: str, carry: Sequence[str], prefix: str = "opp_") -> DataFrame:
    """Each side with the chosen columns of the other side of its game, from one aggregate per game.

    Games that lack a side vanish; a repeated side meets the other as often, as in a join, so that a test of
    uniqueness finds it. A game's rows are bounded by their meaning.
    """
    flag, row = F.col(is_home), F.struct(*[c for c in sides.columns if c != game])
    both = sides.groupBy(game).agg(F.collect_list(F.when(flag, row)).alias("_h"), F.collect_list(F.when(~flag, row)).alias("_a"))

    def side(own: str, other: str) -> Column:
        return F.struct(
            *[F.col(f"{own}.{c}").alias(c) for c in sides.columns if c != game],
            *[F.col(f"{other}.{c}").alias(f"{prefix}{c}") for c in carry],
        )

    pairs = both.select(game, F.explode("_h").alias("_h"), "_a").select(game, "_h", F.explode("_a").alias("_a"))
    out = pairs.select(game, F.explode(F.array(side("_h", "_a"), side("_a", "_h"))).alias("_s")).select(game, "_s.*")
    return out.select(*sides.columns, *[f"{prefix}{c}" for c in carry])


def opponent_join(
    sides: DataFrame, game: str, team: str, opponent: str, carry: Sequence[str], prefix: str = "opp_"
) -> DataFrame:
    """Each side with the chosen columns of its opponent's row of the same game."""
    other = sides.select(
        F.col(game).alias("_game"), F.col(team).alias("_team"), *[F.col(c).alias(f"{prefix}{c}") for c in carry]
    )
    return sides.join(other, (sides[game] == other["_game"]) & (sides[opponent] == other["_team"])).drop(
        "_game", "_team"
    )


def lookup(
    fact: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]], take: Sequence[tuple[str, str]], how: str = "left"
) -> DataFrame:
    """Append dimension columns: ``on`` pairs (fact, dim) keys, ``take`` pairs (dim, output) names.

    The join is left to the planner: it broadcasts a dimension whose measured
    size allows it, and splits skewed partitions of the fact otherwise. Calling
    it again with another key gives the dimension another role.
    """
    side = dim.select(
        *[F.col(d).alias(f"_on_{i}") for i, (_, d) in enumerate(on)], *[F.col(d).alias(o) for d, o in take]
    )
    cond = None
    for i, (f, _) in enumerate(on):
        test = fact[f] == side[f"_on_{i}"]
        cond = test if cond is None else cond & test
    return fact.join(side, cond, how).drop(*[f"_on_{i}" for i in range(len(on))])


def current_lookup(
    fact: DataFrame, dim: DataFrame, key: str, sk: str, *, dim_key: str | None = None, out: str | None = None
) -> DataFrame:
    """Append the surrogate key of the version that is current now, NULL without one."""
    return lookup(fact, dim.where("is_current"), [(key, dim_key or key)], [(sk, out or sk)])


def season_dim(df: DataFrame, season_id: str) -> DataFrame:
    """One row per season id: type in its first character, start year in the next four."""
    ids = df.select(F.col(season_id).alias("season_id")).distinct()
    year = F.substring("season_id", 2, 4).cast("int")
    return ids.select(
        surrogate_key("season_id").alias("season_key"),
        "season_id",
        period_label(year).alias("season"),
        year.alias("season_start_year"),
        decode(F.substring("season_id", 1, 1), SEASON_TYPES, "Unknown").alias("season_type"),
    )
