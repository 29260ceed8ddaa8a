"""Stints of two sides and the events in them.

Games are bounded by their meaning: a game's change points, or its events and stints in time order,
are one window group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import rates
from tidemark.operators.ordered import covered, dealt, framed, numbered_stretches, same_keys
from tidemark.operators.quality import reconcile

SIDES = ("home", "away")


def two_sided_stints(df: DataFrame, game: str, is_home: str, member: str, start: str, stop: str, tasks: int | None = None) -> DataFrame:
    """(game, stint_no, stint_start, stint_end, home_lineup, away_lineup): stretches in which neither side changes.

    Every time at which anybody of either side comes or goes is a change point, and each stretch between two
    of them a stint, with the sorted ids of both sides; a side can be empty. Presences without a beginning, an
    end after it or a side do not count. ``tasks`` is the number of parts that the games are dealt to.
    """
    present = df.where((F.col(start) < F.col(stop)) & F.col(is_home).isNotNull())
    there = covered(present, game, [F.col(is_home).alias("_home"), F.col(member).alias("_member")], start, stop, tasks)
    lineups = {f"{s}_lineup": F.array_sort(F.collect_set(F.when(F.col("_home") == (s == "home"), F.col("_member")))) for s in SIDES}
    return numbered_stretches(there, lineups).where("stint_end is not null").select(F.col("_game").alias(game), "stint_no", "stint_start", "stint_end", *lineups)


def events_in_stints(events: DataFrame, stints: DataFrame, game: str, at: str, tasks: int | None = None) -> DataFrame:
    """Append the number of the stint that each event falls into: from its start up to, not including, its end.

    Stints and events of a game are merged in time order, and each event takes the last stint begun before it.
    Nothing is joined by ranges. Events outside all stints, and without a time, get NULL. ``tasks`` is the number of
    parts that the games are dealt to.
    """
    names = events.columns
    begun = F.struct(F.col("stint_no").alias("no"), F.col("stint_end").alias("until"))
    starts = stints.select(F.col(game).alias("_game"), F.col("stint_start").alias("_at"), F.lit(0).alias("_kind"), begun.alias("_stint"))
    rows = events.select(F.col(game).alias("_game"), F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.struct(*names).alias("_event"))
    merged = dealt(starts.unionByName(rows, allowMissingColumns=True), "_game", tasks)
    order = [F.col("_at").asc_nulls_last(), F.col("_kind")]
    last = framed(merged, ["_game"], order, lambda w: [F.last("_stint", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_last")])
    number = F.when(F.col("_at") < F.col("_last.until"), F.col("_last.no"))
    return last.where("_kind = 1").select("_event.*", number.alias("stint_no"))


def stint_totals(assigned: DataFrame, stints: DataFrame, game: str, is_home: str, counts: Sequence[str]) -> DataFrame:
    """Every stint with the points and possessions of both sides, 0 where nothing happened.

    ``counts`` names the columns of points, shots, free throws, offensive rebounds and turnovers of an event.
    Possessions are estimated from a side's own counts; where rebounds outnumber the rest they can be negative.
    """
    points, shots, throws, rebounds, turnovers = counts
    sums = {f"{s}_{c}": F.sum(F.when(F.col(is_home) == (s == "home"), F.col(c))) for s in SIDES for c in counts}
    per = assigned.where("stint_no is not null").groupBy(F.col(game).alias("_g"), F.col("stint_no").alias("_n")).agg(*[c.alias(n) for n, c in sums.items()])
    joined = stints.join(per, same_keys(stints, per, [(game, "_g"), ("stint_no", "_n")]), "left")

    def of(side: str, name: str) -> Column:
        return F.coalesce(F.col(f"{side}_{name}"), F.lit(0))

    measures = [of(s, points).alias(f"{s}_points") for s in SIDES]
    measures += [rates.possessions(of(s, shots), of(s, throws), of(s, rebounds), of(s, turnovers)).alias(f"{s}_poss") for s in SIDES]
    return joined.select(*stints.columns, *measures)


def unreconciled_games(totals: DataFrame, events: DataFrame, assigned: DataFrame, game: str, points: str) -> DataFrame:
    """Games whose points in stints and points outside of all stints are not together the points of all events."""
    own = totals.groupBy(game).agg(F.sum(F.col("home_points") + F.col("away_points")).alias("_in"))
    out = assigned.where("stint_no is null").groupBy(F.col(game).alias("_g")).agg(F.sum(points).alias("_out"))
    counted = own.join(out, own[game].eqNullSafe(out["_g"]), "full")
    counted = counted.select(F.coalesce(game, "_g").alias(game), (F.coalesce("_in", F.lit(0)) + F.coalesce("_out", F.lit(0))).alias("stint_points"))
    whole = events.groupBy(game).agg(F.coalesce(F.sum(points), F.lit(0)).alias("game_points"))
    return reconcile(counted, whole, [game], "stint_points", "game_points")
