"""Efficiency expressions for paired contests, all in DOUBLE and guarded against zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: share of free-throw attempts that end a possession.
FREE_THROW_WEIGHT = 0.44


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, NULL where the denominator is 0."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def possessions(fga: Column, fta: Column, oreb: Column, tov: Column) -> Column:
    return fga + FREE_THROW_WEIGHT * fta.cast("double") - oreb + tov


def pace(poss: Column, opp_poss: Column, team_minutes: Column) -> Column:
    return ratio(48.0 * (poss + opp_poss), 2.0 * (team_minutes.cast("double") / 5.0))


def per_hundred(points: Column, poss: Column) -> Column:
    return ratio(100.0 * points, poss)


def effective_shooting(fgm: Column, fg3m: Column, fga: Column) -> Column:
    return ratio(fgm + 0.5 * fg3m.cast("double"), fga)


def turnover_share(tov: Column, fga: Column, fta: Column) -> Column:
    return ratio(tov, fga + FREE_THROW_WEIGHT * fta.cast("double") + tov)


def rebound_share(own: Column, other: Column) -> Column:
    return ratio(own, own + other)


def free_throw_rate(ftm: Column, fga: Column) -> Column:
    return ratio(ftm, fga)
