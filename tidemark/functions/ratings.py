"""Closed forms of the paired-contest rating update."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def win_expectation(rating: Column, opponent: Column) -> Column:
    """Win probability implied by two ratings on the 400-point logistic scale."""
    return 1.0 / (1.0 + F.pow(F.lit(10.0), (opponent - rating) / 400.0))


def margin_multiplier(margin: Column, rating_gap: Column) -> Column:
    """Growth of the update with the margin, damped when a favourite wins by a lot."""
    return F.log(F.abs(margin) + 1.0) * (2.2 / (F.abs(rating_gap) * 0.001 + 2.2))
