"""Generated inputs: date spines, period labels and the zone seed."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import date_key, surrogate_key
from tidemark.functions.text import period_label

# The calendar's bounds, the end not included.
CALENDAR_START = "1946-01-01"
CALENDAR_END = "2030-12-31"

SEED_SCHEMA = "shot_zone string, zone_group string, typical_value int"


def date_spine(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """One row per day from start to the day before end."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("lo"), F.lit(end).cast("date").alias("hi"))
    return bounds.select(F.explode(F.expr("sequence(lo, date_sub(hi, 1), interval 1 day)")).alias("date_day"))


def spine_of(df: DataFrame, date: str) -> DataFrame:
    """One row per day between the first and the last date of a table."""
    bounds = df.agg(F.min(F.col(date).cast("date")).alias("lo"), F.max(F.col(date).cast("date")).alias("hi"))
    return bounds.select(F.explode(F.expr("sequence(lo, hi, interval 1 day)")).alias("date_day"))


def date_attributes(day: Column) -> list[Column]:
    weekday = F.dayofweek(day)
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.quarter(day).alias("quarter"),
        weekday.isin(1, 7).alias("is_weekend"),
    ]


def date_dim(spine: DataFrame) -> DataFrame:
    """Calendar dimension of a spine (1 = Sunday, ISO weeks)."""
    return spine.select(*date_attributes(F.col("date_day")))


def season_range(spark: SparkSession, spec: str) -> DataFrame:
    """Labels of an inclusive range such as '2015-16:2024-25'."""
    first, last = (int(part.split("-")[0]) for part in spec.split(":"))
    return spark.range(first, last + 1).select(period_label("id").alias("season"))


def season_labels(first_year: int, last_year: int) -> list[str]:
    """The same labels as a driver-side list, for planning slices."""
    return [f"{y}-{(y + 1) % 100:02d}" for y in range(first_year, last_year + 1)]


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small CSV lookup with a declared schema."""
    return spark.read.csv(path, header=True, schema=schema)


def zone_rows(spark: SparkSession) -> DataFrame:
    """The zone seed that ships with the package, parsed by Spark's CSV reader from its text."""
    lines = (Path(__file__).with_name("shot_zones.csv")).read_text().splitlines()[1:]
    text = spark.createDataFrame([(line,) for line in lines], "line string")
    return text.select(F.from_csv("line", F.lit(SEED_SCHEMA)).alias("r")).select("r.*")


def zone_dim(zones: DataFrame) -> DataFrame:
    return zones.select(surrogate_key("shot_zone").alias("shot_zone_key"), "shot_zone", "zone_group", "typical_value")
