"""Helpers that several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word: a longest run of characters other than ASCII white space.
BLANKS = " \t\n\x0b\x0c\r"
SPLIT_WORDS = r"[\x20\x09-\x0D]+"


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under new names, found by exact spelling.

    Further columns may repeat or differ from a wanted name only in case: they are
    set aside by position, so no reference is ambiguous. Of several columns with
    the exact name the first counts.
    """
    places = [df.columns.index(name) for name in columns.values()]
    plain = df.toDF(*(f"_c{i}" for i in range(len(df.columns))))
    return plain.select(*(F.col(f"_c{i}").alias(new) for i, new in zip(places, columns, strict=True)))


def packed(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under new names, and ``row``: all columns, in a struct of fields _c0, _c1, ..."""
    places = [df.columns.index(name) for name in columns.values()]
    names = [f"_c{i}" for i in range(len(df.columns))]
    plain = df.toDF(*names)
    chosen = [F.col(f"_c{i}").alias(new) for i, new in zip(places, columns, strict=True)]
    return plain.select(*chosen, F.struct(*names).alias("row"))


def unpacked(df: DataFrame, names: list[str], replaced: dict[str, Column], added: dict[str, Column]) -> DataFrame:
    """The columns kept in ``row`` under their own names, some replaced, and new ones.

    A kept column whose name, in any case, is that of a new column is left out.
    """
    new = {k.lower() for k in added}
    first = {name: names.index(name) for name in replaced}
    kept = [
        (replaced[n] if first.get(n) == i else F.col(f"row._c{i}")).alias(n) for i, n in enumerate(names) if n.lower() not in new
    ]
    return df.select(*kept, *(c.alias(k) for k, c in added.items()))


def partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
