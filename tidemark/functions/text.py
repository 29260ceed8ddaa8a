"""Text parsing and rendering expressions used while typing raw tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_sql(name: str, dtype: T.DataType) -> str:
    """SQL for the text a column's value lands as in a raw table.

    Numbers keep their type's spelling (23.0 stays '23.0'), floats switch to an
    exponent only below 1e-4 and from 1e16 on, booleans are capitalised, and
    NaN, like NULL, lands as NULL. SQL text, because a wide table would take
    several calls into the JVM for each of its columns otherwise.
    """
    c = f"`{name}`"
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.BooleanType):
        return f"initcap(cast({c} as string))"
    if isinstance(dtype, T.DoubleType | T.FloatType):
        # kept short, as all columns of a table share one generated method
        text = f"cast({c} as string)"
        digits, power = f"substring_index({text}, 'E', 1)", f"cast(substring_index({text}, 'E', -1) as int)"
        # written out in full: 16 digits before the point, 22 behind it
        full = f"regexp_replace(try_cast({text} as decimal(38,22)), '([.][0-9]+?)0*$', '$1')"
        exponent = f"concat(regexp_replace({digits}, '[.]0$', ''), 'e', format_string('%+03d', {power}))"
        return f"""case when instr({text}, 'E') = 0 then nullif(replace({text}, 'Infinity', 'inf'), 'NaN')
            when abs({c}) >= 1e-4 and abs({c}) < 1e16 then {full}
            else {exponent} end"""
    if isinstance(dtype, T.ArrayType | T.MapType | T.StructType):
        return f"to_json({c})"
    return f"cast({c} as string)"


def duration_seconds(c: str | Column) -> Column:
    """Seconds from 'MM:SS', 'PT34M21.00S' or decimal minutes; blank or unreadable gives NULL.

    Fractions are cut off. An absent minute or second part of the PT form is 0.
    """
    text = _column(c)
    minutes = F.regexp_extract(text, r"PT(\d+)M", 1).try_cast("int")
    seconds = F.regexp_extract(text, r"(\d+)(\.\d+)?S", 1).try_cast("int")
    zero = F.lit(0)

    def clock(part: int) -> Column:
        return F.split_part(text, F.lit(":"), F.lit(part)).try_cast("double").try_cast("int")

    return (
        F.when(text.isNull() | (F.trim(text) == ""), F.lit(None).cast("int"))
        .when(text.like("PT%"), F.coalesce(minutes, zero) * 60 + F.coalesce(seconds, zero))
        .when(text.like("%:%"), clock(1) * 60 + clock(2))
        .otherwise((text.try_cast("double") * 60).try_cast("int"))
    )


def null_if(c: str | Column, sentinel: str) -> Column:
    """NULL where the text equals a sentinel."""
    return F.nullif(_column(c), F.lit(sentinel))


def parse_flag(c: str | Column, truthy: Sequence[str] = ("1", "true")) -> Column:
    """True for the given lower-cased texts, False for anything else including NULL."""
    return F.when(F.lower(_column(c)).isin(*truthy), True).otherwise(False)


def matches_flag(c: str | Column, pattern: str) -> Column:
    """True where the text is LIKE the pattern, else False (NULL is False)."""
    return F.when(_column(c).like(pattern), True).otherwise(False)


def equals_flag(c: str | Column, value: str) -> Column:
    """One-hot flag of a category: True on equality, else False (NULL is False)."""
    return F.when(_column(c) == value, True).otherwise(False)


def outcome_flag(c: str | Column, win: str = "W", loss: str = "L") -> Column:
    """1 / 0 for the two outcomes, NULL for anything else."""
    return F.when(_column(c) == win, 1).when(_column(c) == loss, 0)


def coded_int(c: str | Column, codes: Mapping[str, int]) -> Column:
    """Integer text in which some codes stand for fixed numbers; unreadable gives NULL."""
    out: Column | None = None
    for code, value in codes.items():
        test = _column(c) == code
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    parsed = _column(c).try_cast("int")
    return parsed if out is None else out.otherwise(parsed)


def decode(c: str | Column, mapping: Mapping[str, str], default: str) -> Column:
    """Label of a code, with a default for unknown codes and NULL."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.coalesce(_column(c), F.lit(""))), F.lit(default))


def null_or_empty(c: str | Column) -> Column:
    """True for NULL and for the empty text."""
    return _column(c).isNull() | (_column(c) == "")


def suffix_token(c: str | Column, length: int) -> Column:
    """The last ``length`` characters, trimmed."""
    return F.trim(F.right(_column(c), F.lit(length)))


def period_label(start_year: str | Column) -> Column:
    """'1999-00' for start year 1999."""
    year = _column(start_year).cast("int")
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(((year + 1) % 100).cast("string"), 2, "0"))


def first_match(bands: Sequence[tuple[Column, str]], default: str) -> Column:
    """Ordered classification: the label of the first condition that is true."""
    out: Column | None = None
    for test, label in bands:
        out = F.when(test, label) if out is None else out.when(test, label)
    return F.lit(default) if out is None else out.otherwise(default)
