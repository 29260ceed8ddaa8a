"""Hashed keys: surrogate keys, date keys and slice hashes."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import text_sql

# Fixed value: stands for NULL inside a hashed key.
NULL_KEY = "_dbt_utils_surrogate_key_null_"

# Fixed value: length of a slice hash.
SLICE_HASH_LENGTH = 12


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: str | Column) -> Column:
    """MD5 of the columns' text joined by '-', NULLs replaced by a fixed marker."""
    parts = [F.coalesce(_column(c).cast("string"), F.lit(NULL_KEY)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def date_key(c: str | Column) -> Column:
    """Integer yyyyMMdd of a date."""
    return F.date_format(_column(c), "yyyyMMdd").cast("int")


def params_json(params: Mapping[str, object]) -> str:
    """The text form of one slice's parameters: sorted keys, other types as text."""
    return json.dumps(dict(params), sort_keys=True, default=str)


def _quoted(text: Column) -> Column:
    """A JSON string of pure ASCII: everything outside it becomes a \\uXXXX escape."""

    def unit(code: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))

    def escape(ch: Column) -> Column:
        code = F.ascii(ch).cast("long")
        above = code - 0x10000
        return (
            F.when(ch == '"', F.lit('\\"'))
            .when(ch == "\\", F.lit("\\\\"))
            .when(ch == "\n", F.lit("\\n"))
            .when(ch == "\r", F.lit("\\r"))
            .when(ch == "\t", F.lit("\\t"))
            .when(ch == "\b", F.lit("\\b"))
            .when(ch == "\f", F.lit("\\f"))
            .when(code.between(32, 126), ch)
            .when(code < 0x10000, unit(code))
            .otherwise(
                F.concat(
                    unit(F.lit(0xD800) + F.shiftright(above, 10)),
                    unit(F.lit(0xDC00) + above.bitwiseAND(F.lit(0x3FF))),
                )
            )
        )

    plain = text.rlike(r'\A[ !#-\[\]-~]*\z')
    chars = F.filter(F.split(text, ""), lambda ch: ch != "")
    body = F.when(plain, text).otherwise(F.array_join(F.transform(chars, escape), ""))
    return F.concat(F.lit('"'), body, F.lit('"'))


def row_params_json(df: DataFrame, params: Mapping[str, str]) -> Column:
    """Per-row counterpart of :func:`params_json`: parameter name -> column of ``df``."""
    pieces = []
    for i, name in enumerate(sorted(params)):
        dtype = df.schema[params[name]].dataType
        value = F.expr(text_sql(params[name], dtype))
        if isinstance(dtype, T.BooleanType):
            value = F.lower(value)
        elif not isinstance(dtype, T.IntegralType | T.FloatType | T.DoubleType):
            value = _quoted(value)
        lead = ("{" if i == 0 else ", ") + json.dumps(name) + ": "
        pieces += [F.lit(lead), F.coalesce(value, F.lit("null"))]
    return F.concat(*pieces, F.lit("}")) if pieces else F.lit("{}")


def slice_hash(text: str | Column) -> Column:
    """First hex digits of the SHA-1 of a slice's parameter text."""
    return F.substring(F.sha1(F.lit(text) if isinstance(text, str) else text), 1, SLICE_HASH_LENGTH)
