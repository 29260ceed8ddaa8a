"""Tool calls of conversations: linked with their results, ordered, validated and written as canonical JSON.

Calls and results meet in a hash join on their identifier. A call can name a parent, the
call whose result it builds on; levels in that order come from joins of a table with itself that
double the distance they bridge. Arguments are JSON, read as variants, whose keys are
sorted and whose types are checked.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick
from tidemark.session import discard, written

#: What a variant's type begins with, by kind of parameter.
_TYPES = {
    "string": ("STRING",),
    "integer": ("BIGINT", "DECIMAL(38,0)"),
    "number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"),
    "boolean": ("BOOLEAN",),
    "array": ("ARRAY",),
    "object": ("OBJECT",),
}
#: The strings, numbers and other stretches that make up a JSON text.
_JSON_TOKENS = r'("(?:[^"\\]|\\.)*"|-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?|[^"\d-]+|.)'


@dataclass(frozen=True)
class Parameter:
    """One argument of a tool: kind is string, integer, number, boolean, array or object.

    Bounds are for numbers, for the lengths of strings and arrays, and for how many keys an object has.
    ``values`` lists the only strings, or texts of other values, that are accepted. 3.0 is an integer.
    """

    name: str
    kind: str
    required: bool = False
    least: float | None = None
    most: float | None = None
    values: tuple[str, ...] | None = None


Tools = dict[str, list[Parameter]]


def canonical(arguments: Column) -> Column:
    """A JSON text with each number in one form, as a variant, or NULL if it is no JSON or repeats a key.

    Whole numbers are written by their digits; others, and those with more than 38 digits, as the nearest double.
    """

    def number(t: Column) -> Column:
        whole = t.try_cast("decimal(38,0)")
        double = t.try_cast("double")
        plain = ~F.contains(t, F.lit(".")) & ~F.contains(F.lower(t), F.lit("e"))
        fits = (double == F.floor(double)) & (F.abs(double) < 1e15)
        return F.when(plain & whole.isNotNull(), whole.cast("string")).when(fits, double.cast("bigint").cast("string")).when(
            F.abs(double) < float("inf"), double.cast("string")
        ).otherwise(t)

    tokens = F.regexp_extract_all(arguments, F.lit(_JSON_TOKENS), F.lit(1))
    spelt = F.array_join(F.transform(tokens, lambda t: F.when(t.rlike(r"^-?[0-9]"), number(t)).otherwise(t)), "")
    several = arguments.rlike(r"[0-9][.eE]|-0|[0-9]{19}")
    return F.when(F.try_parse_json(arguments).isNotNull(), F.try_parse_json(F.when(several, spelt).otherwise(arguments)))


def _errors(name: Column, arguments: Column, tools: Tools) -> Column:
    """The sorted list of what is wrong with a call's arguments; ``arguments`` is a variant."""
    wrong = F.when(name.isNull() | ~name.isin(*tools), F.array(F.lit("unknown_tool")))
    given = F.try_variant_get(arguments, "$", "map<string,variant>")
    for tool, parameters in sorted(tools.items()):
        found = []
        for p in parameters:
            value = F.try_element_at(given, F.lit(p.name))
            kind = F.schema_of_variant(value)
            text = F.try_variant_get(value, "$", "string")
            if p.kind in ("integer", "number"):
                measure = F.try_variant_get(value, "$", "double")
            elif p.kind == "array":
                measure = F.size(F.try_variant_get(value, "$", "array<variant>"))
            elif p.kind == "object":
                measure = F.size(F.map_keys(F.try_variant_get(value, "$", "map<string,variant>")))
            else:
                measure = F.length(text)
            out = F.lit(False)
            if p.least is not None:
                out = out | (measure < p.least)
            if p.most is not None:
                out = out | (measure > p.most)
            typed = reduce(lambda a, b: a | b, [F.startswith(kind, F.lit(t)) for t in _TYPES[p.kind]])
            missing = F.when(value.isNull(), F.lit(f"missing:{p.name}" if p.required else None).cast("string"))
            missing = missing.when(value.isNotNull() & ~typed, F.lit(f"type:{p.name}"))
            if p.values is not None:
                missing = missing.when(value.isNotNull() & ~text.isin(*p.values), F.lit(f"value:{p.name}"))
            found.append(missing.when(value.isNotNull() & out, F.lit(f"range:{p.name}")))
        keys = F.coalesce(F.map_keys(given), F.array().cast("array<string>"))
        extra = F.transform(F.array_except(keys, F.array(*(F.lit(p.name) for p in parameters)).cast("array<string>")), lambda k: F.concat(F.lit("unexpected:"), k))
        listed = F.sort_array(F.concat(F.array_compact(F.array(*found).cast("array<string>")), extra))
        malformed = arguments.isNull() | ~F.startswith(F.schema_of_variant(arguments), F.lit("OBJECT"))
        wrong = wrong.when(name == tool, F.when(malformed, F.array(F.lit("malformed"))).otherwise(listed))
    return wrong


def levels(calls: DataFrame) -> DataFrame:
    """(c, k, level) for calls (c: conversation, k: identifier, up: parent's identifier or null), unique in (c, k).

    A call without a known parent has level 0, any other one more than its parent. Calls on a cycle, or
    that build on one, have a null level. Takes rounds by the logarithm of the longest chain.
    """
    ids = calls.select(F.col("c").alias("pc"), F.col("k").alias("pk"))
    known = calls.join(ids, F.col("c").eqNullSafe(F.col("pc")) & (F.col("up") == F.col("pk")), "left")
    state = written(known.select("c", "k", F.col("pk").alias("up"), F.when(F.col("pk").isNull(), 0).otherwise(1).cast("long").alias("level")), "levels")
    rounds = max(1, state.count().bit_length())
    for _ in range(rounds):
        if state.where("up IS NOT NULL").isEmpty():
            break
        there = state.select(F.col("c").alias("tc"), F.col("k").alias("tk"), F.col("up").alias("far"), F.col("level").alias("more"))
        step = state.join(there, F.col("c").eqNullSafe(F.col("tc")) & (F.col("up") == F.col("tk")), "left")
        before, state = state, written(step.select("c", "k", F.col("far").alias("up"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")), "levels")
        discard(before)
    return state.select("c", "k", F.when(F.col("up").isNull(), F.col("level")).alias("level"))


def link_tool_calls(calls: DataFrame, results: DataFrame, tools: Tools) -> DataFrame:
    """(conv_id, turn, kind, call_id, level, linked, errors, json) for every call and every result.

    ``calls`` has conv_id, turn, call_id, parent_id, name and arguments (JSON text); ``results`` has conv_id,
    turn, call_id and content. In a conversation, the first call of an identifier (smallest turn,
    then name and arguments) and its first result are linked. ``level`` is twice the call's place in the
    order of parents, and one more for its result: sorting a conversation by it puts everything after
    what it builds on. ``errors``, joined by semicolons: what is wrong with the arguments;
    no_id; repeated_id for a later call or result of an identifier; unknown_parent; cycle; no_call for a result whose
    call is missing. Rows with no_id, repeated_id or no_call are not linked and have a null level, as have calls on a cycle.

    ``json`` has sorted keys, no spaces, and numbers in one form (``canonical``); arguments that are no JSON, or repeat a key,
    stand as text under raw_arguments. A null conv_id is a conversation of its own. Rows that
    repeat in all columns are one first row and later ones. Other columns are ignored; empty
    tables give no rows.
    """
    calls = pick(calls, c="conv_id", turn="turn", k="call_id", up="parent_id", name="name", arguments="arguments")
    results = pick(results, c="conv_id", turn="turn", k="call_id", content="content")

    def first(rows: DataFrame, *columns: str) -> DataFrame:
        """One row of each identifier, and of how many equal rows it stands for."""
        counted = rows.groupBy("c", "k", *columns).agg(F.count(F.lit(1)).alias("copies"))
        least = counted.where("k IS NOT NULL").groupBy("c", "k").agg(F.min(F.struct(*columns)).alias("least"))
        least = least.select(F.col("c").alias("lc"), F.col("k").alias("lk"), "least")
        same = F.col("c").eqNullSafe(F.col("lc")) & (F.col("k") == F.col("lk")) & F.struct(*columns).eqNullSafe(F.col("least"))
        marked = counted.join(least, same, "left").withColumn("is_first", F.col("lk").isNotNull())
        # of equal rows one is the first
        split = F.when(F.col("is_first") & (F.col("copies") > 1), F.array(F.struct(F.lit(True).alias("f"), F.lit(1).cast("long").alias("n")), F.struct(F.lit(False).alias("f"), (F.col("copies") - 1).alias("n"))))
        split = split.otherwise(F.array(F.struct(F.col("is_first").alias("f"), F.col("copies").alias("n"))))
        rows = marked.select("c", "k", *columns, F.explode(split).alias("x")).select("c", "k", *columns, F.col("x.f").alias("is_first"), "x.n")
        return rows.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("n", "i")

    marked = written(first(calls, "turn", "name", "arguments", "up"), "calls")
    answers = first(results, "turn", "content")
    firsts = marked.where("is_first")
    placed = levels(firsts.select("c", "k", "up")).select(F.col("c").alias("vc"), F.col("k").alias("vk"), "level", F.lit(True).alias("known"))
    placed = written(placed, "levels")

    def at(of: str, to: str) -> Column:
        return F.col("c").eqNullSafe(F.col(f"{to}c")) & (F.col(of) == F.col(f"{to}k"))

    parents = placed.select(F.col("vc").alias("uc"), F.col("vk").alias("uk"), F.lit(True).alias("has_parent"))
    ours = marked.join(placed, at("k", "v") & F.col("is_first"), "left").join(parents, at("up", "u"), "left")
    linked_answers = answers.where("is_first").select(F.col("c").alias("rc"), F.col("k").alias("rk"), F.lit(True).alias("answered"))
    ours = ours.join(linked_answers, at("k", "r") & F.col("is_first"), "left")
    noted = F.array_compact(
        F.array(
            F.when(F.col("k").isNull(), F.lit("no_id")),
            F.when(F.col("k").isNotNull() & ~F.col("is_first"), F.lit("repeated_id")),
            F.when(F.col("is_first") & F.col("up").isNotNull() & F.col("has_parent").isNull(), F.lit("unknown_parent")),
            F.when(F.col("is_first") & F.col("level").isNull(), F.lit("cycle")),
        )
    )
    ours = ours.withColumn("v", canonical(F.col("arguments")))
    called = ours.select(
        F.col("c").alias("conv_id"),
        "turn",
        F.lit("call").alias("kind"),
        F.col("k").alias("call_id"),
        (2 * F.col("level")).alias("level"),
        F.coalesce("answered", F.lit(False)).alias("linked"),
        F.array_join(F.concat(_errors(F.col("name"), F.col("v"), tools), noted), ";").alias("errors"),
        F.to_json(
            F.struct(
                F.col("v").alias("arguments"), F.col("k").alias("id"), "name", F.when(F.col("v").isNull(), F.col("arguments")).alias("raw_arguments"), F.lit("call").alias("type")
            )
        ).alias("json"),
    )
    answers = answers.join(placed, at("k", "v") & F.col("is_first"), "left")
    wrong = F.array_compact(
        F.array(
            F.when(F.col("k").isNull(), F.lit("no_id")),
            F.when(F.col("k").isNotNull() & ~F.col("is_first"), F.lit("repeated_id")),
            F.when(F.col("is_first") & F.col("known").isNull(), F.lit("no_call")),
        )
    )
    answered = answers.select(
        F.col("c").alias("conv_id"),
        "turn",
        F.lit("result").alias("kind"),
        F.col("k").alias("call_id"),
        (2 * F.col("level") + 1).alias("level"),
        F.coalesce("known", F.lit(False)).alias("linked"),
        F.array_join(wrong, ";").alias("errors"),
        F.to_json(F.struct(F.col("k").alias("call_id"), "content", F.lit("result").alias("type"))).alias("json"),
    )
    return called.unionByName(answered)


def structured_calls(messages: DataFrame) -> DataFrame:
    """Calls in assistant messages of the form {"tool_calls": [{"id", "parent_id", "name", "arguments"}]}."""
    own = pick(messages, conv_id="conv_id", turn="turn", role="role", text="text").where("role = 'assistant'")
    form = "tool_calls array<struct<id string, parent_id string, name string, arguments string>>"
    found = own.select("conv_id", "turn", F.explode(F.from_json("text", form).tool_calls).alias("x")).where("x IS NOT NULL")
    return found.select("conv_id", "turn", F.col("x.id").alias("call_id"), "x.parent_id", "x.name", "x.arguments")


def structured_results(messages: DataFrame) -> DataFrame:
    """Results in tool messages of the form {"tool_call_id", "content"}."""
    own = pick(messages, conv_id="conv_id", turn="turn", role="role", text="text").where("role = 'tool'")
    found = own.select("conv_id", "turn", F.from_json("text", "tool_call_id string, content string").alias("x"))
    return found.select("conv_id", "turn", F.col("x.tool_call_id").alias("call_id"), "x.content")


def exchanged_calls(messages: DataFrame) -> DataFrame:
    """Each user turn as a call: short ones look up, longer ones ask for a summary of so many words; it builds on the user turn two before."""
    own = pick(messages, conv_id="conv_id", turn="turn", role="role", text="text").where("role = 'user'")
    short = F.length("text") < 200
    lookup = F.to_json(F.struct(F.col("text").alias("query"), F.col("turn").alias("limit")))
    summary = F.to_json(F.struct(F.size(F.split("text", " ")).alias("max_words"), F.col("text").alias("text")))
    return own.select(
        "conv_id",
        "turn",
        F.concat_ws("-", F.lit("call"), "conv_id", "turn").alias("call_id"),
        F.when(F.col("turn") >= 2, F.concat_ws("-", F.lit("call"), "conv_id", F.col("turn") - 2)).alias("parent_id"),
        F.when(short, F.lit("lookup")).otherwise(F.lit("summarize")).alias("name"),
        F.when(short, lookup).otherwise(summary).alias("arguments"),
    )


def exchanged_results(messages: DataFrame) -> DataFrame:
    """Each assistant turn as the result of the call one turn before."""
    own = pick(messages, conv_id="conv_id", turn="turn", role="role", text="text").where("role = 'assistant'")
    return own.select("conv_id", "turn", F.concat_ws("-", F.lit("call"), "conv_id", F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))


#: The tools of the exchanged calls.
TOOLS: Tools = {
    "lookup": [Parameter("limit", "integer", True, 0, 6), Parameter("query", "string", True, 1)],
    "summarize": [Parameter("max_words", "integer", True, 1, 60), Parameter("text", "string", True, 1)],
}

ORACLE = """
WITH RECURSIVE calls AS (
  SELECT conv_id, turn, text, min(text) OVER w AS least, row_number() OVER (PARTITION BY conv_id, turn ORDER BY text) AS i,
    'call-' || conv_id || '-' || turn AS call_id, length(text) < 200 AS short, len(string_split(text, ' ')) AS words
  FROM conversations WHERE role = 'user' WINDOW w AS (PARTITION BY conv_id, turn)
), results AS (
  SELECT conv_id, turn, text, 'call-' || conv_id || '-' || (turn - 1) AS call_id,
    row_number() OVER (PARTITION BY conv_id, turn ORDER BY text) AS i
  FROM conversations WHERE role = 'assistant'
), firsts AS (
  SELECT conv_id, turn FROM calls WHERE i = 1
), chain AS (
  SELECT conv_id, turn, 0 AS level FROM firsts f WHERE turn < 2 OR NOT EXISTS (SELECT 1 FROM firsts g WHERE g.conv_id = f.conv_id AND g.turn = f.turn - 2)
  UNION ALL
  SELECT f.conv_id, f.turn, c.level + 1 FROM chain c JOIN firsts f ON f.conv_id = c.conv_id AND f.turn = c.turn + 2
)
SELECT c.conv_id, c.turn, 'call' AS kind, c.call_id, CASE WHEN c.i = 1 THEN 2 * l.level END AS level,
  c.i = 1 AND EXISTS (SELECT 1 FROM results r WHERE r.conv_id = c.conv_id AND r.turn = c.turn + 1) AS linked,
  array_to_string(list_filter([
    CASE WHEN c.short AND (c.turn < 0 OR c.turn > 6) THEN 'range:limit' WHEN NOT c.short AND (c.words < 1 OR c.words > 60) THEN 'range:max_words' END,
    CASE WHEN c.text = '' THEN 'range:query' END,
    CASE WHEN c.i > 1 THEN 'repeated_id' END,
    CASE WHEN c.i = 1 AND c.turn >= 2 AND NOT EXISTS (SELECT 1 FROM firsts g WHERE g.conv_id = c.conv_id AND g.turn = c.turn - 2) THEN 'unknown_parent' END
  ], lambda x: x IS NOT NULL), ';') AS errors,
  CASE WHEN c.short THEN '{"arguments":{"limit":' || c.turn || ',"query":' || to_json(c.text) || '},"id":"' || c.call_id || '","name":"lookup","type":"call"}'
    ELSE '{"arguments":{"max_words":' || c.words || ',"text":' || to_json(c.text) || '},"id":"' || c.call_id || '","name":"summarize","type":"call"}' END AS json
FROM calls c LEFT JOIN chain l ON l.conv_id = c.conv_id AND l.turn = c.turn
UNION ALL
SELECT r.conv_id, r.turn, 'result', r.call_id, CASE WHEN r.i = 1 THEN 2 * l.level + 1 END, r.i = 1 AND l.level IS NOT NULL,
  CASE WHEN r.i > 1 THEN 'repeated_id' WHEN l.level IS NULL THEN 'no_call' ELSE '' END,
  '{"call_id":"' || r.call_id || '","content":' || to_json(r.text) || ',"type":"result"}'
FROM results r LEFT JOIN chain l ON l.conv_id = r.conv_id AND l.turn = r.turn - 1
"""
