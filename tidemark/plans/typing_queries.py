"""Queries over typing, scalar functions, deduplication and sequencing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import keys, text
from tidemark.functions.ratings import margin_multiplier, win_expectation
from tidemark.operators import staging, star
from tidemark.operators.quality import quarantine_split
from tidemark.operators.staging import Field
from tidemark.plans.inputs import ACTIONS_SQL, CAREERS_SQL, INGESTED_AT, SIDES_SQL, actions, careers, key_sql, sides, table
from tidemark.sources import bronze, generated

LINE_FIELDS = (
    Field("l_orderkey", "game_id", "string"),
    Field("l_orderkey", "l_orderkey", "bigint"),
    Field("l_suppkey", "l_suppkey", "bigint"),
    Field("l_linenumber", "l_linenumber", "int"),
    Field("l_quantity", "l_quantity", "double", tolerant=True),
    Field("l_extendedprice", "l_extendedprice", "double", tolerant=True),
    Field("l_discount", "l_discount", "double", tolerant=True),
    Field("l_returnflag", "l_returnflag", "string"),
    Field("l_linestatus", "l_linestatus", "string"),
    Field("l_shipdate", "l_shipdate", "date"),
)


def typed_lines(spark, sf_dir):
    """Line rows landed as text and typed again."""
    raw = bronze.to_bronze(
        table(spark, sf_dir, "lineitem"), "orders", "Lines", {"source": "lineitem"}, run_id="r1", ingested_at=INGESTED_AT
    )
    return staging.typed_select(raw, LINE_FIELDS)


def latest_lines(spark, sf_dir):
    """One line per (order, line number): the last shipped, then the dearest."""
    order = [
        F.col("l_shipdate").desc_nulls_last(),
        F.col("l_extendedprice").desc_nulls_last(),
        F.col("l_suppkey"),
        F.col("l_quantity"),
        F.col("l_discount"),
        F.col("l_returnflag"),
        F.col("l_linestatus"),
    ]
    return staging.dedupe_latest(typed_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"], order, total=True)


TYPED_LINES_SQL = """
    typed_lines as (
        select cast(l_orderkey as varchar) as game_id, l_orderkey, l_suppkey, l_linenumber, l_quantity,
               l_extendedprice, l_discount, l_returnflag, l_linestatus, cast(l_shipdate as date) as l_shipdate
        from lineitem)"""

LATEST_LINES_SQL = (
    TYPED_LINES_SQL
    + """,
    latest_lines as (
        select * exclude (rn) from (
            select *, row_number() over (
                partition by l_orderkey, l_linenumber
                order by l_shipdate desc nulls last, l_extendedprice desc nulls last, l_suppkey, l_quantity,
                         l_discount, l_returnflag, l_linestatus) as rn
            from typed_lines) where rn = 1)"""
)


def _k():
    return F.get_json_object("props", "$.k")


def stg_try_cast(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        _k().alias("K"),
        F.concat(F.lit(" "), _k(), F.lit(" ")).alias("PADDED"),
        F.col("value").cast("string").alias("VALUE"),
        F.concat(_k(), F.lit(".0")).alias("FLOAT_TEXT"),
        F.when(F.col("event_type") == "error", "").otherwise(_k()).alias("BLANK"),
    )
    return staging.typed_select(
        raw,
        [
            Field("event_id", "event_id", "bigint"),
            Field("K", "k", "int", tolerant=True),
            Field("PADDED", "padded", "int", tolerant=True),
            Field("VALUE", "value_int", "int", tolerant=True),
            Field("VALUE", "value", "double", tolerant=True),
            Field("FLOAT_TEXT", "float_text", "int", tolerant=True),
            Field("BLANK", "blank", "int", tolerant=True),
        ],
    )


TRY_CAST_SQL = """
with t as (
    select event_id, props->>'$.k' as k, ' ' || (props->>'$.k') || ' ' as padded, cast(value as varchar) as v,
           (props->>'$.k') || '.0' as f, case when event_type = 'error' then '' else props->>'$.k' end as b
    from events)
select event_id, {k} as k, {padded} as padded, {v} as value_int, try_cast(v as double) as value, {f} as float_text,
       {b} as blank
from t""".format(
    **{c: f"case when regexp_full_match(trim({c}), '[+-]?[0-9]+') then try_cast({c} as int) end" for c in ("k", "padded", "v", "f", "b")}
)


def sentinel_null(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "signup", "0").otherwise(F.col("user_id").cast("string")).alias("personId"),
    )
    return staging.typed_select(
        raw,
        [Field("event_id", "event_id", "bigint"), Field("personId", "player_id", "bigint", tolerant=True, sentinel="0")],
    )


def bool_parse(spark, sf_dir):
    kind = F.col("event_type")
    flag = F.when(kind == "click", "TRUE").when(kind == "view", "1").when(kind == "signup", "0").when(kind == "purchase", "yes")
    return table(spark, sf_dir, "events").select("event_id", text.parse_flag(flag).alias("is_field_goal"))


def _matchups(spark, sf_dir):
    link = F.when(F.col("is_home"), " vs. ").otherwise(" @ ")
    name = F.concat(F.lit("T"), F.lpad((F.col("team_id") % 100).cast("string"), 2, "0"))
    other = F.concat(F.lit("T"), F.lpad((F.col("opponent_team_id") % 100).cast("string"), 2, "0"))
    return sides(spark, sf_dir).select("game_id", "team_id", F.concat(name, link, other).alias("matchup"))


_MATCHUPS_SQL = f"""
with {SIDES_SQL},
m as (select game_id, team_id, 'T' || lpad(cast(team_id % 100 as varchar), 2, '0')
             || case when is_home then ' vs. ' else ' @ ' end
             || 'T' || lpad(cast(opponent_team_id % 100 as varchar), 2, '0') as matchup from sides)
"""


def flag_like(spark, sf_dir):
    return _matchups(spark, sf_dir).select(
        "game_id",
        "team_id",
        text.matches_flag("matchup", "%vs.%").alias("is_home"),
        text.suffix_token("matchup", 3).alias("opponent_abbreviation"),
    )


def win_flag(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", text.outcome_flag("o_orderstatus", "F", "O").alias("win_flag"))


def one_hot_flags(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return customer.select(
        "c_custkey",
        text.equals_flag("c_mktsegment", "BUILDING").alias("is_building"),
        text.equals_flag("c_mktsegment", "MACHINERY").alias("is_machinery"),
    )


def coded_value(spark, sf_dir):
    exp = F.when(F.col("event_type") == "signup", "R").when(F.col("event_type") == "error", "n/a").otherwise(_k())
    return table(spark, sf_dir, "events").select("event_id", text.coded_int(exp, {"R": 0}).alias("experience_years"))


def case_decode(spark, sf_dir):
    kinds = {"F": "Finished", "O": "Open"}
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", text.decode("o_orderstatus", kinds, "Unknown").alias("status"))


def _bands(distance, pattern):
    return text.first_match(
        [
            (pattern, "Three Point"),
            (distance.isNull(), "Unknown"),
            (distance <= 4, "Restricted Area"),
            (distance <= 14, "Paint (Non-RA)"),
        ],
        "Mid-Range",
    )


def _shots(spark, sf_dir):
    """Events as shots: errors carry the three-point text, signups no text, big or odd values no distance."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    description = F.when(kind == "error", "Jump 3PT shot").when(kind != "signup", F.concat(F.lit("Shot by "), kind))
    return events.select(
        "event_id",
        "user_id",
        F.lower(description).like("%3pt%").alias("is_three"),
        F.when(F.col("value") < 200, F.col("value")).alias("shot_distance"),
        F.when(kind == "click", F.lit(None).cast("string"))
        .when(_k().cast("int") % 2 == 0, "Made")
        .otherwise("Missed")
        .alias("shot_result"),
    )


_SHOTS_SQL = """
    shots as (
        select event_id, user_id,
               lower(case when event_type = 'error' then 'Jump 3PT shot'
                          when event_type <> 'signup' then 'Shot by ' || event_type end) like '%3pt%' as is_three,
               case when value < 200 then value end as shot_distance,
               case when event_type = 'click' then null
                    when cast(props->>'$.k' as int) % 2 = 0 then 'Made' else 'Missed' end as shot_result
        from events),
    zoned as (
        select *, case when is_three then 'Three Point' when shot_distance is null then 'Unknown'
                       when shot_distance <= 4 then 'Restricted Area' when shot_distance <= 14 then 'Paint (Non-RA)'
                       else 'Mid-Range' end as shot_zone,
               shot_result = 'Made' as is_made, case when is_three then 3 else 2 end as shot_value,
               case when shot_result = 'Made' then case when is_three then 3 else 2 end else 0 end as points
        from shots)"""


def zoned_shots(spark, sf_dir):
    value = F.when(F.col("is_three"), 3).otherwise(2)
    return _shots(spark, sf_dir).withColumns(
        {
            "shot_zone": _bands(F.col("shot_distance"), F.col("is_three")),
            "is_made": F.col("shot_result") == "Made",
            "shot_value": value,
            "points": F.when(F.col("shot_result") == "Made", value).otherwise(0),
        }
    )


ZONED_SHOTS_SQL = _SHOTS_SQL


def band_classify(spark, sf_dir):
    zones = generated.zone_dim(generated.zone_rows(spark))
    shots = zoned_shots(spark, sf_dir).select("event_id", "shot_zone")
    return star.lookup(shots, zones, [("shot_zone", "shot_zone")], [("shot_zone_key", "shot_zone_key")])


def shot_points(spark, sf_dir):
    return zoned_shots(spark, sf_dir).select("event_id", "is_three", "is_made", "shot_value", "points")


def null_or_empty(spark, sf_dir):
    kind = F.col("event_type")
    comment = F.when(kind == "error", "DNP - rest").when(kind == "view", "").when(kind == "click", " ")
    return table(spark, sf_dir, "events").select("event_id", text.null_or_empty(comment).alias("did_play"))


def filter_rollup_rows(spark, sf_dir):
    rows = careers(spark, sf_dir).select(
        "player_id",
        "season",
        F.when(F.col("gp") > 4, F.lit(None)).otherwise(F.col("team_id")).alias("team_id"),
        F.when(F.col("points") < 10, "TOT").when(F.col("points") > 100, F.lit(None)).otherwise(F.col("label")).alias("label"),
    )
    return staging.drop_rollups(rows, "label", "TOT", "team_id")


ROLLUP_SQL = f"""
with {CAREERS_SQL},
r as (select player_id, season, case when gp > 4 then null else team_id end as team_id,
             case when points < 10 then 'TOT' when points > 100 then null else label end as label from careers)
select * from r where label <> 'TOT' and team_id is not null"""


def duration_seconds(spark, sf_dir):
    whole, part = F.floor("value").cast("string"), _k()
    kind = F.col("event_type")
    clock = (
        F.when(kind == "click", F.concat(whole, F.lit(":"), F.lpad(part, 2, "0")))
        .when(kind == "view", F.concat(F.lit("PT"), whole, F.lit("M"), part, F.lit(".00S")))
        .when(kind == "signup", F.concat(F.lit("PT"), part, F.lit("S")))
        .when(kind == "error", "")
        .otherwise(whole)
    )
    return table(spark, sf_dir, "events").select("event_id", text.duration_seconds(clock).alias("seconds_played"))


DURATION_SQL = """
select event_id, cast(case event_type
           when 'click' then floor(value) * 60 + cast(props->>'$.k' as int)
           when 'view' then floor(value) * 60 + cast(props->>'$.k' as int)
           when 'signup' then cast(props->>'$.k' as int)
           when 'error' then null
           else floor(value) * 60 end as int) as seconds_played
from events"""


def string_funcs(spark, sf_dir):
    name = F.col("p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.split_part(name, F.lit(" "), F.lit(1)).alias("first_word"),
        text.suffix_token(name, 3).alias("suffix"),
        F.lower("p_type").alias("lower_type"),
        F.substring("p_brand", 7, 2).alias("brand_no"),
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("size_code"),
        F.concat("p_brand", F.lit("-"), "p_type").alias("label"),
        F.regexp_extract("p_brand", r"#(\d+)", 1).alias("digits"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
    )


STRING_SQL = r"""
select p_partkey, split_part(p_name, ' ', 1) as first_word, trim(right(p_name, 3)) as suffix,
       lower(p_type) as lower_type, substr(p_brand, 7, 2) as brand_no,
       lpad(cast(p_size as varchar), 4, '0') as size_code, p_brand || '-' || p_type as label,
       regexp_extract(p_brand, '#(\d+)', 1) as digits, trim('  ' || p_name || ' ') as trimmed
from part"""


def surrogate_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    maybe = F.when(F.col("l_returnflag") == "A", F.lit(None)).otherwise(F.col("l_suppkey"))
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        keys.surrogate_key("l_orderkey", "l_linenumber", maybe).alias("line_sk"),
        keys.date_key("l_shipdate").alias("date_key"),
    )


SURROGATE_SQL = f"""
with l as (select *, case when l_returnflag = 'A' then null else l_suppkey end as m from lineitem)
select l_orderkey, l_linenumber, {key_sql("l_orderkey", "l_linenumber", "m")} as line_sk,
       cast(strftime(l_shipdate, '%Y%m%d') as int) as date_key from l"""


def event_sequence(spark, sf_dir):
    return staging.event_sequence(actions(spark, sf_dir), ["game_id", "action_number"], ["value", "props"])


SEQUENCE_SQL = f"""
with {ACTIONS_SQL}
select *, cast(row_number() over (partition by game_id, action_number order by value, props, ts, event_id) as int)
       as action_seq
from (select distinct * from actions)"""


def elo_expectation(spark, sf_dir):
    own, other = 1500.0 + F.col("points"), 1500.0 + F.col("fgm") * 2
    gap = own + 100.0 - other
    margin = F.col("points") - F.col("fgm")
    return sides(spark, sf_dir).select(
        "game_id",
        "team_id",
        F.round(win_expectation(own, other), 9).alias("win_expected"),
        F.round(margin_multiplier(margin, gap), 9).alias("multiplier"),
    )


EXPECTATION_SQL = f"""
with {SIDES_SQL}
select game_id, team_id, round(1 / (1 + pow(10, ((fgm * 2) - points) / 400.0::double)), 9) as win_expected,
       round(ln(abs(points - fgm) + 1) * (2.2::double / (abs(points + 100 - fgm * 2) * 0.001::double + 2.2::double)), 9)
           as multiplier
from sides"""


def rescue_columns(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn(
        "raw",
        F.when(
            F.col("value") > 100,
            F.concat(F.lit('{"k":'), _k(), F.lit(',"note":"'), F.col("event_type"), F.lit('"}')),
        ).otherwise(F.col("props")),
    )
    return bronze.rescue_columns(events, "raw", ["k"]).select("event_id", _k().cast("int").alias("k"), "_rescued_data")


def quarantine(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    good, bad = quarantine_split(
        events,
        {"value_in_range": F.col("value").between(1, 200), "not_an_error": F.col("event_type") != "error"},
    )
    kept = good.select("event_id", F.lit("").alias("failed"))
    return kept.unionByName(bad.select("event_id", F.array_join("_failed", ",").alias("failed")))


QUARANTINE_SQL = """
select event_id, concat_ws(',', case when not value between 1 and 200 then 'value_in_range' end,
                                case when event_type = 'error' then 'not_an_error' end) as failed
from events"""


QUERIES = {
    "stg_typed": typed_lines,
    "stg_try_cast": stg_try_cast,
    "sentinel_null": sentinel_null,
    "bool_parse": bool_parse,
    "flag_like": flag_like,
    "win_flag": win_flag,
    "one_hot_flags": one_hot_flags,
    "coded_value": coded_value,
    "case_decode": case_decode,
    "band_classify": band_classify,
    "shot_points": shot_points,
    "null_or_empty": null_or_empty,
    "filter_rollup_rows": filter_rollup_rows,
    "duration_seconds": duration_seconds,
    "string_funcs": string_funcs,
    "surrogate_key": surrogate_key,
    "dedupe_latest": latest_lines,
    "event_sequence": event_sequence,
    "elo_expectation": elo_expectation,
    "rescue_columns": rescue_columns,
    "quarantine_split": quarantine,
}

ORACLE = {
    "stg_typed": f"with {TYPED_LINES_SQL} select * from typed_lines",
    "stg_try_cast": TRY_CAST_SQL,
    "sentinel_null": """select event_id, nullif(case when event_type = 'signup' then 0 else user_id end, 0) as player_id
                        from events""",
    "bool_parse": "select event_id, event_type in ('click', 'view') as is_field_goal from events",
    "flag_like": _MATCHUPS_SQL
    + """select game_id, team_id, coalesce(matchup like '%vs.%', false) as is_home, trim(right(matchup, 3)) as opponent_abbreviation
         from m""",
    "win_flag": """select o_orderkey, cast(case o_orderstatus when 'F' then 1 when 'O' then 0 end as int) as win_flag
                   from orders""",
    "one_hot_flags": """select c_custkey, c_mktsegment = 'BUILDING' as is_building,
                               c_mktsegment = 'MACHINERY' as is_machinery from customer""",
    "coded_value": """select event_id, case event_type when 'signup' then 0 when 'error' then null
                             else cast(props->>'$.k' as int) end as experience_years from events""",
    "case_decode": """select o_orderkey, case o_orderstatus when 'F' then 'Finished' when 'O' then 'Open'
                             else 'Unknown' end as status from orders""",
    "band_classify": f"""with {_SHOTS_SQL} select event_id, shot_zone, {key_sql("shot_zone")} as shot_zone_key
                         from zoned""",
    "shot_points": f"with {_SHOTS_SQL} select event_id, is_three, is_made, shot_value, points from zoned",
    "null_or_empty": "select event_id, event_type not in ('error', 'click') as did_play from events",
    "filter_rollup_rows": ROLLUP_SQL,
    "duration_seconds": DURATION_SQL,
    "string_funcs": STRING_SQL,
    "surrogate_key": SURROGATE_SQL,
    "dedupe_latest": f"with {LATEST_LINES_SQL} select * from latest_lines",
    "event_sequence": SEQUENCE_SQL,
    "elo_expectation": EXPECTATION_SQL,
    "rescue_columns": """select event_id, cast(props->>'$.k' as int) as k,
                                case when value > 100 then '{"note":"' || event_type || '"}' end as _rescued_data
                         from events""",
    "quarantine_split": QUARANTINE_SQL,
}
