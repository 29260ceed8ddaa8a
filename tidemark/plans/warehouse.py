"""A basketball warehouse built from the operators: raw tables to star schema and marts.

Every function takes DataFrames and returns one. :class:`Warehouse` plans them
lazily; :func:`write_tables` stores those that several others use.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.functions.keys import date_key, surrogate_key
from tidemark.operators import efficiency, history, marts, quality, staging, star
from tidemark.operators.ordered import dealt_once
from tidemark.operators.staging import Field, typed_select
from tidemark.sources import bronze as raw
from tidemark.sources import generated

# The raw tables.
TEAMS = "static_teams__Teams"
PLAYERS = "commonallplayers__CommonAllPlayers"
TEAM_GAMES = "leaguegamelog__LeagueGameLog"
BOX_SCORE = "boxscoretraditionalv3__PlayerStats"
BOX_SCORE_ADVANCED = "boxscoreadvancedv3__PlayerStats"
PLAY_BY_PLAY = "playbyplayv3__PlayByPlay"
CAREER = "playercareerstats__SeasonTotalsRegularSeason"
ROSTER = "commonteamroster__CommonTeamRoster"
COACHES = "commonteamroster__Coaches"


def _fields(spec: str) -> list[Field]:
    """Fields from 'SOURCE name type' lines: '?' marks a tolerant cast, '-0' that '0' means NULL."""
    out = []
    for line in spec.strip().splitlines():
        source, name, kind = line.split()
        sentinel = "0" if kind.endswith("-0") else None
        kind = kind.removesuffix("-0")
        out.append(Field(source, name, kind.removesuffix("?"), kind.endswith("?"), sentinel))
    return out


# Raw column, typed name and type of every staged table.
TEAM_FIELDS = _fields("""
    ID team_id bigint
    FULL_NAME team_name string
    ABBREVIATION team_abbreviation string
    NICKNAME team_nickname string
    CITY team_city string
    STATE team_state string
    YEAR_FOUNDED year_founded int
""")
PLAYER_FIELDS = _fields("""
    PERSON_ID player_id bigint
    DISPLAY_FIRST_LAST player_name string
    DISPLAY_LAST_COMMA_FIRST player_name_last_first string
    ROSTERSTATUS roster_status int
    TEAM_ID team_id bigint-0
    TEAM_ABBREVIATION team_abbreviation string
    FROM_YEAR from_year int
    TO_YEAR to_year int
    PLAYER_SLUG player_slug string
""")
TEAM_GAME_KEYS = _fields("""
    GAME_ID game_id string
    TEAM_ID team_id bigint
    TEAM_ABBREVIATION team_abbreviation string
    SEASON_ID season_id string
    GAME_DATE game_date date
    MATCHUP matchup string
""")
TEAM_GAME_COUNTS = _fields("""
    MIN team_minutes int?
    PTS points int?
    FGM fgm int?
    FGA fga int?
    FG_PCT fg_pct double?
    FG3M fg3m int?
    FG3A fg3a int?
    FG3_PCT fg3_pct double?
    FTM ftm int?
    FTA fta int?
    FT_PCT ft_pct double?
    OREB oreb int?
    DREB dreb int?
    REB reb int?
    AST ast int?
    STL stl int?
    BLK blk int?
    TOV tov int?
    PF pf int?
    PLUS_MINUS plus_minus double?
""")
BOX_KEYS = _fields("""
    gameId game_id string
    teamId team_id bigint
    teamTricode team_tricode string
    personId player_id bigint
    nameI player_name string
    position position string
    comment comment string
    jerseyNum jersey_num string
""")
BOX_COUNTS = _fields("""
    fieldGoalsMade fgm int?
    fieldGoalsAttempted fga int?
    fieldGoalsPercentage fg_pct double?
    threePointersMade fg3m int?
    threePointersAttempted fg3a int?
    threePointersPercentage fg3_pct double?
    freeThrowsMade ftm int?
    freeThrowsAttempted fta int?
    freeThrowsPercentage ft_pct double?
    reboundsOffensive oreb int?
    reboundsDefensive dreb int?
    reboundsTotal reb int?
    assists ast int?
    steals stl int?
    blocks blk int?
    turnovers tov int?
    foulsPersonal pf int?
    points points int?
    plusMinusPoints plus_minus double?
""")
ADVANCED_FIELDS = _fields("""
    gameId game_id string
    personId player_id bigint
    offensiveRating offensive_rating double?
    defensiveRating defensive_rating double?
    netRating net_rating double?
    assistPercentage assist_pct double?
    assistToTurnover assist_to_turnover double?
    offensiveReboundPercentage oreb_pct double?
    defensiveReboundPercentage dreb_pct double?
    reboundPercentage reb_pct double?
    turnoverRatio turnover_ratio double?
    effectiveFieldGoalPercentage efg_pct double?
    trueShootingPercentage ts_pct double?
    usagePercentage usage_pct double?
    pace pace double?
    possessions possessions double?
    PIE pie double?
""")
EVENT_FIELDS = _fields("""
    gameId game_id string
    actionNumber action_number int?
    clock clock string
    period period int?
    teamId team_id bigint?-0
    teamTricode team_tricode string
    personId player_id bigint?-0
    playerName player_name string
    actionType action_type string
    subType sub_type string
    description description string
    scoreHome score_home int?
    scoreAway score_away int?
""")
EVENT_SHOT_FIELDS = _fields("""
    shotResult shot_result string
    shotDistance shot_distance double?
    xLegacy x_legacy double?
    yLegacy y_legacy double?
""")
CAREER_FIELDS = _fields("""
    PLAYER_ID player_id bigint
    SEASON_ID season string
    TEAM_ID team_id bigint?-0
    TEAM_ABBREVIATION team_abbreviation string
    PLAYER_AGE player_age int?
    GP gp int?
    GS gs int?
    MIN minutes double?
    PTS points int?
    REB reb int?
    AST ast int?
    STL stl int?
    BLK blk int?
    TOV tov int?
    FGM fgm int?
    FGA fga int?
    FG3M fg3m int?
    FG3A fg3a int?
    FTM ftm int?
    FTA fta int?
""")
ROSTER_FIELDS = _fields("""
    PLAYER_ID player_id bigint
    PLAYER player_name string
    NICKNAME nickname string
    PLAYER_SLUG player_slug string
    NUM jersey_number string
    POSITION position string
    HEIGHT height string
    WEIGHT weight_lbs int?
    BIRTH_DATE birth_date string
    AGE age double?
    SCHOOL school string
    HOW_ACQUIRED how_acquired string
""")
COACH_FIELDS = _fields("""
    TEAM_ID team_id bigint
    COACH_ID coach_id bigint
    FIRST_NAME first_name string
    LAST_NAME last_name string
    COACH_NAME coach_name string
    COACH_TYPE coach_type string
    IS_ASSISTANT is_assistant_code int?
    SORT_SEQUENCE sort_sequence int?
    SUB_SORT_SEQUENCE sub_sort_sequence int?
""")
TEAM_CHECKS = ["team_name", "team_abbreviation", "team_city", "team_nickname", "team_state"]
PLAYER_CHECKS = ["player_name", "team_id", "roster_status", "team_abbreviation"]

# The advanced measures kept per player and game, and the keys of the paired measures.
UNIFIED_ADVANCED = [
    "offensive_rating", "defensive_rating", "net_rating", "usage_pct", "efg_pct", "ts_pct", "pace", "possessions", "pie",
]
EFFICIENCY_KEYS = [
    "team_game_sk", "game_sk", "game_id", "team_id", "opponent_team_id", "team_sk", "opponent_team_sk", "date_key",
    "season_key", "game_date", "is_home", "win_flag",
]


def _names(fields: list[Field]) -> list[str]:
    return [f.name for f in fields]


# --- staging -----------------------------------------------------------------


def stg_teams(rows: DataFrame) -> DataFrame:
    return typed_select(rows, TEAM_FIELDS)


def stg_players(rows: DataFrame) -> DataFrame:
    """One row per player: the one active latest."""
    latest = [F.col("to_year").desc_nulls_last(), F.col("from_year").desc_nulls_last()]
    return staging.dedupe_latest(typed_select(rows, PLAYER_FIELDS), ["player_id"], latest)


def stg_team_game(rows: DataFrame) -> DataFrame:
    """One row per side of a game; repeated raw rows stay, a data test guards against them."""
    derived = [
        text.matches_flag("MATCHUP", "%vs.%").alias("is_home"),
        text.suffix_token("MATCHUP", 3).alias("opponent_abbreviation"),
        F.col("WL").cast("string").alias("win_loss"),
        text.outcome_flag("WL").alias("win_flag"),
    ]
    return typed_select(rows, [*TEAM_GAME_KEYS, *derived, *TEAM_GAME_COUNTS])


def stg_boxscore_player_traditional(rows: DataFrame) -> DataFrame:
    """One row per game and player, dealt by game: the variants and the game then meet where the rows are."""
    typed = typed_select(rows, [*BOX_KEYS, text.duration_seconds("minutes").alias("seconds_played"), *BOX_COUNTS])
    return staging.dedupe_latest(dealt_once(typed, "game_id"), ["game_id", "player_id"], [F.col("points").desc_nulls_last()])


def stg_boxscore_player_advanced(rows: DataFrame) -> DataFrame:
    typed = typed_select(rows, ADVANCED_FIELDS)
    return staging.dedupe_latest(dealt_once(typed, "game_id"), ["game_id", "player_id"], [F.col("pie").desc_nulls_last()])


def stg_play_by_play(rows: DataFrame) -> DataFrame:
    """Events with a sequence where a game reuses an action number."""
    flag = text.parse_flag("isFieldGoal").alias("is_field_goal")
    typed = typed_select(rows, [*EVENT_FIELDS, flag, *EVENT_SHOT_FIELDS])
    return staging.event_sequence(
        typed, ["game_id", "action_number"], ["description", "shot_result", "team_id", "player_id"]
    )


def stg_player_career_season(rows: DataFrame) -> DataFrame:
    """One row per player, season and team, without the seasons' totals over all teams."""
    typed = staging.drop_rollups(typed_select(rows, CAREER_FIELDS), "team_abbreviation", "TOT", "team_id")
    return staging.dedupe_latest(typed, ["player_id", "season", "team_id"], [F.col("gp").desc_nulls_last()])


def _season_of_year() -> Column:
    return text.period_label("SEASON").alias("season")


def stg_team_roster(rows: DataFrame) -> DataFrame:
    places = [f.name for f in ROSTER_FIELDS].index("school")
    team = [F.col("TeamID").cast("bigint").alias("team_id"), _season_of_year()]
    experience = text.coded_int("EXP", {"R": 0}).alias("experience_years")
    typed = typed_select(rows, [*team, *ROSTER_FIELDS[:places], experience, *ROSTER_FIELDS[places:]])
    return staging.dedupe_latest(typed, ["team_id", "season", "player_id"], [F.col("player_name").asc_nulls_last()])


def stg_team_coach(rows: DataFrame) -> DataFrame:
    flags = [
        text.equals_flag("COACH_TYPE", "Head Coach").alias("is_head_coach"),
        text.equals_flag("COACH_TYPE", "Assistant Coach").alias("is_assistant_coach"),
    ]
    places = [f.name for f in COACH_FIELDS].index("sort_sequence")
    fields = [COACH_FIELDS[0], _season_of_year(), *COACH_FIELDS[1:places], *flags, *COACH_FIELDS[places:]]
    order = [F.col("sort_sequence").asc_nulls_last(), F.col("sub_sort_sequence").asc_nulls_last()]
    return staging.dedupe_latest(typed_select(rows, fields), ["team_id", "season", "coach_id"], order)


# --- dimensions --------------------------------------------------------------


def snap_team(previous: DataFrame | None, teams: DataFrame, ts: Column) -> DataFrame:
    return history.scd2_apply(previous, teams, "team_id", TEAM_CHECKS, ts)


def snap_player(previous: DataFrame | None, players: DataFrame, ts: Column) -> DataFrame:
    return history.scd2_apply(previous, players, "player_id", PLAYER_CHECKS, ts)


def dim_team(versions: DataFrame) -> DataFrame:
    return history.scd2_dim(versions, "team_id", "team_sk")


def dim_player(versions: DataFrame) -> DataFrame:
    return history.scd2_dim(versions, "player_id", "player_sk")


def int_games_deduped(team_games: DataFrame, *, unique_sides: bool = False) -> DataFrame:
    games = star.pair_collapse(
        team_games.withColumn("abbreviation", F.col("team_abbreviation")),
        "game_id",
        "is_home",
        ["game_date", "season_id"],
        ["team_id", "abbreviation", "points", "win_flag"],
        unique_sides=unique_sides,
    )
    return games.withColumnRenamed("home_win_flag", "home_win").drop("away_win_flag")


def _season(rows: DataFrame, seasons: DataFrame) -> DataFrame:
    """The season's key. The planner cannot see that there are few season ids, and would deal the rows by them."""
    return star.lookup(rows, F.broadcast(seasons), [("season_id", "season_id")], [("season_key", "season_key")])


def dim_game(games: DataFrame, teams: DataFrame, seasons: DataFrame) -> DataFrame:
    keyed = games.withColumns(
        {
            "game_sk": surrogate_key("game_id"),
            "date_key": date_key("game_date"),
            "total_points": F.col("home_points") + F.col("away_points"),
        }
    )
    home = star.current_lookup(keyed, teams, "home_team_id", "team_sk", dim_key="team_id", out="home_team_sk")
    both = star.current_lookup(home, teams, "away_team_id", "team_sk", dim_key="team_id", out="away_team_sk")
    return _season(both, seasons).select(
        "game_sk", "game_id", "game_date", "date_key", "season_key", "home_team_id", "away_team_id", "home_team_sk",
        "away_team_sk", "home_abbreviation", "away_abbreviation", "home_points", "away_points", "home_win", "total_points",
    )


# --- facts -------------------------------------------------------------------


def _opponent() -> Column:
    return star.opponent_id(F.col("team_id"), F.col("home_team_id"), F.col("away_team_id"))


def fact_team_game(team_games: DataFrame, games: DataFrame, teams: DataFrame, seasons: DataFrame) -> DataFrame:
    ids = [("home_team_id", "home_team_id"), ("away_team_id", "away_team_id")]
    rows = star.lookup(team_games, games, [("game_id", "game_id")], ids, how="inner")
    rows = rows.withColumns(
        {
            "opponent_team_id": _opponent(),
            "team_game_sk": surrogate_key("game_id", "team_id"),
            "game_sk": surrogate_key("game_id"),
            "date_key": date_key("game_date"),
        }
    )
    rows = star.current_lookup(rows, teams, "team_id", "team_sk")
    rows = star.current_lookup(rows, teams, "opponent_team_id", "team_sk", dim_key="team_id", out="opponent_team_sk")
    rows = _season(rows, seasons)
    return rows.select(*EFFICIENCY_KEYS[:-1], "win_loss", "win_flag", *_names(TEAM_GAME_COUNTS))


def int_player_game_unified(traditional: DataFrame, advanced: DataFrame) -> DataFrame:
    return staging.unify_variants(traditional, advanced, ["game_id", "player_id"], UNIFIED_ADVANCED, within="game_id")


def _members(rows: DataFrame, teams: DataFrame, players: DataFrame) -> DataFrame:
    """The keys of a row's player and team, and those of its game, which are made last so that no shuffle carries them.

    Players first: they are too many to broadcast, while teams mostly are not, and then need no shuffle.
    """
    rows = star.current_lookup(rows, players, "player_id", "player_sk")
    rows = star.current_lookup(rows, teams, "team_id", "team_sk")
    return rows.withColumns({"game_sk": surrogate_key("game_id"), "date_key": date_key("game_date")})


def _in_game(rows: DataFrame, games: DataFrame, take: list[str]) -> DataFrame:
    return star.lookup(rows, games, [("game_id", "game_id")], [(c, c) for c in take], how="inner")


def fact_player_game(box: DataFrame, games: DataFrame, teams: DataFrame, players: DataFrame) -> DataFrame:
    rows = _in_game(box, games, ["game_date", "season_key", "home_team_id", "away_team_id"])
    rows = rows.withColumn("opponent_team_id", _opponent()).drop("home_team_id", "away_team_id")
    rows = _members(rows, teams, players).withColumns(
        {"player_game_sk": surrogate_key("game_id", "player_id"), "did_play": text.null_or_empty("comment")}
    )
    return rows.select(
        "player_game_sk", "game_sk", "game_id", "player_id", "team_id", "opponent_team_id", "player_sk", "team_sk",
        "date_key", "season_key", "game_date", "player_name", "position", "comment", "did_play", "seconds_played",
        *_names(BOX_COUNTS), *UNIFIED_ADVANCED,
    )


def fact_play_by_play(events: DataFrame, games: DataFrame, teams: DataFrame, players: DataFrame) -> DataFrame:
    rows = _members(_in_game(events, games, ["game_date", "season_key"]), teams, players)
    return rows.select(
        surrogate_key("game_id", "action_number", "action_seq").alias("event_sk"),
        "game_sk", "game_id", "action_number", "action_seq", "period", "clock", "team_id", "team_sk", "player_id",
        "player_sk", "date_key", "season_key", "action_type", "sub_type", "description", "score_home", "score_away",
        "is_field_goal", "shot_result",
    )


def classify_shots(events: DataFrame) -> DataFrame:
    """Zone, value and points of field-goal attempts; inclusive distance bands, text before distance."""
    three = F.lower("description").like("%3pt%")
    distance, made = F.col("shot_distance"), F.col("shot_result") == "Made"
    # Zone names and the distances they end at.
    zone = text.first_match(
        [
            (F.col("is_three"), "Three Point"),
            (distance.isNull(), "Unknown"),
            (distance <= 4, "Restricted Area"),
            (distance <= 14, "Paint (Non-RA)"),
        ],
        "Mid-Range",
    )
    value = F.when(F.col("is_three"), 3).otherwise(2)
    return (
        events.where("is_field_goal")
        .withColumn("is_three", three)
        .withColumns(
            {"shot_zone": zone, "is_made": made, "shot_value": value, "points": F.when(made, value).otherwise(0)}
        )
    )


def fact_shot(events: DataFrame, games: DataFrame, teams: DataFrame, players: DataFrame, zones: DataFrame) -> DataFrame:
    rows = _members(_in_game(classify_shots(events), games, ["game_date", "season_key"]), teams, players)
    rows = star.lookup(rows, zones, [("shot_zone", "shot_zone")], [("shot_zone_key", "shot_zone_key")])
    return rows.select(
        surrogate_key("game_id", "action_number", "action_seq").alias("shot_sk"),
        "game_sk", "game_id", "player_id", "player_sk", "team_id", "team_sk", "shot_zone_key", "date_key", "season_key",
        "game_date", "period", "shot_zone", "is_three", "is_made", "shot_value", "points", "shot_distance", "x_legacy",
        "y_legacy", "description",
    )


def fact_player_season(career: DataFrame, players: DataFrame, teams: DataFrame, seasons: DataFrame) -> DataFrame:
    regular = seasons.where("season_type = 'Regular Season'")
    members = [("player_sk", "player_sk"), ("player_name", "player_name")]
    rows = star.lookup(career, players.where("is_current"), [("player_id", "player_id")], members)
    rows = star.current_lookup(rows, teams, "team_id", "team_sk")
    rows = star.lookup(rows, regular, [("season", "season")], [("season_key", "season_key")])
    counts = _names(CAREER_FIELDS)[4:]
    return rows.select(
        surrogate_key("player_id", "season", "team_id").alias("player_season_sk"),
        "player_id", "player_sk", "player_name", "season", "season_key", "team_id", "team_sk", "team_abbreviation", *counts,
    )


# --- marts -------------------------------------------------------------------


def int_team_game__advanced(team_game: DataFrame) -> DataFrame:
    """Both sides' possessions and factors, the opponent's included."""
    paired = star.opponent_columns(team_game, "game_id", "is_home", efficiency.OPPONENT_INPUTS)
    return efficiency.four_factors(paired, EFFICIENCY_KEYS)


def mart_team_four_factors(advanced: DataFrame) -> DataFrame:
    return advanced.drop("opp_poss")


def mart_player_team_tenure(player_season: DataFrame) -> DataFrame:
    return marts.tenure_rollup(
        player_season, "player_id", "team_id", "season", name="player_name", label="team_abbreviation",
        tie="team_abbreviation", measures={"gp": "games_played", "points": "total_points"},
    )


def top_scorers(player_season: DataFrame, season: str, n: int = 10) -> DataFrame:
    """The players with most points in a season, over all their teams."""
    totals = player_season.where(F.col("season") == season).groupBy("player_id").agg(
        F.max("player_name").alias("player_name"), F.sum("points").alias("points"), F.sum("gp").alias("games")
    )
    return staging.top_n(totals, "points", "player_id", n)


# --- the whole warehouse -------------------------------------------------------

# The columns tables are clustered by when written.
CLUSTER_BY = {
    "fact_team_game": ["game_date", "team_id"],
    "fact_player_game": ["game_date", "team_id"],
    "fact_play_by_play": ["game_id"],
    "fact_shot": ["game_id"],
    "fact_player_season": ["season", "team_id"],
}


class Warehouse:
    """All tables of one run at time ``ts``, each planned when first asked for.

    ``snapshots`` are the snap_team / snap_player tables the previous run left.
    Setting an attribute to a stored copy makes the tables after it read that.
    """

    def __init__(
        self,
        spark: SparkSession,
        bronze: Mapping[str, DataFrame],
        ts: Column,
        snapshots: Mapping[str, DataFrame] | None = None,
    ) -> None:
        self.spark, self.bronze, self.ts, self.before = spark, bronze, ts, snapshots or {}

    @cached_property
    def stg_teams(self) -> DataFrame:
        return stg_teams(self.bronze[TEAMS])

    @cached_property
    def stg_players(self) -> DataFrame:
        return stg_players(self.bronze[PLAYERS])

    @cached_property
    def stg_team_game(self) -> DataFrame:
        return stg_team_game(self.bronze[TEAM_GAMES])

    @cached_property
    def stg_boxscore_player_traditional(self) -> DataFrame:
        return stg_boxscore_player_traditional(self.bronze[BOX_SCORE])

    @cached_property
    def stg_boxscore_player_advanced(self) -> DataFrame:
        return stg_boxscore_player_advanced(self.bronze[BOX_SCORE_ADVANCED])

    @cached_property
    def stg_play_by_play(self) -> DataFrame:
        return stg_play_by_play(self.bronze[PLAY_BY_PLAY])

    @cached_property
    def stg_player_career_season(self) -> DataFrame:
        return stg_player_career_season(self.bronze[CAREER])

    @cached_property
    def stg_team_roster(self) -> DataFrame:
        return stg_team_roster(self.bronze[ROSTER])

    @cached_property
    def stg_team_coach(self) -> DataFrame:
        return stg_team_coach(self.bronze[COACHES])

    @cached_property
    def snap_team(self) -> DataFrame:
        return snap_team(self.before.get("snap_team"), self.stg_teams, self.ts)

    @cached_property
    def snap_player(self) -> DataFrame:
        return snap_player(self.before.get("snap_player"), self.stg_players, self.ts)

    @cached_property
    def dim_team(self) -> DataFrame:
        return dim_team(self.snap_team)

    @cached_property
    def dim_player(self) -> DataFrame:
        return dim_player(self.snap_player)

    @cached_property
    def dim_date(self) -> DataFrame:
        return generated.date_dim(generated.date_spine(self.spark))

    @cached_property
    def dim_season(self) -> DataFrame:
        return star.season_dim(self.stg_team_game, "season_id")

    @cached_property
    def dim_shot_zone(self) -> DataFrame:
        return generated.zone_dim(generated.zone_rows(self.spark))

    @cached_property
    def int_games__deduped(self) -> DataFrame:
        return int_games_deduped(self.stg_team_game)

    @cached_property
    def dim_game(self) -> DataFrame:
        return dim_game(self.int_games__deduped, self.dim_team, self.dim_season)

    @cached_property
    def int_player_game__unified(self) -> DataFrame:
        return int_player_game_unified(self.stg_boxscore_player_traditional, self.stg_boxscore_player_advanced)

    @cached_property
    def fact_team_game(self) -> DataFrame:
        return fact_team_game(self.stg_team_game, self.int_games__deduped, self.dim_team, self.dim_season)

    @cached_property
    def fact_player_game(self) -> DataFrame:
        return fact_player_game(self.int_player_game__unified, self.dim_game, self.dim_team, self.dim_player)

    @cached_property
    def fact_play_by_play(self) -> DataFrame:
        return fact_play_by_play(self.stg_play_by_play, self.dim_game, self.dim_team, self.dim_player)

    @cached_property
    def fact_shot(self) -> DataFrame:
        return fact_shot(self.stg_play_by_play, self.dim_game, self.dim_team, self.dim_player, self.dim_shot_zone)

    @cached_property
    def fact_player_season(self) -> DataFrame:
        return fact_player_season(self.stg_player_career_season, self.dim_player, self.dim_team, self.dim_season)

    @cached_property
    def int_team_game__advanced(self) -> DataFrame:
        return int_team_game__advanced(self.fact_team_game)

    @cached_property
    def mart_team_four_factors(self) -> DataFrame:
        return mart_team_four_factors(self.int_team_game__advanced)

    @cached_property
    def mart_player_team_tenure(self) -> DataFrame:
        return mart_player_team_tenure(self.fact_player_season)


# The stored tables in the order they are built.
STORED = (
    "stg_teams", "stg_players", "stg_team_roster", "stg_team_coach", "stg_team_game", "stg_play_by_play", "snap_team",
    "snap_player", "dim_season", "dim_date", "dim_shot_zone", "dim_team", "dim_player", "dim_game", "fact_team_game",
    "fact_player_game", "fact_play_by_play", "fact_shot", "fact_player_season",
)
MARTS = ("int_team_game__advanced", "mart_team_four_factors", "mart_player_team_tenure")


def write_tables(warehouse: Warehouse, root: str) -> Warehouse:
    """Write every table below ``root``, later ones from the stored earlier ones.

    The data tests run before the marts are built, so a failure stops them. A
    run writes to its own root: the snapshots it reads are never overwritten.
    """

    def store(name: str) -> None:
        df, path = getattr(warehouse, name), f"{root}/{name}"
        if name in CLUSTER_BY:
            raw.write_clustered(df, path, CLUSTER_BY[name])
        else:
            df.write.mode("overwrite").parquet(path)
        setattr(warehouse, name, raw.read_table(warehouse.spark, path, df.schema))

    for name in STORED:
        store(name)
    tables = {name: getattr(warehouse, name) for name in STORED}
    quality.run_suite(checks(tables))
    for name in MARTS:
        store(name)
    quality.run_suite(mart_checks(tables | {name: getattr(warehouse, name) for name in MARTS}))
    return warehouse


# --- data tests ----------------------------------------------------------------

# Which columns are tested how.
UNIQUE_NOT_NULL = {
    "dim_date": "date_key",
    "dim_season": "season_key",
    "dim_team": "team_sk",
    "dim_player": "player_sk",
    "dim_game": "game_sk",
    "dim_shot_zone": "shot_zone_key",
    "fact_team_game": "team_game_sk",
    "fact_player_game": "player_game_sk",
    "fact_play_by_play": "event_sk",
    "fact_shot": "shot_sk",
    "fact_player_season": "player_season_sk",
    "stg_teams": "team_id",
    "stg_players": "player_id",
}
NOT_NULL = {
    "dim_team": ["team_id"],
    "dim_player": ["player_id"],
    "fact_team_game": ["team_sk"],
    "fact_shot": ["shot_zone_key"],
    "stg_team_game": ["game_id", "team_id"],
    "stg_team_roster": ["team_id", "player_id"],
    "stg_team_coach": ["team_id", "coach_id"],
}
COMBINATIONS = {
    "stg_team_game": ["game_id", "team_id"],
    "stg_team_roster": ["team_id", "season", "player_id"],
    "stg_team_coach": ["team_id", "season", "coach_id"],
    "fact_team_game": ["game_id", "team_id"],
    "fact_player_game": ["game_id", "player_id"],
    "fact_play_by_play": ["game_id", "action_number", "action_seq"],
    "fact_player_season": ["player_id", "season", "team_id"],
}
PARENTS = {
    "dim_game": [
        ("date_key", "dim_date", "date_key"),
        ("season_key", "dim_season", "season_key"),
        ("home_team_sk", "dim_team", "team_sk"),
        ("away_team_sk", "dim_team", "team_sk"),
    ],
    "fact_team_game": [
        ("game_sk", "dim_game", "game_sk"),
        ("team_sk", "dim_team", "team_sk"),
        ("date_key", "dim_date", "date_key"),
        ("season_key", "dim_season", "season_key"),
    ],
    "fact_player_game": [
        ("game_sk", "dim_game", "game_sk"),
        ("team_sk", "dim_team", "team_sk"),
        ("player_sk", "dim_player", "player_sk"),
        ("date_key", "dim_date", "date_key"),
        ("season_key", "dim_season", "season_key"),
    ],
    "fact_play_by_play": [("game_sk", "dim_game", "game_sk")],
    "fact_shot": [("game_sk", "dim_game", "game_sk"), ("shot_zone_key", "dim_shot_zone", "shot_zone_key")],
    "fact_player_season": [
        ("player_sk", "dim_player", "player_sk"),
        ("team_sk", "dim_team", "team_sk"),
        ("season_key", "dim_season", "season_key"),
    ],
}


def checks(t: Mapping[str, DataFrame]) -> list[quality.Check]:
    """The data tests of the tables that are present."""
    out = []
    for name, column in UNIQUE_NOT_NULL.items():
        if name in t:
            out.append(quality.Check(f"{name}.{column} unique", quality.unique(t[name], column)))
            out.append(quality.RowCheck(f"{name}.{column} not null", t[name], F.col(column).isNull()))
    for name, columns in NOT_NULL.items():
        out += [quality.RowCheck(f"{name}.{c} not null", t[name], F.col(c).isNull()) for c in columns if name in t]
    for name, columns in COMBINATIONS.items():
        if name in t:
            out.append(quality.Check(f"{name} one row per {'+'.join(columns)}", quality.unique_combination(t[name], columns)))
    for name, links in PARENTS.items():
        for column, parent, parent_column in links:
            if name in t and parent in t:
                orphans = quality.relationship(t[name], column, t[parent], parent_column)
                out.append(quality.Check(f"{name}.{column} in {parent}", orphans))
    if "dim_season" in t:
        types = [*star.SEASON_TYPES.values(), "Unknown"]
        out.append(quality.Check("dim_season.season_type known", quality.accepted_values(t["dim_season"], "season_type", types)))
    if "dim_shot_zone" in t:
        out.append(quality.Check("dim_shot_zone.shot_zone unique", quality.unique(t["dim_shot_zone"], "shot_zone")))
        out.append(quality.RowCheck("dim_shot_zone.shot_zone not null", t["dim_shot_zone"], F.col("shot_zone").isNull()))
    if "fact_team_game" in t:
        out.append(quality.Check("two sides per game", quality.rows_per_key(t["fact_team_game"], "game_id", 2)))
    if "fact_player_game" in t and "fact_team_game" in t:
        out.append(quality.Check("player points match team points", points_mismatch(t["fact_player_game"], t["fact_team_game"])))
    if "fact_player_game" in t and "fact_shot" in t:
        out.append(quality.Check("made shots match box score", shots_mismatch(t["fact_shot"], t["fact_player_game"])))
    return out


def points_mismatch(player_game: DataFrame, team_game: DataFrame) -> DataFrame:
    return quality.reconcile_sum(
        player_game, team_game, ["game_id", "team_id"], "points", "points", as_name="player_points", total_name="team_points"
    )


def shots_mismatch(shots: DataFrame, player_game: DataFrame) -> DataFrame:
    return quality.reconcile_count(
        shots, player_game, ["game_id", "team_id"], "is_made", "fgm", as_name="made_fg", total_name="box_fgm"
    )


def mart_checks(t: Mapping[str, DataFrame]) -> list[quality.Check]:
    """The data tests of the marts."""
    factors, tenure = t["mart_team_four_factors"], t["mart_player_team_tenure"]
    out = [
        quality.Check("mart_team_four_factors.team_game_sk unique", quality.unique(factors, "team_game_sk")),
        quality.RowCheck("mart_team_four_factors.team_game_sk not null", factors, F.col("team_game_sk").isNull()),
        quality.Check("mart_team_four_factors.game_sk in dim_game", quality.relationship(factors, "game_sk", t["dim_game"], "game_sk")),
        quality.RowCheck("mart_team_four_factors.efg_pct range", factors, quality.outside("efg_pct", 0, 1.5)),
        quality.RowCheck("mart_player_team_tenure.seasons not null", tenure, F.col("seasons").isNull()),
        quality.Check("mart_player_team_tenure one row per player+team", quality.unique_combination(tenure, ["player_id", "team_id"])),
    ]
    return out
