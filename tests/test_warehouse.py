"""A small league through the whole warehouse: tables, data tests, history over two runs."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import staging
from tidemark.operators.quality import SuiteFailed
from tidemark.plans import warehouse as wh
from tidemark.session import new_path

RUN1, RUN2 = "2024-03-01 05:00:00", "2024-03-02 05:00:00"


def frame(spark, fields, rows, **fixed):
    """Raw text rows: a dict per row, missing columns NULL."""
    names = [f.source for f in fields if not isinstance(f, str)] + [f for f in fields if isinstance(f, str)]
    names = list(dict.fromkeys(names))
    schema = ", ".join(f"`{n}` string" for n in names)
    data = [tuple({**fixed, **r}.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, schema)


def side(game, day, team, tag, link, other, wl, pts, season="22023", **more):
    return {
        "GAME_ID": game, "TEAM_ID": team, "TEAM_ABBREVIATION": tag, "SEASON_ID": season, "GAME_DATE": day,
        "MATCHUP": f"{tag} {link} {other}", "WL": wl, "MIN": "240", "PTS": str(pts), "FGM": "40", "FGA": "90",
        "FG3M": "10", "FTM": "15", "FTA": "20", "OREB": "10", "DREB": "30", "TOV": "14", **more,
    }


def shot(game, no, team, person, made, text="Shot", distance="3", **more):
    return {
        "gameId": game, "actionNumber": no, "period": "1", "clock": "PT11M", "teamId": team, "personId": person,
        "actionType": "2pt", "description": text, "isFieldGoal": "1", "shotResult": made, "shotDistance": distance, **more,
    }


def box(game, team, person, minutes, points, fgm, comment="", **more):
    return {
        "gameId": game, "teamId": team, "personId": person, "nameI": f"P{person}", "minutes": minutes, "points": points,
        "fieldGoalsMade": fgm, "comment": comment, **more,
    }


@pytest.fixture(scope="module")
def bronze(spark):
    teams = [
        {"ID": "1", "FULL_NAME": "Ants", "ABBREVIATION": "ANT", "NICKNAME": "A", "CITY": "X", "YEAR_FOUNDED": "1950"},
        {"ID": "2", "FULL_NAME": "Bees", "ABBREVIATION": "BEE", "NICKNAME": "B", "CITY": "Y", "YEAR_FOUNDED": "1960"},
    ]
    players = [
        {"PERSON_ID": "11", "DISPLAY_FIRST_LAST": "Al", "ROSTERSTATUS": "1", "TEAM_ID": "1", "TO_YEAR": "2022", "FROM_YEAR": "2015"},
        {"PERSON_ID": "11", "DISPLAY_FIRST_LAST": "Al", "ROSTERSTATUS": "1", "TEAM_ID": "2", "TO_YEAR": "2023", "FROM_YEAR": "2015"},
        {"PERSON_ID": "12", "DISPLAY_FIRST_LAST": "Bo", "ROSTERSTATUS": "1", "TEAM_ID": "0", "TO_YEAR": "2023", "FROM_YEAR": "2016"},
    ]
    games = [
        side("0022300001", "2023-11-01", "1", "ANT", "vs.", "BEE", "W", 6),
        side("0022300001", "2023-11-01", "2", "BEE", "@", "ANT", "L", 5),
        side("0022300002", "2023-11-05", "2", "BEE", "vs.", "ANT", "W", 100),
        side("0022300002", "2023-11-05", "1", "ANT", "@", "BEE", "L", 90, FGA="0", TOV=""),
    ]
    boxes = [
        box("0022300001", "1", "11", "PT34M21.00S", "6", "2"),
        box("0022300001", "1", "11", "PT30M00.00S", "4", "2"),
        box("0022300001", "2", "12", "12:30", "5", "2"),
        box("0022300001", "2", "13", "", "", "", "DNP - rest"),
    ]
    events = [
        shot("0022300001", "7", "1", "11", "Made", "Al 27' 3PT Jump", "27"),
        shot("0022300001", "7", "1", "11", "Made", "Al 27' 3PT Jump", "27"),
        shot("0022300001", "7", "1", "11", "Made", "Al layup 3PT", "1"),
        shot("0022300001", "8", "2", "12", "Made", "Bo dunk", "4"),
        shot("0022300001", "9", "2", "12", "Made", None, "14"),
        shot("0022300001", "10", "2", "12", "Missed", "Bo jumper", "14.5"),
        shot("0022300001", "11", "0", "0", None, "x", None),
        shot("0022300001", "12", "1", "11", None, "Foul", None, isFieldGoal="0"),
        shot("0099999999", "1", "1", "11", "Made"),
    ]
    career = [
        {"PLAYER_ID": "11", "SEASON_ID": "2021-22", "TEAM_ID": "1", "TEAM_ABBREVIATION": "OLD", "GP": "50", "PTS": "500"},
        {"PLAYER_ID": "11", "SEASON_ID": "2023-24", "TEAM_ID": "1", "TEAM_ABBREVIATION": "ANT", "GP": "9", "PTS": "90"},
        {"PLAYER_ID": "11", "SEASON_ID": "2023-24", "TEAM_ID": "1", "TEAM_ABBREVIATION": "ANT", "GP": "31", "PTS": "100"},
        {"PLAYER_ID": "11", "SEASON_ID": "2023-24", "TEAM_ID": "0", "TEAM_ABBREVIATION": "TOT", "GP": "40", "PTS": "190"},
        {"PLAYER_ID": "12", "SEASON_ID": "2023-24", "TEAM_ID": "2", "TEAM_ABBREVIATION": "BEE", "GP": "23.0", "PTS": None},
    ]
    return {
        wh.TEAMS: frame(spark, wh.TEAM_FIELDS, teams),
        wh.PLAYERS: frame(spark, wh.PLAYER_FIELDS, players),
        wh.TEAM_GAMES: frame(spark, [*wh.TEAM_GAME_KEYS, "WL", *wh.TEAM_GAME_COUNTS], games),
        wh.BOX_SCORE: frame(spark, [*wh.BOX_KEYS, "minutes", *wh.BOX_COUNTS], boxes),
        wh.BOX_SCORE_ADVANCED: frame(spark, wh.ADVANCED_FIELDS, [{"gameId": "0022300001", "personId": "11", "PIE": "0.1"}]),
        wh.PLAY_BY_PLAY: frame(spark, [*wh.EVENT_FIELDS, "isFieldGoal", *wh.EVENT_SHOT_FIELDS], events),
        wh.CAREER: frame(spark, wh.CAREER_FIELDS, career),
        wh.ROSTER: frame(
            spark, [*wh.ROSTER_FIELDS, "TeamID", "SEASON", "EXP"],
            [{"TeamID": "1", "SEASON": "1999", "PLAYER_ID": "11", "EXP": "R"}, {"TeamID": "1", "SEASON": "1999", "PLAYER_ID": "12", "EXP": "4"}],
        ),
        wh.COACHES: frame(
            spark, [*wh.COACH_FIELDS, "SEASON"], [{"TEAM_ID": "1", "SEASON": "2023", "COACH_ID": "5", "COACH_TYPE": "Head Coach"}]
        ),
    }


@pytest.fixture(scope="module")
def first_run(spark, bronze):
    w = wh.Warehouse(spark, bronze, F.lit(RUN1).cast("timestamp"))
    return wh.write_tables(w, new_path(spark, "warehouse"))


def test_team_games(first_run):
    rows = {(r.game_id, r.team_id): r for r in first_run.fact_team_game.collect()}
    assert len(rows) == 4
    r = rows["0022300001", 1]
    assert (r.opponent_team_id, r.is_home, r.win_flag, r.date_key, r.points) == (2, True, 1, 20231101, 6)
    assert r.team_sk != r.opponent_team_sk and None not in (r.team_sk, r.opponent_team_sk, r.season_key)


def test_games(first_run):
    g = {r.game_id: r for r in first_run.dim_game.collect()}["0022300002"]
    assert (g.home_team_id, g.away_team_id, g.home_points, g.away_points, g.home_win, g.total_points) == (2, 1, 100, 90, 1, 190)


def test_players_of_a_game(first_run):
    rows = {r.player_id: r for r in first_run.fact_player_game.collect()}
    assert len(rows) == 3
    assert (rows[11].points, rows[11].seconds_played, rows[11].pie, rows[11].opponent_team_id) == (6, 2061, 0.1, 2)
    assert (rows[12].seconds_played, rows[12].did_play, rows[12].pie) == (750, True, None)
    assert (rows[13].did_play, rows[13].points, rows[13].player_sk) == (False, None, None)


def test_box_scores_are_dealt_once_by_game(spark, bronze):
    w = wh.Warehouse(spark, bronze, F.lit(RUN1).cast("timestamp"))
    plan = w.fact_player_game._jdf.queryExecution().executedPlan().toString()
    dealt = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    # both box scores and both sides of the games by game; nothing by game and player, nor games by their season
    assert sum(d.startswith("game_id#") for d in dealt) == 4
    assert not any(d.count("#") > 1 and d.startswith("game_id#") for d in dealt)
    assert sum(d.startswith("season_id#") for d in dealt) == 1  # the distinct seasons


def test_variants_within_a_group_equal_their_join(spark):
    base = spark.createDataFrame([("g", 1, 10), ("g", 2, 20), ("g", 2, 21), ("h", 1, 30), (None, 1, 40), ("g", None, 50), ("i", 7, 60)], "game string, player int, v int")
    extra = spark.createDataFrame([("g", 1, 0.1), ("g", 2, 0.2), ("g", 2, None), (None, 1, 0.4), ("g", None, 0.5), ("h", 2, 0.6)], "game string, player int, pie double")
    joined = staging.unify_variants(base, extra, ["game", "player"], ["pie"])
    within = staging.unify_variants(base, extra, ["game", "player"], ["pie"], within="game")
    assert within.columns == joined.columns and within.count() == 9
    assert sorted(map(str, within.collect())) == sorted(map(str, joined.collect()))


def test_events_and_shots(first_run):
    events = first_run.fact_play_by_play.collect()
    # the repeated row is gone, the reused number is sequenced, the unknown game's event has no game
    assert len(events) == 7
    assert sorted(r.action_seq for r in events if r.action_number == 7) == [1, 2]
    shots = {(r.description, r.shot_distance): r for r in first_run.fact_shot.collect()}
    got = {k: (r.shot_zone, r.is_three, r.is_made, r.shot_value, r.points) for k, r in shots.items()}
    assert got == {
        ("Al 27' 3PT Jump", 27.0): ("Three Point", True, True, 3, 3),
        ("Al layup 3PT", 1.0): ("Three Point", True, True, 3, 3),
        ("Bo dunk", 4.0): ("Restricted Area", False, True, 2, 2),
        (None, 14.0): ("Paint (Non-RA)", None, True, 2, 2),
        ("Bo jumper", 14.5): ("Mid-Range", False, False, 2, 0),
        ("x", None): ("Unknown", False, None, 2, 0),
    }
    unknown = shots["x", None]
    assert (unknown.team_sk, unknown.player_sk) == (None, None) and unknown.shot_zone_key


def test_seasons_and_tenure(first_run):
    rows = {(r.player_id, r.season): r for r in first_run.fact_player_season.collect()}
    assert len(rows) == 3
    assert rows[11, "2023-24"].gp == 31 and rows[11, "2023-24"].season_key and rows[11, "2021-22"].season_key is None
    assert rows[12, "2023-24"].gp is None
    tenure = {r.player_id: r for r in first_run.mart_player_team_tenure.collect()}
    t = tenure[11]
    assert (t.player_name, t.team_abbreviation, t.seasons, t.first_season, t.last_season) == ("Al", "ANT", 2, "2021-22", "2023-24")
    assert (t.games_played, t.total_points, tenure[12].total_points) == (81, 600, None)


def test_four_factors(first_run):
    rows = {(r.game_id, r.team_id): r for r in first_run.mart_team_four_factors.collect()}
    r = rows["0022300001", 1]
    poss = 90 + 0.44 * 20 - 10 + 14
    assert r.poss == pytest.approx(poss) and r.pace == pytest.approx(poss)
    assert r.off_rating == pytest.approx(100 * 6 / poss) and r.net_rating == pytest.approx(100 / poss)
    assert (r.efg_pct, r.oreb_pct, r.ft_rate) == (pytest.approx(45 / 90), pytest.approx(0.25), pytest.approx(15 / 90))
    assert r.tov_pct == pytest.approx(14 / (90 + 8.8 + 14))
    zero = rows["0022300002", 1]
    assert (zero.efg_pct, zero.ft_rate, zero.poss, zero.off_rating) == (None, None, None, None)
    assert zero.opp_efg_pct == pytest.approx(0.5)


def test_second_run_keeps_history(spark, bronze, first_run):
    moved = bronze[wh.PLAYERS].withColumn("TEAM_ID", F.when(F.col("PERSON_ID") == "12", "1").otherwise(F.col("TEAM_ID")))
    before = {"snap_team": first_run.snap_team, "snap_player": first_run.snap_player}
    w = wh.Warehouse(spark, {**bronze, wh.PLAYERS: moved}, F.lit(RUN2).cast("timestamp"), before)
    second = wh.write_tables(w, new_path(spark, "warehouse"))
    rows = sorted(((r.player_id, r.team_id, r.valid_from, r.valid_to, r.is_current) for r in second.dim_player.collect()), key=repr)
    run1, run2 = (datetime.datetime.fromisoformat(t) for t in (RUN1, RUN2))
    assert rows == sorted(
        [(11, 2, run1, None, True), (12, None, run1, run2, False), (12, 1, run2, None, True)], key=repr
    )
    old = {r.team_id: r.team_sk for r in first_run.dim_team.collect()}
    assert {r.team_id: r.team_sk for r in second.dim_team.collect()} == old


def test_failing_data_test_stops_the_marts(spark, bronze):
    games = bronze[wh.TEAM_GAMES]
    doubled = {**bronze, wh.TEAM_GAMES: games.union(games.where("TEAM_ID = '1' and GAME_ID = '0022300001'"))}
    w = wh.Warehouse(spark, doubled, F.lit(RUN1).cast("timestamp"))
    root = new_path(spark, "warehouse")
    with pytest.raises(SuiteFailed, match="two sides per game"):
        wh.write_tables(w, root)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{root}/mart_team_four_factors")


def test_points_mismatch_is_found(first_run):
    off = first_run.fact_player_game.withColumn("points", F.col("points") + 1)
    got = sorted((r.team_id, r.player_points, r.team_points) for r in wh.points_mismatch(off, first_run.fact_team_game).collect())
    assert got == [(1, 7, 6), (2, 6, 5)]
    assert wh.points_mismatch(first_run.fact_player_game, first_run.fact_team_game).isEmpty()
    assert wh.shots_mismatch(first_run.fact_shot, first_run.fact_player_game).isEmpty()
