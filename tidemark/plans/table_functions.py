"""Questions to the warehouse as table functions of SQL, planned lazily like any other query.

Each function reads views of the warehouse's tables. Its arguments may be literals or, in a LATERAL join,
columns of another table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

#: The functions' signatures and bodies by name; views are named like their tables.
FUNCTIONS = {
    "top_scorers": (
        "(season STRING, n INT) RETURNS TABLE (player_id BIGINT, player_name STRING, points BIGINT, games BIGINT, place INT)",
        """SELECT player_id, player_name, points, games, place FROM (
             SELECT *, row_number() OVER (ORDER BY points DESC, player_id) AS place FROM (
               SELECT player_id, max(player_name) AS player_name, sum(points) AS points, sum(gp) AS games
               FROM fact_player_season f WHERE f.season = top_scorers.season GROUP BY player_id))
           WHERE place <= top_scorers.n""",
    ),
    "player_shot_profile": (
        "(player_id BIGINT, season_key STRING) RETURNS TABLE (shot_zone STRING, attempts BIGINT, makes BIGINT, points BIGINT, make_pct DOUBLE)",
        """SELECT shot_zone, count(*), count_if(is_made), sum(points), count_if(is_made) / count(*) FROM fact_shot f
           WHERE f.player_id = player_shot_profile.player_id AND f.season_key = player_shot_profile.season_key GROUP BY shot_zone""",
    ),
    "team_four_factors": (
        "(team_id BIGINT, season_key STRING) RETURNS TABLE (games BIGINT, efg_pct DOUBLE, tov_pct DOUBLE, oreb_pct DOUBLE, ft_rate DOUBLE, net_rating DOUBLE)",
        """SELECT count(*), avg(efg_pct), avg(tov_pct), avg(oreb_pct), avg(ft_rate), avg(net_rating) FROM mart_team_four_factors f
           WHERE f.team_id = team_four_factors.team_id AND f.season_key = team_four_factors.season_key""",
    ),
}


def register(spark: SparkSession, tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Create the session's temporary functions over the given tables, whose views get ``prefix`` and their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
    for name, (signature, body) in FUNCTIONS.items():
        for table in tables:
            body = body.replace(f"FROM {table} f", f"FROM {prefix}{table} f")
        if any(f"FROM {prefix}{table} f" in body for table in tables):
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{signature} RETURN {body}")
