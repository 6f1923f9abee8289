"""Games seen from each team: one row per (team, game) instead of an OR join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def team_games(schedules: DataFrame) -> DataFrame:
    """Explode home and away side, so that ``home = t OR away = t`` becomes an equi-join.

    A game a team plays against itself stays one row, as under OR.
    """
    return schedules.select(
        F.explode(F.array_distinct(F.array("home_team", "away_team"))).alias("team"), "*"
    ).where(F.col("team").isNotNull())
