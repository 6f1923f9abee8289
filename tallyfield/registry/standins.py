"""Domain tables made out of the driver tables.

Columns are given as SQL expressions that Spark and DuckDB read alike, so that both sides of
a comparison start from the same rows.  Every table is a plain projection of one driver
table; only season totals are aggregated.

    weekly_stats, plays     lineitem   (player = supplier key, season = ship year)
    seasonal_stats          weekly_stats summed by player and season
    rosters, ranked players supplier x season
    schedules               orders
    teams, players          nation, customer
    injuries, refresh log   events
    raw ranks, roster names part
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Columns = Mapping[str, str]

FIRST_SEASON, LAST_SEASON = 1995, 2001

#: The given tables that the stand-ins are made of.
GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

#: Every given table.
ALL_GIVEN = (*GIVEN, "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _position(key: str) -> str:
    return (
        f"CASE {key} % 7 WHEN 0 THEN 'QB' WHEN 1 THEN 'RB' WHEN 2 THEN 'WR' WHEN 3 THEN 'TE' "
        "WHEN 4 THEN 'K' WHEN 5 THEN 'RB' ELSE 'LB' END"
    )


def _week(day: str) -> str:
    return f"CAST(floor((dayofyear({day}) - 1) / 17e0) AS INT) + 1"


def _tag(prefix: str, key: str) -> str:
    return f"concat('{prefix}', CAST({key} AS STRING))"


#: Stats nothing scores; any whole numbers will do.
PLAIN_STATS = (
    "sacks", "sack_yards", "sack_fumbles", "passing_air_yards", "passing_yards_after_catch",
    "passing_first_downs", "passing_epa", "rushing_first_downs", "rushing_epa",
    "receiving_air_yards", "receiving_yards_after_catch", "receiving_first_downs",
    "receiving_epa", "racr", "target_share", "air_yards_share", "wopr_x", "special_teams_tds",
)

STATS: Columns = {
    "attempts": "CAST(l_quantity AS INT)",
    "completions": "CAST(floor(l_quantity * 0.6e0) AS INT)",
    "passing_yards": "nullif(CAST(floor(l_extendedprice / 250e0) AS DOUBLE), 100e0)",
    "passing_tds": "l_linenumber % 4",
    "interceptions": "nullif(CAST(l_linenumber % 3 AS DOUBLE), 2e0)",
    "carries": "CAST(floor(l_quantity / 3e0) AS INT)",
    "rushing_yards": "CAST(l_quantity AS DOUBLE) * 3e0 - 12e0",
    "rushing_tds": "l_linenumber % 2",
    "receptions": "CAST(nullif(l_partkey % 12, 11) AS INT)",
    "targets": "CAST(l_partkey % 12 AS INT) + l_linenumber",
    "receiving_yards": "CAST(round(l_discount * 1000e0) AS DOUBLE) + CAST(l_partkey % 7 AS DOUBLE)",
    "receiving_tds": "CASE WHEN l_orderkey % 5 = 0 THEN 1 ELSE 0 END",
    "sack_fumbles_lost": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
    "rushing_fumbles_lost": "CASE WHEN l_linenumber = 7 THEN 1e0 ELSE 0e0 END",
    "receiving_fumbles_lost": "CASE WHEN l_tax > 0.075e0 THEN 1e0 END",
    "passing_2pt_conversions": "CASE WHEN l_orderkey % 17 = 0 THEN 1 ELSE 0 END",
    "rushing_2pt_conversions": "CASE WHEN l_orderkey % 19 = 0 THEN 1 ELSE 0 END",
    "receiving_2pt_conversions": "CASE WHEN l_orderkey % 23 = 0 THEN 1 ELSE 0 END",
    "fantasy_points_ppr": "CAST(l_quantity AS DOUBLE) / 4e0",
    **{
        name: f"CAST((l_partkey * {i} + l_linenumber) % {9 + i} AS DOUBLE)"
        for i, name in enumerate(PLAIN_STATS, 2)
    },
}

WEEKLY: Columns = {
    "player_id": _tag("P", "l_suppkey"),
    "player_name": _tag("Player ", "l_suppkey"),
    "position": _position("l_suppkey"),
    "recent_team": _tag("T", "l_suppkey % 25"),
    "team": _tag("T", "l_suppkey % 25"),
    "season": "CAST(year(l_shipdate) AS INT)",
    "week": _week("l_shipdate"),
    "season_type": "CASE WHEN dayofyear(l_shipdate) > 306 THEN 'POST' ELSE 'REG' END",
    "opponent_team": _tag("T", "l_partkey % 25"),
    **STATS,
}

#: Games played; some player seasons have none, some an unknown number.
GAMES = "nullif(sum(CASE WHEN l_orderkey % 40 = 0 THEN 1 ELSE 0 END), 5)"

PLAYS: Columns = {
    "play_id": "CAST(l_linenumber AS STRING)",
    "game_id": _tag("G", "l_orderkey"),
    "season": WEEKLY["season"],
    "posteam": _tag("T", "l_suppkey % 25"),
    "yardline_100": "CAST(l_quantity AS INT) * 2 - 1",
    "touchdown": "CASE l_returnflag WHEN 'R' THEN 1e0 WHEN 'A' THEN 0e0 END",
    "passer_player_name": "CASE WHEN l_linenumber = 1 THEN 'a' END",
    "rusher_player_name": "CASE WHEN l_linenumber = 2 THEN 'b' END",
    "receiver_player_name": "CASE WHEN l_linenumber > 4 THEN 'c' END",
    "fantasy_player_name": _tag("Player ", "l_suppkey"),
    "fantasy_player_id": _tag("P", "l_suppkey"),
}

SCHEDULES: Columns = {
    "game_id": _tag("G", "o_orderkey"),
    "season": "CAST(year(o_orderdate) AS INT)",
    "week": _week("o_orderdate"),
    "game_type": "CASE o_orderstatus WHEN 'P' THEN 'POST' ELSE 'REG' END",
    "season_type": "CASE o_orderstatus WHEN 'P' THEN 'POST' ELSE 'REG' END",
    "home_team": _tag("T", "o_custkey % 25"),
    "away_team": _tag("T", "(o_custkey + 1 + o_orderkey % 24) % 25"),
    "home_score": "nullif(CAST(floor(o_totalprice / 10000e0) AS INT), 13)",
    "away_score": "CAST(o_orderkey % 45 AS INT)",
}

TEAMS: Columns = {
    "team_abbr": _tag("T", "n_nationkey"),
    "team_name": "n_name",
    "team_conf": "CASE WHEN n_nationkey % 2 = 0 THEN 'East' ELSE 'West' END",
    "team_division": _tag("Division ", "n_regionkey"),
}

PLAYERS: Columns = {
    "gsis_id": _tag("P", "c_custkey"),
    "display_name": "CASE WHEN c_custkey % 9 = 0 THEN 'nan' ELSE c_name END",
    "position": "c_mktsegment",
    "draft_number": "CAST(nullif(c_custkey % 260, 5) AS STRING)",
    "weight": "CASE WHEN c_custkey % 4 = 0 THEN 'heavy' ELSE CAST(150 + c_nationkey AS STRING) END",
}

INJURIES: Columns = {
    "season": f"CAST({FIRST_SEASON} + event_id % 7 AS INT)",
    "week": "CAST(1 + dayofmonth(ts) % 22 AS INT)",
    "gsis_id": _tag("P", "user_id"),
    "full_name": _tag("Player ", "user_id"),
    "player_name": _tag("Player ", "user_id"),
    "report_status": (
        "CASE event_type WHEN 'error' THEN 'Out' WHEN 'signup' THEN 'Questionable' "
        "WHEN 'click' THEN 'Healthy' WHEN 'view' THEN 'Healthy' END"
    ),
    "injury_designation": (
        "CASE event_type WHEN 'error' THEN 'Out' WHEN 'signup' THEN 'Questionable' "
        "WHEN 'click' THEN 'Healthy' WHEN 'view' THEN 'Healthy' END"
    ),
}

REFRESH_LOG: Columns = {
    "id": "event_id",
    "table_name": "CASE user_id % 3 WHEN 0 THEN 'weekly_stats' WHEN 1 THEN 'rosters' ELSE 'pbp_data' END",
    "season": f"CAST({FIRST_SEASON} + event_id % 7 AS INT)",
    "week": "CAST(nullif(user_id % 22, 0) AS INT)",
    "season_type": "'REG'",
    "refresh_date": "ts",
    "status": (
        "CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'IN_PROGRESS' ELSE 'SUCCESS' END"
    ),
    "records_processed": "CAST(user_id * 10 AS INT)",
}

#: Players of the expert lists: a clean name per part, disturbed in six ways.
_PART_NAME = "concat(p_name, ' ', substring(p_brand, 7))"

RAW_RANKS: Columns = {
    "year": f"CAST({FIRST_SEASON} + p_partkey % 7 AS INT)",
    "before_preseason": "p_size % 2 = 0",
    "player_name": (
        f"CASE p_partkey % 6 WHEN 0 THEN upper({_PART_NAME}) "
        f"WHEN 1 THEN concat('  ', {_PART_NAME}, ' ') "
        f"WHEN 2 THEN concat(replace({_PART_NAME}, ' ', '.'), '.') "
        f"WHEN 3 THEN concat({_PART_NAME}, ' jr') "
        f"WHEN 4 THEN substring({_PART_NAME}, 3) "
        "ELSE concat('nobody ', CAST(p_partkey AS STRING)) END"
    ),
    "position": "CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE concat(' ', lower(p_type)) END",
    "rank": "CAST(p_partkey % 300 AS DOUBLE)",
    "best_rank": "CAST(p_size AS DOUBLE)",
    "worst_rank": "CAST(p_size + 20 AS DOUBLE)",
    "avg_rank": "nullif(CAST(p_size + 10 AS DOUBLE), 30e0)",
    "stddev_rank": "CAST(p_size AS DOUBLE) / 4e0",
    "adp": "nullif(CAST(p_partkey % 250 AS DOUBLE), 7e0)",
    "vs_adp": "CAST(p_partkey % 9 AS DOUBLE) - 4e0",
    "position_rank": "p_partkey % 60",
}

ROSTER_NAMES: Columns = {
    "player_id": "CASE WHEN p_partkey % 41 = 0 THEN NULL ELSE concat('P', CAST(p_partkey AS STRING)) END",
    "player_name": f"CASE WHEN p_partkey % 5 = 0 THEN concat({_PART_NAME}, ' ') ELSE {_PART_NAME} END",
    "position": "p_type",
}

ROSTERS: Columns = {
    "player_id": "CASE WHEN s_suppkey % 50 = 49 THEN NULL ELSE concat('P', CAST(s_suppkey AS STRING)) END",
    "season": "season",
    "week": "week",
    "player_name": _tag("Player ", "s_suppkey"),
    "position": f"CASE WHEN week = 1 AND s_suppkey % 3 = 0 THEN NULL ELSE {_position('s_suppkey')} END",
    "years_exp": "CAST(season - 1993 - s_suppkey % 8 AS INT)",
    "draft_number": "nullif(CAST(floor(s_acctbal) AS INT) % 260, 7)",
    "weight": "CAST(180 + s_suppkey % 100 AS INT)",
    "height": _tag("6-", "s_suppkey % 12"),
    "rookie_year": "CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE CAST(1993 + s_suppkey % 8 AS INT) END",
}

#: Expert rankings of the suppliers-as-players; "week" tells doubled entries apart.
PLAYER_RANKS: Columns = {
    "player_id": _tag("P", "s_suppkey"),
    "year": "season",
    "before_preseason": "(s_suppkey + season + week) % 2 = 0",
    # Weeks 1 and 3 lie in one phase: equal ranks with other values, and some without any rank.
    "rank": "CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE CAST((s_suppkey * 7 + season) % 300 AS DOUBLE) END",
    "best_rank": "CAST(s_suppkey % 40 AS DOUBLE)",
    "worst_rank": "CAST(s_suppkey % 40 + week AS DOUBLE)",
    "avg_rank": "CASE WHEN week = 1 THEN NULL ELSE CAST(s_suppkey % 45 AS DOUBLE) END",
    "stddev_rank": "CAST(week AS DOUBLE) / 8e0",
    "adp": "nullif(CAST(s_suppkey % 50 AS DOUBLE), 3e0)",
    "vs_adp": "CAST(week - 2 AS DOUBLE)",
    "position_rank": "(s_suppkey + week) % 30",
}
WEEKS = (1, 2, 3)

# -- Spark side -------------------------------------------------------------------------


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def project(df: DataFrame, columns: Columns) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


def _seasons_of(df: DataFrame, date: str, seasons: Sequence[int]) -> DataFrame:
    """A date range the Parquet scan can use, as a stored season column would be."""
    if not seasons:
        return df
    day = F.col(date)
    return df.where((day >= F.lit(f"{min(seasons)}-01-01").cast("timestamp"))
                    & (day < F.lit(f"{max(seasons) + 1}-01-01").cast("timestamp")))


def weekly(spark: SparkSession, sf_dir: str, *seasons: int) -> DataFrame:
    return project(_seasons_of(read(spark, sf_dir, "lineitem"), "l_shipdate", seasons), WEEKLY)


def seasonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").selectExpr(
        "*", f"{WEEKLY['player_id']} AS player_id", f"{WEEKLY['season']} AS season"
    )
    return lines.groupBy("player_id", "season").agg(
        F.expr("'REG'").alias("season_type"),
        *[F.expr(f"sum({e})").cast("double").alias(n) for n, e in STATS.items()],
        F.expr(GAMES).alias("games"),
    )


def plays(spark: SparkSession, sf_dir: str, *seasons: int) -> DataFrame:
    return project(_seasons_of(read(spark, sf_dir, "lineitem"), "l_shipdate", seasons), PLAYS)


def schedules(spark: SparkSession, sf_dir: str, *seasons: int) -> DataFrame:
    return project(_seasons_of(read(spark, sf_dir, "orders"), "o_orderdate", seasons), SCHEDULES)


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(read(spark, sf_dir, "nation"), TEAMS)


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(read(spark, sf_dir, "customer"), PLAYERS)


def injuries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(read(spark, sf_dir, "events"), INJURIES)


def refresh_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(read(spark, sf_dir, "events"), REFRESH_LOG)


def raw_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(read(spark, sf_dir, "part"), RAW_RANKS)


def roster_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(read(spark, sf_dir, "part"), ROSTER_NAMES)


def _by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    seasons = F.sequence(F.lit(FIRST_SEASON), F.lit(LAST_SEASON))
    return (
        read(spark, sf_dir, "supplier")
        .withColumn("season", F.explode(seasons))
        .withColumn("week", F.explode(F.array(*[F.lit(w) for w in WEEKS])))
    )


def rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(_by_season(spark, sf_dir), ROSTERS)


def player_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(_by_season(spark, sf_dir), PLAYER_RANKS)


# -- SQL side ---------------------------------------------------------------------------


def _select(columns: Columns, source: str) -> str:
    return f"SELECT {', '.join(f'{e} AS {n}' for n, e in columns.items())} FROM {source}"


_BY_SEASON = (
    f"(SELECT s.*, CAST(y.season AS INT) AS season, CAST(w.week AS INT) AS week FROM supplier s, "
    f"range({FIRST_SEASON}, {LAST_SEASON + 1}) y(season), range({WEEKS[0]}, {WEEKS[-1] + 1}) w(week))"
)

SQL = {
    "weekly": _select(WEEKLY, "lineitem"),
    "seasonal": (
        f"SELECT {WEEKLY['player_id']} AS player_id, {WEEKLY['season']} AS season, 'REG' AS season_type, "
        + ", ".join(f"CAST(sum({e}) AS DOUBLE) AS {n}" for n, e in STATS.items())
        + f", CAST({GAMES} AS BIGINT) AS games FROM lineitem GROUP BY 1, 2"
    ),
    "plays": _select(PLAYS, "lineitem"),
    "schedules": _select(SCHEDULES, "orders"),
    "teams": _select(TEAMS, "nation"),
    "players": _select(PLAYERS, "customer"),
    "injuries": _select(INJURIES, "events"),
    "refresh_log": _select(REFRESH_LOG, "events"),
    "raw_ranks": _select(RAW_RANKS, "part"),
    "roster_names": _select(ROSTER_NAMES, "part"),
    "rosters": _select(ROSTERS, _BY_SEASON),
    "player_ranks": _select(PLAYER_RANKS, _BY_SEASON),
}


def with_tables(names: Sequence[str], body: str) -> str:
    """``body`` with the named domain tables in front as CTEs.

    A body that has CTEs of its own starts with a comma-free ``name AS (...)`` list after
    ``WITH``; they are appended.
    """
    ctes = ", ".join(f"{n} AS ({SQL[n]})" for n in names)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"
