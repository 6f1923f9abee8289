"""The named analytic queries, Q1 to Q16.

Each takes domain frames and returns a lazy frame.  Filters sit directly on the scan so that
season partitions are pruned; every aggregation combines map-side; joins happen after
aggregation wherever the result allows it, so hot players or teams are small before a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.functions.exact import avg2, hundredths, ratio, stddev2, sum2
from tallyfield.operators.bands import around
from tallyfield.operators.team_games import team_games

# --- fixed values ---
SKILL_POSITIONS = ("QB", "RB", "WR", "TE")
RECEIVING_POSITIONS = ("RB", "WR", "TE")
MONTHS = ((4, "September"), (8, "October"), (12, "November"), (16, "December"))
LAST_MONTH = "January"
RED_ZONE_YARDS = 20
# --- end of fixed values ---

PLAYER = ("player_name", "position", "team")


def _count() -> Column:
    return F.count(F.lit(1))


def _big_sum(c: Column | str) -> Column:
    return F.sum(c).cast("bigint")


def _season(df: DataFrame, season: int, positions: Sequence[str] = ()) -> DataFrame:
    df = df.where(F.col("season") == season)
    if len(positions) == 1:
        return df.where(F.col("position") == positions[0])
    return df.where(F.col("position").isin(*positions)) if positions else df


def top_players(
    weekly: DataFrame, season: int = 2023, positions: Sequence[str] = SKILL_POSITIONS, min_games: int = 10
) -> DataFrame:
    """Q1: best players of each position by mean standard points."""
    return (
        _season(weekly, season, positions)
        .groupBy(*PLAYER)
        .agg(
            _count().alias("games_played"),
            avg2(F.col("fantasy_points_std")).alias("avg_fantasy_points"),
            sum2(F.col("fantasy_points_std")).alias("total_fantasy_points"),
        )
        .where(F.col("games_played") >= min_games)
        .orderBy(F.asc_nulls_last("position"), F.desc_nulls_last("avg_fantasy_points"))
    )


def system_comparison(
    weekly: DataFrame, season: int = 2023, positions: Sequence[str] = RECEIVING_POSITIONS, min_games: int = 10
) -> DataFrame:
    """Q2: what receptions are worth to each player."""
    std, full = F.col("fantasy_points_std"), F.col("fantasy_points_full_ppr")
    return (
        _season(weekly, season, positions)
        .groupBy(*PLAYER)
        .agg(
            avg2(std).alias("avg_std"),
            avg2(full).alias("avg_ppr"),
            avg2(full - std).alias("ppr_advantage"),
            _count().alias("_games"),
        )
        .where(F.col("_games") >= min_games)
        .drop("_games")
        .orderBy(F.desc_nulls_last("ppr_advantage"))
    )


def volatility(
    weekly: DataFrame, season: int = 2023, positions: Sequence[str] = ("RB",), min_games: int = 10
) -> DataFrame:
    """Q3: spread of weekly points."""
    pts = F.col("fantasy_points_std")
    return (
        _season(weekly, season, positions)
        .groupBy(*PLAYER)
        .agg(
            avg2(pts).alias("avg_points"),
            stddev2(pts).alias("volatility"),
            F.min(pts).alias("min_points"),
            F.max(pts).alias("max_points"),
            _count().alias("_games"),
        )
        .where(F.col("_games") >= min_games)
        .drop("_games")
        .orderBy(F.asc_nulls_last("volatility"))
    )


def defense_matchups(
    weekly: DataFrame, season: int = 2023, positions: Sequence[str] = SKILL_POSITIONS
) -> DataFrame:
    """Q4: points and yards allowed by each defense to each position."""
    return (
        _season(weekly, season, positions)
        .groupBy(F.col("opponent_team").alias("defense"), "position")
        .agg(
            _count().alias("games"),
            avg2(F.col("fantasy_points_std")).alias("avg_points_allowed"),
            F.avg("passing_yards").alias("avg_pass_yards"),
            F.avg("rushing_yards").alias("avg_rush_yards"),
            F.avg("receiving_yards").alias("avg_rec_yards"),
        )
        .orderBy(F.asc_nulls_last("position"), F.desc_nulls_last("avg_points_allowed"))
    )


def red_zone(plays: DataFrame, positions: DataFrame, season: int = 2023, min_plays: int = 10) -> DataFrame:
    """Q5: touchdowns per play close to the goal line.

    ``positions`` has one row per player_id.  Plays are counted per player first and only the
    counts meet the position lookup; counts add up, so regrouping by position is exact.
    """
    close = F.col("yardline_100") <= RED_ZONE_YARDS
    involved = (
        F.col("passer_player_name").isNotNull()
        | F.col("rusher_player_name").isNotNull()
        | F.col("receiver_player_name").isNotNull()
    )
    per_player = (
        plays.where((F.col("season") == season) & close & involved)
        .groupBy(
            F.col("fantasy_player_id").alias("player_id"),
            F.col("fantasy_player_name").alias("player_name"),
            F.col("posteam").alias("team"),
        )
        .agg(F.count_if(F.col("touchdown").cast("double") == 1).alias("_tds"), F.count_if(close).alias("_plays"))
    )
    return (
        per_player.join(positions.select("player_id", "position"), "player_id", "left")
        .groupBy(*PLAYER)
        .agg(F.sum("_tds").alias("touchdowns"), F.sum("_plays").alias("redzone_plays"))
        .where(F.col("redzone_plays") >= min_plays)
        .withColumn("redzone_td_rate", F.round(ratio(F.col("touchdowns") * 100, F.col("redzone_plays")), 2))
        .orderBy(F.desc_nulls_last("redzone_td_rate"))
    )


def quarterback_efficiency(weekly: DataFrame, season: int = 2023, min_attempts: int = 100) -> DataFrame:
    """Q6: completion rate, yards per attempt, touchdowns per interception."""
    att, cmp_, yds = F.col("total_attempts"), F.col("total_completions"), F.col("total_yards")
    return (
        _season(weekly, season, ("QB",))
        .groupBy("player_name", "team")
        .agg(
            _big_sum("attempts").alias("total_attempts"),
            _big_sum("completions").alias("total_completions"),
            F.sum("passing_yards").alias("total_yards"),
            _big_sum("passing_tds").alias("total_tds"),
            F.sum("interceptions").alias("total_ints"),
        )
        .where(att >= min_attempts)
        .select(
            "player_name", "team", att, cmp_,
            F.round(ratio(cmp_ * 100, att), 2).alias("completion_pct"),
            yds,
            F.round(ratio(yds, att), 2).alias("yards_per_attempt"),
            "total_tds", "total_ints",
            F.round(ratio(F.col("total_tds"), F.col("total_ints")), 2).alias("td_int_ratio"),
        )
        .orderBy(F.desc_nulls_last("yards_per_attempt"))
    )


def running_back_workload(weekly: DataFrame, season: int = 2023, min_games: int = 10) -> DataFrame:
    """Q7: carries and targets per game."""
    games = F.col("games_played")
    return (
        _season(weekly, season, ("RB",))
        .groupBy("player_name", "team")
        .agg(
            _count().alias("games_played"),
            _big_sum("carries").alias("total_carries"),
            _big_sum("targets").alias("total_targets"),
            _big_sum(F.col("carries") + F.col("targets")).alias("total_touches"),
        )
        .where(games >= min_games)
        .select(
            "player_name", "team", games,
            "total_carries", F.round(ratio(F.col("total_carries"), games), 2).alias("carries_per_game"),
            "total_targets", F.round(ratio(F.col("total_targets"), games), 2).alias("targets_per_game"),
            "total_touches", F.round(ratio(F.col("total_touches"), games), 2).alias("touches_per_game"),
        )
        .orderBy(F.desc_nulls_last("touches_per_game"))
    )


def _team_results(schedules: DataFrame, season: int, season_type: str) -> DataFrame:
    """Per team: games, points scored, wins, losses.  Joined to team names afterwards."""
    games = schedules.where((F.col("season") == season) & (F.col("season_type") == season_type)).select(
        "game_id", "home_team", "away_team", "home_score", "away_score"
    )
    home, away = F.col("home_team") == F.col("team"), F.col("away_team") == F.col("team")
    ahead, behind = F.col("home_score") > F.col("away_score"), F.col("home_score") < F.col("away_score")

    def flag(c: Column) -> Column:
        return F.sum(F.when(c, 1).otherwise(0))

    return team_games(games).groupBy("team").agg(
        F.count_distinct("game_id").alias("games_played"),
        _big_sum(F.when(home, F.col("home_score")).when(away, F.col("away_score"))).alias("total_points"),
        flag((home & ahead) | (away & behind)).alias("wins"),
        flag((home & behind) | (away & ahead)).alias("losses"),
    )


def _named_teams(teams: DataFrame) -> DataFrame:
    return teams.select(F.col("team_abbr").alias("team"), "team_name", "team_division")


def team_offense(
    teams: DataFrame, schedules: DataFrame, season: int = 2023, season_type: str = "REG"
) -> DataFrame:
    """Q8: points per game and win rate of each team."""
    games = F.col("games_played")
    return (
        _named_teams(teams)
        .join(_team_results(schedules, season, season_type), "team")
        .select(
            "team_name", "team_division", games, "total_points",
            F.round(ratio(F.col("total_points"), games), 2).alias("points_per_game"),
            "wins",
            F.round(ratio(F.col("wins") * 100, games), 2).alias("win_pct"),
        )
        .orderBy(F.desc_nulls_last("points_per_game"))
    )


def division_standings(
    teams: DataFrame, schedules: DataFrame, season: int = 2023, season_type: str = "REG"
) -> DataFrame:
    """Q9: wins and losses within each division."""
    return (
        _named_teams(teams)
        .join(_team_results(schedules, season, season_type), "team")
        .select(
            "team_division", "team_name", "games_played", "wins", "losses",
            F.round(ratio(F.col("wins") * 100, F.col("games_played")), 2).alias("win_pct"),
        )
        .orderBy(F.asc_nulls_last("team_division"), F.desc_nulls_last("win_pct"))
    )


def consistency(
    weekly: DataFrame, season: int = 2023, positions: Sequence[str] = SKILL_POSITIONS,
    min_games: int = 10, min_points: float = 5.0,
) -> DataFrame:
    """Q10: coefficient of variation of weekly points."""
    pts = F.col("fantasy_points_std")
    return (
        _season(weekly, season, positions)
        .groupBy(*PLAYER)
        .agg(_count().alias("games"), avg2(pts).alias("avg_points"), stddev2(pts).alias("std_dev"))
        .where((F.col("games") >= min_games) & (F.col("avg_points") > min_points))
        .withColumn("coefficient_of_variation", F.round(ratio(F.col("std_dev"), F.col("avg_points")), 3))
        .orderBy(F.asc_nulls_last("coefficient_of_variation"))
    )


def breakouts(weekly: DataFrame, season: int = 2023, min_games: int = 10) -> DataFrame:
    """Q11: players better than the season before.

    Both seasons come out of one scan and one aggregation; only the grouped rows are joined,
    by player name alone, as a player may have changed team.
    """
    grouped = (
        weekly.where(F.col("season").isin(season, season - 1))
        .groupBy("season", *PLAYER)
        .agg(avg2(F.col("fantasy_points_std")).alias("_avg"), _count().alias("_games"))
        .where(F.col("_games") >= min_games)
    )
    now, before = f"avg_{season}", f"avg_{season - 1}"
    current = grouped.where(F.col("season") == season).select(*PLAYER, F.col("_avg").alias(now))
    previous = grouped.where(F.col("season") == season - 1).select("player_name", F.col("_avg").alias(before))
    gain = F.col(now) - F.col(before)
    return (
        current.join(previous, "player_name")
        .where(F.col(now) > F.col(before))
        .select(
            *PLAYER, before, now,
            F.round(gain, 2).alias("improvement"),
            F.round(ratio(gain, F.col(before)) * 100, 2).alias("improvement_pct"),
        )
        .orderBy(F.desc_nulls_last("improvement_pct"))
    )


def home_away_splits(
    weekly: DataFrame, schedules: DataFrame, season: int = 2023,
    positions: Sequence[str] = ("QB",), min_games: int = 5,
) -> DataFrame:
    """Q12: points in home and away games.

    The join has no week: each stat row pairs with every game of its team in the season.
    That pairing repeats every row of a player equally often, so counts multiply and means
    are those of the player's own rows; aggregating both sides first gives the same result
    with one row per player and per team in the join.
    """
    pts = F.col("fantasy_points_std")
    players = (
        _season(weekly, season, positions)
        .groupBy(*PLAYER)
        .agg(_count().alias("_rows"), avg2(pts).alias("_avg"))
    )
    games = (
        team_games(schedules.where(F.col("season") == season).select("home_team", "away_team"))
        .groupBy("team")
        .agg(
            F.count_if(F.col("home_team") == F.col("team")).alias("_home"),
            F.count_if(F.col("away_team") == F.col("team")).alias("_away"),
        )
    )
    home_avg = F.when(F.col("_home") > 0, F.col("_avg"))
    away_avg = F.when(F.col("_away") > 0, F.col("_avg"))
    return (
        players.join(games, "team")
        .select(
            *PLAYER,
            (F.col("_rows") * F.col("_home")).alias("home_games"),
            F.round(home_avg, 2).alias("home_avg"),
            (F.col("_rows") * F.col("_away")).alias("away_games"),
            F.round(away_avg, 2).alias("away_avg"),
            F.round(home_avg - away_avg, 2).alias("home_advantage"),
        )
        .where((F.col("home_games") >= min_games) & (F.col("away_games") >= min_games))
        .orderBy(F.desc_nulls_last("home_advantage"))
    )


def injury_impact(
    weekly: DataFrame, injuries: DataFrame, season: int = 2023, healthy: str = "Healthy", min_games: int = 3
) -> DataFrame:
    """Q13: points before and after an injury report.

    Every stat row pairs with every report of the player's season.  Both sides are counted per
    week first: a season has a couple of dozen weeks, so a player's pairs are bounded by their
    square however many rows or reports there are.
    """
    cents = hundredths(F.col("fantasy_points_std"))
    stats = (
        weekly.where(F.col("season") == season)
        .groupBy(*PLAYER, F.col("week").alias("_week"))
        .agg(_count().alias("_rows"), F.count("fantasy_points_std").alias("_scored"), F.sum(cents).alias("_cents"))
    )
    reports = (
        injuries.where((F.col("season") == season) & (F.col("injury_designation") != healthy))
        .groupBy("player_name", F.col("week").alias("_hurt"))
        .agg(_count().alias("_reports"))
    )

    def weighted(name: str, side: Column) -> Column:
        return F.sum(F.when(side, F.col(name) * F.col("_reports")))

    pre, post = F.col("_week") < F.col("_hurt"), F.col("_week") > F.col("_hurt")
    sides = (("pre", pre), ("post", post))
    return (
        stats.join(reports, "player_name")
        .groupBy(*PLAYER)
        .agg(
            *[weighted("_cents", s).alias(f"_{n}_cents") for n, s in sides],
            *[weighted("_scored", s).alias(f"_{n}_scored") for n, s in sides],
            *[F.coalesce(weighted("_rows", s), F.lit(0)).alias(f"{n}_injury_games") for n, s in sides],
        )
        .select(
            *PLAYER,
            *[
                (F.col(f"_{n}_cents") / F.lit(100.0) / F.nullif(F.col(f"_{n}_scored"), F.lit(0))).alias(f"{n}_injury_avg")
                for n, _ in sides
            ],
            "pre_injury_games", "post_injury_games",
        )
        .where((F.col("pre_injury_games") >= min_games) & (F.col("post_injury_games") >= min_games))
        .orderBy((F.col("pre_injury_avg") - F.col("post_injury_avg")).desc_nulls_last())
    )


def injury_days(
    games: DataFrame, injuries: DataFrame, days: int = 28, healthy: str = "Healthy", min_games: int = 3
) -> DataFrame:
    """Points in the days before and after each injury report, by date instead of by week.

    ``games`` has player_name, game_date and points, ``injuries`` player_name, report_date and designation. A
    player's reports of one day are one row, with their number. Games of that day count on neither side.
    """
    length = timedelta(days=days)
    facts = games.select(
        "player_name", F.col("game_date").alias("report_date"), hundredths(F.col("fantasy_points_std")).alias("cents"),
        F.col("fantasy_points_std").isNotNull().cast("int").alias("scored"),
    )
    reports = injuries.where(F.col("injury_designation") != healthy)
    bands = around(facts, reports, ["player_name"], "report_date", ["cents", "scored"], length, length)

    def average(side: str) -> Column:
        return F.col(f"cents_{side}") / F.lit(100.0) / F.nullif(F.col(f"scored_{side}"), F.lit(0))

    return bands.select(
        "player_name", "report_date", F.col("events").alias("reports"),
        F.col("facts_before").alias("pre_injury_games"), average("before").alias("pre_injury_avg"),
        F.col("facts_after").alias("post_injury_games"), average("after").alias("post_injury_avg"),
    ).where((F.col("pre_injury_games") >= min_games) & (F.col("post_injury_games") >= min_games))


def month_label(week: Column) -> Column:
    """Calendar month a week falls into, by its number."""
    (first, name), *rest = MONTHS
    label = F.when(week <= first, name)
    for last, name in rest:
        label = label.when(week <= last, name)
    return label.otherwise(LAST_MONTH)


def monthly_form(
    weekly: DataFrame, season: int = 2023, positions: Sequence[str] = ("RB",), min_games: int = 2
) -> DataFrame:
    """Q14: mean points by month."""
    return (
        _season(weekly, season, positions)
        .groupBy(*PLAYER, month_label(F.col("week")).alias("month"))
        .agg(_count().alias("games"), avg2(F.col("fantasy_points_std")).alias("avg_points"))
        .where(F.col("games") >= min_games)
        .orderBy(F.asc_nulls_last("player_name"), F.asc_nulls_last("month"))
    )


def weekly_trend(
    weekly: DataFrame, season: int = 2023, positions: Sequence[str] = SKILL_POSITIONS
) -> DataFrame:
    """Q15: league scoring by week."""
    std = F.col("fantasy_points_std")
    return (
        _season(weekly, season, positions)
        .groupBy("week")
        .agg(
            _count().alias("player_performances"),
            avg2(std).alias("avg_std_points"),
            avg2(F.col("fantasy_points_full_ppr")).alias("avg_ppr_points"),
            F.min(std).alias("min_points"),
            F.max(std).alias("max_points"),
        )
        .orderBy(F.asc_nulls_last("week"))
    )


def stats_with_ranks(
    weekly: DataFrame, rankings: DataFrame, season: int = 2024, week: int | None = 1,
    points_col: str = "fantasy_points_ppr", top_n: int | None = 20, tie_break: Sequence[str] = ("player_id", "ecr_rank"),
) -> DataFrame:
    """Q16: best performances of a week beside the expert rank of the season.

    Rankings are per season; if they carry a week as well, that is matched too.
    """
    stats = weekly.where(F.col("season") == season)
    if week is not None:
        stats = stats.where(F.col("week") == week)
    keys = ["player_id", "season"] + (["week"] if "week" in rankings.columns else [])
    ranks = rankings.withColumnsRenamed({"year": "season", "rank": "ecr_rank"}).where(F.col("season") == season)
    out = stats.join(ranks.select(*keys, "ecr_rank"), keys, "left").select(
        "player_id", *PLAYER, points_col, "ecr_rank"
    )
    order = [F.desc_nulls_last(points_col), *[F.asc_nulls_last(c) for c in tie_break]]
    out = out.orderBy(*order)
    return (out.limit(top_n) if top_n else out).drop("player_id")
