"""The season summary: one wide row per player and season."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.operators.ranking import rank_within

# --- fixed values: stats with a per-game column, ranked positions, rank column names ---
PER_GAME_STATS = (
    "completions", "attempts", "passing_yards", "passing_tds", "interceptions", "sacks",
    "sack_yards", "sack_fumbles", "sack_fumbles_lost", "passing_air_yards",
    "passing_yards_after_catch", "passing_first_downs", "passing_epa",
    "passing_2pt_conversions", "carries", "rushing_yards", "rushing_tds",
    "rushing_first_downs", "rushing_epa", "rushing_2pt_conversions", "receptions", "targets",
    "receiving_yards", "receiving_tds", "receiving_air_yards",
    "receiving_yards_after_catch", "receiving_first_downs", "receiving_epa",
    "receiving_2pt_conversions", "racr", "target_share", "air_yards_share", "wopr_x",
    "special_teams_tds", "fantasy_points_std", "fantasy_points_half_ppr",
    "fantasy_points_full_ppr", "fantasy_points_ppr", "fumbles_lost",
)
RANKED_POSITIONS = ("QB", "RB", "WR", "TE", "K")
RANK_PREFIXES = {
    "std": "fantasy_points_std",
    "halfppr": "fantasy_points_half_ppr",
    "fullppr": "fantasy_points_full_ppr",
}
RANKING_VALUES = (
    "rank", "best_rank", "worst_rank", "avg_rank", "stddev_rank", "adp", "vs_adp", "position_rank",
)
#: Output prefix -> value of before_preseason.
RANKING_PHASES = {"ecr_preszn": False, "ecr": True}
# --- end of fixed values ---

ROSTER_COLUMNS = ("player_name", "position", "years_exp", "draft_number", "weight", "height", "rookie_year")
SAMPLE_COLUMNS = (
    "player_id", "season", "position", "games", "fantasy_points_std", "std_tot_rnk", "std_ppg_rnk",
    "ecr_rank", "ecr_preszn_rank",
)


def roster_summary(rosters: DataFrame) -> DataFrame:
    """One row per player and season; of several values the largest, so that runs repeat."""
    return rosters.groupBy("player_id", "season").agg(*[F.max(c).alias(c) for c in ROSTER_COLUMNS])


def per_game(stat: str) -> Column:
    """Value per game; 0 where there are no games."""
    return F.expr(f"CASE WHEN games > 0 THEN CAST({stat} AS DOUBLE) / games ELSE 0D END")


def per_game_columns(stats: Sequence[str] = PER_GAME_STATS) -> dict[str, Column]:
    return {f"{s}_per_game": per_game(s) for s in stats}


def base_rows(seasonal: DataFrame, rosters: DataFrame) -> DataFrame:
    """Season stats with player facts, rookie flag and per-game columns."""
    facts = roster_summary(rosters).withColumnRenamed("draft_number", "draft_position")
    rookie = F.expr("CASE WHEN season = try_cast(rookie_year AS INT) THEN 1 ELSE 0 END")
    return (
        seasonal.join(facts, ["player_id", "season"], "left")
        .withColumns({"is_rookie": rookie, **per_game_columns()})
        .drop("rookie_year")
    )


def position_ranks(base: DataFrame, totals: bool = True, per_game_ranks: bool = True) -> DataFrame:
    """``base`` with ranks inside (season, position); NULL outside the ranked positions."""
    measures: dict[str, Column] = {}
    if totals:
        measures |= {f"{p}_tot_rnk": F.col(c) for p, c in RANK_PREFIXES.items()}
    if per_game_ranks:
        measures |= {f"{p}_ppg_rnk": per_game(c) for p, c in RANK_PREFIXES.items()}
    ranked = F.col("position").isin(*RANKED_POSITIONS)
    return rank_within(base, ["season", "position"], measures, row_key=["player_id"], only=ranked)


def rankings_by_player(linked: DataFrame) -> DataFrame:
    """Expert rankings turned sideways: one row per player and season, both phases.

    Of several entries in a phase the best-ranked one that has the value is taken, of equally
    ranked ones (those without a rank come last) the smallest value.
    """
    cells = [
        F.expr(
            f"min_by({v}, CASE WHEN before_preseason = {early} AND {v} IS NOT NULL "
            f"THEN struct(coalesce(rank, double('Infinity')) AS at, {v} AS v) END)"
        ).alias(f"{prefix}_{v}")
        for prefix, early in RANKING_PHASES.items() for v in RANKING_VALUES
    ]
    return linked.groupBy("player_id", F.col("year").alias("season")).agg(*cells)


def season_summary(seasonal: DataFrame, rosters: DataFrame, linked: DataFrame) -> DataFrame:
    """Season stats, player facts, per-game columns, ranks and expert rankings."""
    ranked = position_ranks(base_rows(seasonal, rosters))
    return ranked.join(rankings_by_player(linked), ["player_id", "season"], "left")


def summary_sample(summary: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` best player seasons by standard points."""
    pts = F.col("fantasy_points_std")
    return (
        summary.where(pts > 0)
        .orderBy(pts.desc_nulls_last(), F.col("player_id").asc_nulls_last(), F.col("season").asc_nulls_last())
        .select(*SAMPLE_COLUMNS)
        .limit(n)
    )
