"""Point systems and scoring.

A system is a mapping ``stat -> weight``.  Scoring is a fixed sum of products per row, so it
is one projection with no shuffle however many systems are asked for.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.functions.typing import number_sql

Rules = Mapping[str, float]

# --- fixed values: the built-in point systems ---
_COMMON = {
    "passing_yards": 0.04,
    "passing_tds": 4.0,
    "interceptions": -2.0,
    "rushing_yards": 0.1,
    "rushing_tds": 6.0,
    "receptions": 0.0,
    "receiving_yards": 0.1,
    "receiving_tds": 6.0,
    "fumbles_lost": -2.0,
    "two_point_conversions": 2.0,
}
RECEPTION_POINTS = {"std": 0.0, "half_ppr": 0.5, "full_ppr": 1.0}
# --- end of fixed values ---

#: Stats every scored table carries, filled with 0 where missing.
FILLED_STATS = tuple(s for s in _COMMON if s != "two_point_conversions")

#: Columns whose sum gives a stat that the source data does not have under that name.
DERIVED_STATS = {
    "fumbles_lost": ("sack_fumbles_lost", "rushing_fumbles_lost", "receiving_fumbles_lost"),
    "two_point_conversions": (
        "passing_2pt_conversions", "rushing_2pt_conversions", "receiving_2pt_conversions",
    ),
}

DEFAULT_SYSTEM = "std"


def builtin_systems() -> dict[str, dict[str, float]]:
    """The three built-in systems; they differ in points per reception only."""
    return {name: {**_COMMON, "receptions": r} for name, r in RECEPTION_POINTS.items()}


def with_system(systems: Mapping[str, Rules], name: str, rules: Rules) -> dict[str, Rules]:
    """A copy of ``systems`` with one system added or replaced."""
    return {**systems, name: dict(rules)}


def get_system(systems: Mapping[str, Rules], name: str) -> Rules:
    """Rules of ``name``; an unknown name has no rules."""
    return systems.get(name, {})


def rules_frame(spark: SparkSession, systems: Mapping[str, Rules] | None = None) -> DataFrame:
    """The rules as rows (system, stat, weight), to join or to show."""
    systems = systems if systems is not None else builtin_systems()
    rows = [(name, stat, float(w)) for name, rules in systems.items() for stat, w in rules.items()]
    return spark.createDataFrame(rows, "system string, stat string, weight double")


def _filled(df: DataFrame, stat: str) -> str:
    return f"coalesce({number_sql(stat, df.schema[stat].dataType)}, 0D)"


def points(df: DataFrame, rules: Rules) -> Column:
    """Points under ``rules``, rounded half-even to two decimals.

    Stats the frame lacks are skipped, NULL or unreadable values count as 0, and the terms
    are added in rule order so that results repeat bit for bit.
    """
    terms = [f"{_filled(df, s)} * {float(w)!r}D" for s, w in rules.items() if s in df.columns]
    return F.expr(f"rint(({' + '.join(['0D', *terms])}) * 100D) / 100D")


def points_for(df: DataFrame, system: str, systems: Mapping[str, Rules] | None = None) -> Column:
    """Points under one named system; an unknown name falls back to the standard one."""
    systems = systems if systems is not None else builtin_systems()
    return points(df, systems.get(system, systems[DEFAULT_SYSTEM]))


def score(
    df: DataFrame,
    systems: Mapping[str, Rules] | None = None,
    *,
    derive_missing: bool = False,
) -> DataFrame:
    """Add ``fantasy_points_<system>`` for every system.

    The stats in FILLED_STATS come back as doubles with NULLs filled; those the frame lacks
    are added as 0.0.  With ``derive_missing`` an absent fumbles_lost / two_point_conversions
    is first built from its parts; by default it counts 0, as the source columns carry other
    names.
    """
    systems = systems if systems is not None else builtin_systems()
    if derive_missing:
        derived = {
            stat: F.expr(" + ".join(_filled(df, p) for p in parts if p in df.columns))
            for stat, parts in DERIVED_STATS.items()
            if stat not in df.columns and any(p in df.columns for p in parts)
        }
        df = df.withColumns(derived) if derived else df
    df = df.withColumns(
        {s: F.expr(_filled(df, s) if s in df.columns else "0D") for s in FILLED_STATS}
    )
    return df.withColumns(
        {f"fantasy_points_{name}": points(df, rules) for name, rules in systems.items()}
    )


def top_performers(
    df: DataFrame,
    system: str = DEFAULT_SYSTEM,
    position: str | None = None,
    top_n: int = 10,
    tie_break: tuple[str, ...] = ("player_id", "season", "week"),
) -> DataFrame:
    """The ``top_n`` rows by one system's points, for one position if given."""
    if position:
        df = df.where(F.col("position") == position)
    by = f"fantasy_points_{system}"
    if by not in df.columns:
        return df
    ties = [F.col(c).asc_nulls_last() for c in tie_break if c in df.columns]
    return df.orderBy(F.col(by).desc_nulls_last(), *ties).limit(top_n)


def compare_systems(df: DataFrame, player_id: str | None = None) -> DataFrame:
    """All systems side by side, plus what receptions are worth under the full system."""
    if player_id:
        df = df.where(F.col("player_id") == player_id)
    names = [c for c in ("player_id", "player_name", "position", "team") if c in df.columns]
    pts = [c for c in df.columns if c.startswith("fantasy_points_")]
    out = df.select(*names, *pts) if names or pts else df
    if {"fantasy_points_full_ppr", "fantasy_points_std"} <= set(pts):
        gain = F.col("fantasy_points_full_ppr") - F.col("fantasy_points_std")
        out = out.withColumn("ppr_advantage", F.rint(gain * 100.0) / F.lit(100.0))
    return out
