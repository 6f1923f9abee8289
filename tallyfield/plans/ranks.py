"""Rankings: verification of the raw table, linking to players, match report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.operators.matching import EXACT, PARTIAL, exact_matches, link_players, ranked_names, roster_names, unmatched_entries
from tallyfield.functions.names import name_key, position_key
from tallyfield.functions.exact import bitmap_bucket, bitmap_of, ratio
from tallyfield.schemas import TABLES

RAW_COLUMNS = tuple(TABLES["raw_ecr_rankings"].types)
LINKED_COLUMNS = (*RAW_COLUMNS, "player_id")


def coverage_by_year(raw: DataFrame) -> DataFrame:
    """Entries per year, before and after the preseason."""
    early = F.coalesce(F.col("before_preseason"), F.lit(False))
    return (
        raw.groupBy("year")
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_if(early).alias("before_preseason_records"),
            F.count_if(~early).alias("after_preseason_records"),
        )
        .orderBy(F.asc_nulls_last("year"))
    )


def verify(raw: DataFrame) -> DataFrame:
    """Totals, missing values and year range in one row, one pass; years are counted by bitmaps."""
    def blank(c: str):
        return F.col(c).isNull() | (F.col(c) == "")

    early, year = F.col("before_preseason"), F.col("year")
    sums = {
        "total_records": F.count(F.lit(1)),
        "missing_player_names": F.count_if(blank("player_name")),
        "missing_positions": F.count_if(blank("position")),
        "missing_ranks": F.count_if(F.col("rank").isNull()),
        "missing_avg_ranks": F.count_if(F.col("avg_rank").isNull()),
    }
    years = {
        "unique_years": year,
        "years_with_prepreseason": F.when(early, year),
        "years_with_preseason": F.when(~early, year),
    }
    by_bucket = raw.groupBy(bitmap_bucket(year).alias("_bucket")).agg(
        *[c.alias(name) for name, c in sums.items()], F.min("year").alias("min_year"), F.max("year").alias("max_year"),
        *[bitmap_of(c).alias(name) for name, c in years.items()],
    )
    return by_bucket.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in sums],
        F.min("min_year").alias("min_year"), F.max("max_year").alias("max_year"),
        *[F.coalesce(F.sum(F.bitmap_count(name)), F.lit(0)).cast("bigint").alias(name) for name in years],
    )


def linked_rankings(raw: DataFrame, rosters: DataFrame) -> DataFrame:
    """The rankings table with player ids; entries without a match are not in it."""
    audit = [c for c in ("created_at", "updated_at") if c in raw.columns]
    return link_players(raw, rosters).select(*LINKED_COLUMNS, *audit)


def unmatched_names(raw: DataFrame, linked: DataFrame, top_n: int | None = 20) -> DataFrame:
    """Names without an id, most frequent first."""
    out = (
        unmatched_entries(raw, linked)
        .groupBy("player_name", "position")
        .agg(F.count(F.lit(1)).alias("occurrence_count"))
        .orderBy(F.desc("occurrence_count"), F.asc_nulls_last("player_name"), F.asc_nulls_last("position"))
    )
    return out.limit(top_n) if top_n else out


def match_types(linked: DataFrame, rosters: DataFrame) -> DataFrame:
    """How many linked entries were found exactly and how many partially."""
    found = exact_matches(ranked_names(linked), roster_names(rosters)).select("name_key", "pos_key", F.lit(True).alias("_exact"))
    keyed = linked.select(
        name_key(F.col("player_name")).alias("name_key"), position_key(F.col("position")).alias("pos_key")
    )
    return (
        keyed.groupBy("name_key", "pos_key").agg(F.count(F.lit(1)).alias("_n"))
        .join(found, ["name_key", "pos_key"], "left")
        .groupBy(F.when(F.col("_exact"), EXACT).otherwise(PARTIAL).alias("match_type"))
        .agg(F.sum("_n").alias("count"))
    )


def match_report(raw: DataFrame, linked: DataFrame) -> DataFrame:
    """Totals and match rate in one row."""
    sides = raw.select(F.lit(1).alias("r"), F.lit(0).alias("m")).unionAll(
        linked.select(F.lit(0).alias("r"), F.lit(1).alias("m"))
    )
    r, m = F.col("total_raw_records"), F.col("total_matched_records")
    return sides.agg(
        F.coalesce(F.sum("r"), F.lit(0)).cast("bigint").alias("total_raw_records"),
        F.coalesce(F.sum("m"), F.lit(0)).cast("bigint").alias("total_matched_records"),
    ).select(r, m, F.round(ratio(m, r) * 100, 2).alias("match_rate"), (r - m).alias("unmatched_count"))
