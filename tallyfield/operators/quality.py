"""Table profiles: counts, NULLs, repeats, coverage, schema, checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfield.schemas import AUDIT_COLUMNS


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def count_where(hit: Column) -> Column:
    """Rows that a condition holds for. Unlike ``count_if``, the plan holds no column for it in every row."""
    return F.count(F.when(hit, F.lit(1)))


def numeric_columns(df: DataFrame) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in AUDIT_COLUMNS
    ]


def table_size(df: DataFrame, name: str) -> DataFrame:
    """Row and column count of one table."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).cast("bigint").alias("column_count")
    )


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union([table_size(df, name) for name, df in tables.items()])


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count and percentage of each column (numeric ones by default), in one pass."""
    columns = list(columns) if columns is not None else numeric_columns(df)
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[count_where(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(columns)],
    )
    cells = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("null_count")) for i, c in enumerate(columns)
    ])
    cells = cells.cast("array<struct<column_name: string, null_count: bigint>>")
    pct = F.col("null_count").cast("double") * 100.0 / F.nullif(F.col("row_count"), F.lit(0))
    return (
        counts.select("row_count", F.explode(cells).alias("_c"))
        .select("_c.column_name", "_c.null_count", "row_count")
        .withColumn("null_percentage", F.coalesce(pct, F.lit(0.0)))
    )


def high_null_columns(profile: DataFrame, threshold: float) -> DataFrame:
    """Columns more than ``threshold`` percent NULL (50 after a load, 10 on validation)."""
    return profile.where(F.col("null_percentage") > threshold)


def repeated_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How many rows are repeats of another on ``columns`` (all by default).

    Grouping combines map-side, so a row copied many times costs one shuffled row per task;
    NULLs compare equal here.
    """
    columns = [f"`{c}`" for c in (columns or df.columns)]
    return df.groupBy(*columns).count().agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("duplicates")
    )


def first_column_repeats(df: DataFrame) -> DataFrame:
    """Rows minus distinct non-NULL values of the first column."""
    first = f"`{df.columns[0]}`"
    return df.agg((F.count(F.lit(1)) - F.count_distinct(F.col(first))).cast("bigint").alias("duplicates"))


def season_coverage(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Seasons found in each table, with their row counts."""
    return _union([
        df.groupBy("season").agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), F.col("season").cast("int").alias("season"), "row_count")
        for name, df in tables.items()
    ])


def season_lists(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its sorted seasons, comma-separated."""
    return (
        season_coverage(tables)
        .groupBy("table_name")
        .agg(F.array_join(F.sort_array(F.collect_set("season")), ",").alias("seasons"))
    )


def describe(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Column listing of every table, in column order."""
    rows = [
        (name, at, f.name, f.dataType.simpleString())
        for name, df in tables.items() for at, f in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, column_type string")


def same_count(left: DataFrame, right: DataFrame) -> DataFrame:
    """Do two tables have equally many rows?"""
    sides = left.select(F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(
        right.select(F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return sides.agg(
        F.coalesce(F.sum("l"), F.lit(0)).cast("bigint").alias("left_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).cast("bigint").alias("right_rows"),
    ).withColumn("passed", F.col("left_rows") == F.col("right_rows"))


def unique_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Is ``keys`` unique?  Keys holding a NULL are left out of the distinct count."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (
        df.groupBy(*keys).count()
        .agg(
            F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("total_rows"),
            F.count_if(whole).alias("distinct_keys"),
        )
        .withColumn("passed", F.col("total_rows") == F.col("distinct_keys"))
    )


def expect_at_rank(
    df: DataFrame, rank_col: str, expected: DataFrame, on: Sequence[str] = ("season", "position")
) -> DataFrame:
    """Check golden facts: ``expected`` has ``on``, rank and a ``name_part`` to be found there.

    Passes when exactly one row holds the rank and its name contains the part, in any case.
    """
    e = expected.withColumnRenamed("rank", rank_col)
    hits = df.join(e, [*on, rank_col]).groupBy(*on, rank_col, "name_part").agg(
        F.count(F.lit(1)).alias("found"),
        F.min("player_name").alias("player_name"),
    )
    ok = (F.col("found") == 1) & F.upper("player_name").contains(F.upper("name_part"))
    return (
        e.join(hits, [*on, rank_col, "name_part"], "left")
        .withColumn("passed", F.coalesce(ok, F.lit(False)))
        .select(*on, F.col(rank_col).alias("rank"), "name_part", "player_name",
                F.coalesce("found", F.lit(0)).alias("found"), "passed")
    )


def top_of_ranking(df: DataFrame, rank_col: str, season: int, position: str, points_col: str, n: int = 5) -> DataFrame:
    """The first ``n`` of one ranking, to look at when a check fails."""
    return (
        df.where((F.col("season") == season) & (F.col("position") == position))
        .orderBy(F.col(rank_col).asc_nulls_last(), F.col("player_id").asc_nulls_last())
        .select("player_id", "player_name", rank_col, points_col, "games")
        .limit(n)
    )
