"""Reports over many tables at once, as long frames."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.operators.quality import (
    count_where,
    expect_at_rank,
    numeric_columns,
    repeated_rows,
    top_of_ranking,
    unique_on,
)
from tallyfield.plans.season_summary import RANK_PREFIXES
from tallyfield.schemas import COVERAGE_TABLES, DUPLICATE_CHECKED
from tallyfield.sources import profiles
from tallyfield.sources.warehouse import Warehouse

AFTER_LOAD, ON_VALIDATE = 50.0, 10.0
LOG_TABLE = "data_refresh_log"


def _long(df: DataFrame, metric: str, item: str | None, value: str) -> DataFrame:
    return df.select(
        "table_name", F.lit(metric).alias("metric"),
        (F.col(item).cast("string") if item else F.lit(None).cast("string")).alias("item"),
        F.col(value).cast("double").alias("value"),
    )


def validation_report(
    tables: Mapping[str, DataFrame],
    *,
    null_threshold: float = ON_VALIDATE,
    duplicate_tables: Sequence[str] = DUPLICATE_CHECKED,
    coverage_tables: Sequence[str] = COVERAGE_TABLES,
) -> DataFrame:
    """(table_name, metric, item, value): sizes, seasons, high-NULL columns, repeats."""
    parts = []
    for name, df in tables.items():
        logged = name == LOG_TABLE
        parts.append(_profile(df, name, name in coverage_tables, None if logged else null_threshold))
        if not logged and name in duplicate_tables:
            repeats = repeated_rows(df).withColumn("table_name", F.lit(name))
            parts.append(_long(repeats, "duplicates", None, "duplicates"))
    return reduce(DataFrame.unionByName, parts)


def kept_report(
    store: Warehouse, tables: Sequence[str] | None = None, *, null_threshold: float = ON_VALIDATE,
    duplicate_tables: Sequence[str] = DUPLICATE_CHECKED, coverage_tables: Sequence[str] = COVERAGE_TABLES,
) -> DataFrame:
    """The validation report from the profiles kept at load; only repeats, and the log, read data."""
    parts = []
    for name in tables if tables is not None else store.tables():
        df = store.read(name)
        if name == LOG_TABLE:
            parts.append(_profile(df, name, False, None))
            continue
        numbers = numeric_columns(df)
        # A column that a partition's rows lacked is NULL in all of them.
        hits = [F.coalesce(F.col("nulls")[c], F.col("row_count")).alias(f"_{i}") for i, c in enumerate(numbers)]
        counts = profiles.of(store, name).select("season", F.col("row_count").alias("n"), *hits)
        parts.append(_summed(counts, numbers, len(df.columns), name, name in coverage_tables, null_threshold))
        if name in duplicate_tables:
            repeats = repeated_rows(df).withColumn("table_name", F.lit(name))
            parts.append(_long(repeats, "duplicates", None, "duplicates"))
    return reduce(DataFrame.unionByName, parts)


def _profile(df: DataFrame, name: str, by_season: bool, null_threshold: float | None) -> DataFrame:
    """Rows, rows of each season and high-NULL columns of one table, in one pass over it."""
    numbers = [] if null_threshold is None else numeric_columns(df)
    counts = df.groupBy(*(["season"] if by_season else [])).agg(
        F.count(F.lit(1)).alias("n"), *[count_where(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(numbers)]
    )
    return _summed(counts, numbers, len(df.columns), name, by_season, null_threshold)


def _summed(
    counts: DataFrame, numbers: Sequence[str], width: int, name: str, by_season: bool, null_threshold: float | None
) -> DataFrame:
    """The report of one table from few rows of counts: n, NULLs as _0, _1, ..., and season where asked for."""

    def cell(metric: str, item: Column | None, hits: str) -> Column:
        text = F.lit(None).cast("string") if item is None else item
        return F.struct(F.lit(metric).alias("metric"), text.alias("item"), F.col(hits).alias("hits"), F.col("n").alias("n"))

    cells = [cell("rows", None, "n"), *[cell("null_percentage", F.lit(c), f"_{i}") for i, c in enumerate(numbers)]]
    if by_season:
        cells.append(cell("season_rows", F.col("season").cast("int").cast("string"), "n"))
    # An empty table gives no season row, but still counts 0 rows.
    fixed = [("rows", None, 0, 0)] + ([] if null_threshold is None else [("columns", None, width, 0)])
    known = counts.sparkSession.createDataFrame(fixed, "metric string, item string, hits bigint, n bigint")
    summed = (
        counts.select(F.explode(F.array(*cells)).alias("c")).select("c.*").unionByName(known)
        .groupBy("metric", "item").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n"))
    )
    share = F.col("hits").cast("double") * 100.0 / F.nullif(F.col("n"), F.lit(0))
    is_share = F.col("metric") == "null_percentage"
    value = F.when(is_share, F.coalesce(share, F.lit(0.0))).otherwise(F.col("hits").cast("double"))
    return summed.select(F.lit(name).alias("table_name"), "metric", "item", value.alias("value")).where(
        ~is_share | (F.col("value") > (null_threshold or 0.0))
    )


def summary_checks(seasonal: DataFrame, summary: DataFrame) -> DataFrame:
    """The two standing checks of the season summary, each table read once: row count and key uniqueness."""
    keys = unique_on(summary, ["player_id", "season"])
    given = seasonal.agg(F.count(F.lit(1)).alias("given"))
    both = keys.select("total_rows", "passed").withColumn("given", given.scalar())
    cells = F.array(
        F.struct(F.lit("record_counts").alias("check"), (F.col("given") == F.col("total_rows")).alias("passed")),
        F.struct(F.lit("no_duplicates").alias("check"), F.col("passed").alias("passed")),
    )
    return both.select(F.explode(cells).alias("c")).select("c.*")


def golden_ranks(spark: SparkSession, summary: DataFrame, path: str) -> Iterator[tuple[DataFrame, list[DataFrame]]]:
    """For each rank column of a CSV file of expectations: the checks, and the top of each ranking that failed.

    Columns of the file: season, position, rank_column, expected_rank, name_part.
    """
    given = spark.read.csv(
        path, header=True, schema="season int, position string, rank_column string, expected_rank bigint, name_part string"
    )
    for column in sorted(r[0] for r in given.select("rank_column").distinct().collect()):
        prefix = column.removesuffix("_tot_rnk").removesuffix("_ppg_rnk")
        expected = given.where(F.col("rank_column") == column).select(
            "season", "position", F.col("expected_rank").alias("rank"), "name_part"
        )
        checked = expect_at_rank(summary, column, expected)
        failed = checked.where("NOT passed").select("season", "position").distinct().collect()
        yield (
            checked.withColumn("rank_column", F.lit(column)),
            [top_of_ranking(summary, column, r["season"], r["position"], RANK_PREFIXES[prefix]) for r in failed],
        )
