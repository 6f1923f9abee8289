"""Load jobs: from landing folders into the warehouse, with a log entry per load."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.operators.fingerprints import changed_groups, input_fingerprints
from tallyfield.plans.ranks import linked_rankings
from tallyfield.plans.season_summary import season_summary
from tallyfield.schemas import LOAD_TABLES, SEASON_TABLES, TABLES
from tallyfield.sources import quarantine
from tallyfield.sources.landing import Landing
from tallyfield.sources.profiles import inside
from tallyfield.sources.rankfiles import FILE_GLOB, read_rankings
from tallyfield.sources.warehouse import Warehouse

logger = logging.getLogger(__name__)

ALL_SEASONS = 0
SEASON_TYPE = "ALL"


def load_table(
    warehouse: Warehouse, landing: Landing, table: str, seasons: Sequence[int] = (), *, keep_rejects: bool = False
) -> int:
    """Load one table for the given seasons in one job; returns rows written.

    Success and failure are both logged, one entry per season; a failure is raised again.
    ``keep_rejects`` also keeps the rows with cells that do not convert, see ``quarantine``.
    """
    units = list(seasons) if TABLES[table].by_season else [ALL_SEASONS]
    try:
        if keep_rejects:
            rows, by_season = quarantine.insert_checked(warehouse, landing, table, seasons)
        else:
            rows, by_season = warehouse.insert_counted(landing.read(table, seasons or None), table, seasons)
    except Exception as e:
        message = f"{table}: {type(e).__name__}: {e}"
        warehouse.log_refreshes([(table, unit, None, SEASON_TYPE, "FAILED", message, 0) for unit in units])
        raise
    done = [(table, unit, None, SEASON_TYPE, "SUCCESS", None, by_season.get(unit, rows)) for unit in units]
    if done:
        warehouse.log_refreshes(done)
    return rows


def _load_each(
    warehouse: Warehouse, landing: Landing, tables: Iterable[str], seasons: Sequence[int], **options
) -> dict[str, int]:
    counts = {}
    for table in tables:
        try:
            counts[table] = load_table(warehouse, landing, table, seasons, **options)
        except Exception:
            logger.exception("loading %s failed", table)
            counts[table] = 0
    return counts


def extract_all(warehouse: Warehouse, landing: Landing, seasons: Sequence[int], **options) -> dict[str, int]:
    """Load every table for all ``seasons``; a table that fails does not stop the rest. Options as load_table()."""
    return _load_each(warehouse, landing, LOAD_TABLES, seasons, **options)


def refresh_season(
    warehouse: Warehouse, landing: Landing, season: int, tables: Sequence[str] | None = None, **options
) -> dict[str, int]:
    """Reload one season of the chosen tables. Options as load_table()."""
    return _load_each(warehouse, landing, tables or SEASON_TABLES, [season], **options)


def refresh_week(warehouse: Warehouse, landing: Landing, season: int, week: int) -> int:
    """Reload one week of the weekly stats."""
    table = "weekly_stats"
    try:
        rows = warehouse.insert(landing.read(table, [season], week), table)
    except Exception as e:
        warehouse.log_refresh(table, season, week, "REG", "FAILED", f"{type(e).__name__}: {e}")
        raise
    if rows:
        warehouse.log_refresh(table, season, week, "REG", "SUCCESS", records_processed=rows)
    return rows


def refresh_raw_rankings(warehouse: Warehouse, folder: str, glob: str = FILE_GLOB, **options) -> int:
    """Rebuild the raw rankings from all rank files of a folder."""
    rankings = read_rankings(warehouse.spark, folder, glob, **options).drop("file_name")
    return warehouse.insert(rankings, "raw_ecr_rankings")


def refresh_linked_rankings(warehouse: Warehouse) -> None:
    """Rebuild the rankings with player ids."""
    raw, rosters = warehouse.read("raw_ecr_rankings"), warehouse.read("rosters")
    warehouse.rebuild(linked_rankings(raw, rosters), "ecr_rankings")


def _season_summary(w: Warehouse, seasons: Sequence[int | None] | None = None) -> DataFrame:
    """The summary of all seasons or of some, from those seasons of the inputs alone."""

    def only(df: DataFrame, column: str) -> DataFrame:
        return df if seasons is None else df.where(inside([column], [(s,) for s in seasons]))

    return season_summary(*[only(w.read(t), column) for t, column in SUMMARY_INPUTS["smry_season"].items()])


#: Summary tables and how each is built, of all seasons or of some.
SUMMARIES: dict[str, Callable[..., DataFrame]] = {"smry_season": _season_summary}

#: Inputs of each summary, with the column that says which of its seasons a row is for. The first one
#: decides which seasons the summary has.
SUMMARY_INPUTS = {"smry_season": {"seasonal_stats": "season", "rosters": "season", "ecr_rankings": "year"}}


def _input_prints(warehouse: Warehouse, table: str) -> DataFrame:
    return input_fingerprints({t: (warehouse.read(t), c) for t, c in SUMMARY_INPUTS[table].items()})


def rebuild_summary(warehouse: Warehouse, table: str, only_changed: bool = False) -> list[int | None]:
    """Rebuild a summary, or only the seasons whose inputs have changed; returns the seasons built.

    Fingerprints of each input's seasons are kept beside the table, and renewed after its rows: a
    job lost in between builds the same seasons again. All of it is built where no fingerprint is
    kept, a season has gone, or no season is left as it was.
    """
    prints, base = f"inputs-{table}", next(iter(SUMMARY_INPUTS[table]))
    staged = warehouse.versions.stage(_input_prints(warehouse, table).coalesce(1), prints)
    now = warehouse.versions.staged(prints, staged)
    of_base = F.col("input") == base
    seasons = [r["season"] for r in now.where(of_base).select("season").distinct().collect()]
    known = warehouse.versions.current(prints) if only_changed and warehouse.exists(table) else None
    built = seasons
    if known:
        before = warehouse.spark.read.parquet(known)
        had = {r["season"] for r in before.where(of_base).select("season").distinct().collect()}
        differ = {r["season"] for r in changed_groups(before, now).collect()}
        if had <= set(seasons) and not set(seasons) <= differ:
            built = [s for s in seasons if s in differ]
    if len(built) < len(seasons):
        if built:
            warehouse.rebuild_partitions(SUMMARIES[table](warehouse, built), table, "season")
    else:
        warehouse.rebuild(SUMMARIES[table](warehouse), table, ["season"])
    warehouse.versions.switch(prints, staged)
    return sorted(built, key=lambda s: (s is None, s))


def refresh_summaries(warehouse: Warehouse, only_changed: bool = False) -> dict[str, int]:
    """Rebuild every summary table; returns rows per table, 0 where it failed."""
    counts = {}
    for table in SUMMARIES:
        try:
            rebuild_summary(warehouse, table, only_changed)
            counts[table] = warehouse.read(table).count()
        except Exception:
            logger.exception("summary %s failed", table)
            counts[table] = 0
    return counts
