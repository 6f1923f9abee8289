"""The stored tables: Parquet folders, partitioned by season, replaced by load unit."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfield.functions.typing import align, rename_reserved, with_audit
from tallyfield.operators.quality import count_where
from tallyfield.operators.replace import next_ids
from tallyfield.schemas import REFRESH_STATUSES, TABLES, TableSpec
from tallyfield.session import compiled
from tallyfield.sources import keyfilters, profiles
from tallyfield.sources.switch import Switch

LOG_TABLE = "data_refresh_log"
LOG_COLUMNS = (
    "id int, table_name string, season int, week int, season_type string, "
    "refresh_date timestamp, status string, error_message string, records_processed int"
)


Widen = Callable[[DataFrame], DataFrame]


def _as_stored(df: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """Columns stored before in the types they have there."""
    return df.select(*[
        F.col(f"`{f.name}`").try_cast(types[f.name]).alias(f.name)
        if types.get(f.name, f.dataType) != f.dataType else F.col(f"`{f.name}`")
        for f in df.schema
    ])


class Warehouse:
    """Named tables under one root folder (any file system Spark can write)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.versions = Switch(spark, self.root)

    def path(self, table: str) -> str:
        """Folder of a table's rows: of tables replaced as a whole, the version in use just now."""
        return self.versions.current(table) or f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        return self._schema_at(self.path(table)) is not None

    def _schema_at(self, path: str) -> T.StructType | None:
        """Schema of a stored folder; None if there is none, or nothing in it."""
        try:
            return self.spark.read.parquet(path).schema
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def _columns_path(self, table: str) -> str:
        """A file without rows whose schema is the union of all columns ever stored in a table."""
        return f"{self.root}/_columns/{table}"

    def columns(self, table: str) -> T.StructType | None:
        """All columns stored so far; read off the files of tables stored without that record."""
        known = self._schema_at(self._columns_path(table))
        if known is None and self.exists(table):
            known = self.spark.read.option("mergeSchema", True).parquet(self.path(table)).schema
        return known

    def _add_columns(self, found: T.StructType, table: str) -> dict[str, T.DataType]:
        """Record a batch's columns; those stored before keep their types, which are returned."""
        known = self.columns(table)
        types = {f.name: f.dataType for f in known} if known else {}
        fields = [*(known or []), *[f for f in found if f.name not in types]]
        if known is None or len(fields) > len(known) or self._schema_at(self._columns_path(table)) is None:
            union = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
            self.spark.createDataFrame([], union).coalesce(1).write.mode("overwrite").parquet(self._columns_path(table))
        return types

    def read(self, table: str) -> DataFrame:
        """A stored table with every column that any batch brought, declared columns first.

        What a batch did not bring is NULL in its rows. The columns come from the record beside
        the data, so no footer is looked at.
        """
        version = self.versions.current(table)
        known = None if version else self._schema_at(self._columns_path(table))
        if version:  # written in one go: all its files have the same columns
            df = self.spark.read.parquet(version)
        elif known is None:
            df = self.spark.read.option("mergeSchema", True).parquet(self.path(table))
        else:
            df = self.spark.read.schema(known).parquet(self.path(table))
        return align(df, table) if table in TABLES else df

    def tables(self) -> list[str]:
        return [t for t in TABLES if self.exists(t)]

    def frames(self, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
        return {t: self.read(t) for t in (names or self.tables())}

    # -- writing ---------------------------------------------------------------------

    def insert(self, batch: DataFrame, table: str, *, replace: bool = True) -> int:
        """Store a batch by the table's own rule; returns the number of rows written.

        An empty batch writes nothing.  ``replace=False`` appends.
        """
        return self.insert_counted(batch, table, replace=replace)[0]

    def insert_counted(
        self, batch: DataFrame, table: str, seasons: Iterable[int] = (), *, replace: bool = True
    ) -> tuple[int, dict[int, int]]:
        """As insert(), with the rows of each of some seasons, all counted in the one write."""
        spec = TABLES[table]
        at = datetime.now(timezone.utc).replace(tzinfo=None)
        rows = rename_reserved(batch)

        def widened(df: DataFrame) -> DataFrame:
            return align(with_audit(df, at), table)

        if spec.full_replace:
            # Only small tables are replaced as a whole; the test stops at the first row.
            if batch.isEmpty():
                return 0, {int(s): 0 for s in seasons}
            return self._write(widened(rows), spec, "switch" if replace else "extend", seasons)[::2]
        types = self._add_columns(widened(rows).schema, table)

        def whole(df: DataFrame) -> DataFrame:
            """With all declared columns; what the batch lacks is added only where the rows are written."""
            return _as_stored(widened(df), types)

        # A key column that the batch lacks is needed before.
        lacking = [k for k in spec.replace_by if k not in rows.columns]
        rows = _as_stored(rows.withColumns({k: F.lit(None).cast(spec.types[k]) for k in lacking}), types)
        if spec.replace_by and replace:
            return self._replace_partitions(rows, spec, seasons, whole)
        return self._write(rows, spec, "append", seasons, whole=whole)[::2]

    def _replace_partitions(
        self, rows: DataFrame, spec: TableSpec, seasons: Iterable[int], whole: Widen
    ) -> tuple[int, dict[int, int]]:
        """Overwrite exactly the partitions in the batch.

        Rows lacking a partition value are added, never used to replace others: their
        partition would otherwise be overwritten by each batch.  They are counted on the way,
        and the batch is read a second time only if there are any.
        """
        keyed = F.lit(True)
        for k in spec.replace_by:
            keyed = keyed & F.col(k).isNotNull()
        n, kept, by_season = self._write(rows, spec, "overwrite", seasons, keep=keyed, whole=whole)
        if n > kept:
            self._write(rows.where(~keyed), spec, "append", (), whole=whole)
        return n, by_season

    def _write(
        self, rows: DataFrame, spec: TableSpec, mode: str, seasons: Iterable[int], *,
        keep: Column | None = None, whole: Widen | None = None,
    ) -> tuple[int, int, dict[int, int]]:
        """Write rows; returns how many came, how many were kept, and how many came of each season.

        With ``keep`` only rows it holds for are written, and only their partitions replaced.
        ``whole`` adds the columns that the batch lacks, once rows are moved and sorted without them.
        Rows pass from the exchange through the sort and the counts as they are; a filter or a column
        added before would copy each of them.
        """
        seen, keys, seasons = Observation(), spec.replace_by, [int(s) for s in seasons]
        if keys:
            # Rebalance gathers a partition's rows into few files and lets adaptive execution
            # split one that is far larger than the rest.
            rows = rows.hint("rebalance", *keys)
            # In the order that the write asks for, which else would sort the whole rows.
            rows = rows.sortWithinPartitions(*keys)
        counts = [F.count(F.lit(1)).alias("n"), count_where(F.lit(True) if keep is None else keep).alias("kept")]
        if "season" in rows.columns:
            counts += [count_where(F.col("season") == s).alias(f"s{s}") for s in seasons]
        numbers = [] if keys else profiles.numbers(rows)
        # Of a table without partitions the profile is counted on the way, like the rows.
        counts += [count_where(F.col(f"`{c}`").isNull()).alias(f"null{i}") for i, c in enumerate(numbers)]
        if keys:
            counts.append(F.collect_set(F.struct(*keys)).alias("partitions"))
        # Counted on the way through; above the hint, so that an empty batch counts as 0.
        rows = rows.observe(seen, *counts)
        if mode in ("switch", "extend"):
            if mode == "extend" and self.exists(spec.name):
                rows = self.read(spec.name).unionByName(rows, allowMissingColumns=True)
            self.versions.replace(rows, spec.name)
        else:
            rows = rows if keep is None else rows.where(keep)
            writer = (rows if whole is None else whole(rows)).write.mode(mode)
            if keys:
                writer = writer.partitionBy(*keys)
            if keep is not None:
                writer = writer.option("partitionOverwriteMode", "dynamic")
            with compiled(self.spark):
                writer.parquet(self.path(spec.name))
        got = seen.get
        if keys:
            profiles.renew(self, spec.name, keys, [tuple(p) for p in got["partitions"]])
        else:
            found = {c: int(got[f"null{i}"]) for i, c in enumerate(numbers)}
            profiles.add(self, spec.name, int(got["n"]), found, anew=mode == "switch")
        return int(got["n"]), int(got["kept"]), {s: int(got.get(f"s{s}", got["n"])) for s in seasons}

    def rebuild(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        """Drop and rebuild a derived table: readers see the old rows until the new ones are whole."""
        name = self.versions.stage(df, table, tuple(partition_by))
        if self._schema_at(self.versions.folder(table, name)) is None:  # no row, so no partition and no file
            name = self.versions.stage(df, table)
        self.versions.switch(table, name)
        profiles.forget(self, table)

    def rebuild_partitions(self, df: DataFrame, table: str, key: str) -> None:
        """Replace the partitions that ``df`` has rows of, in the version in use."""
        rows = df.select(*self.spark.read.parquet(self.path(table)).columns).hint("rebalance", key)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key)
        writer.parquet(self.path(table))
        profiles.forget(self, table)

    # -- keys ----------------------------------------------------------------------------

    def known_keys(self, batch: DataFrame, table: str, keys: Sequence[str] | None = None) -> DataFrame:
        """Keys of a batch that are stored already or repeat in it: (keys, batch_rows, stored_rows).

        ``keys`` are the table's declared ones unless given. Filters kept beside the table leave
        only the partitions to read that may hold one of them; nothing is written to the table.
        """
        return keyfilters.known_keys(self, table, rename_reserved(batch), list(keys or TABLES[table].key))

    # -- refresh log -------------------------------------------------------------------

    def _log(self) -> DataFrame:
        if self.exists(LOG_TABLE):
            return self.read(LOG_TABLE)
        return self.spark.createDataFrame([], LOG_COLUMNS)

    def log_refresh(
        self, table: str, season: int, week: int | None, season_type: str, status: str,
        error_message: str | None = None, records_processed: int = 0,
    ) -> None:
        """Append one entry; its id follows the largest so far."""
        self.log_refreshes([(table, season, week, season_type, status, error_message, records_processed)])

    def log_refreshes(self, entries: Sequence[tuple]) -> None:
        """Append entries (table, season, week, season type, status, message, rows) at once, in order."""
        for entry in entries:
            if entry[4] not in REFRESH_STATUSES:
                raise ValueError(f"status must be one of {REFRESH_STATUSES}, not {entry[4]!r}")
        rows = [(i, *e[:4], None, *e[4:]) for i, e in enumerate(entries)]
        new = self.spark.createDataFrame(rows, LOG_COLUMNS).withColumn("refresh_date", F.current_timestamp())
        numbered = next_ids(self._log(), new, ["id"]).withColumn("id", F.col("id").cast("int"))
        numbered.select(*new.columns).coalesce(1).write.mode("append").parquet(self.path(LOG_TABLE))

    def last_refresh(self, table: str, season: int, week: int | None = None):
        """Time of the last successful refresh, or None."""
        return last_refresh(self._log(), table, season, week).first()["last_refresh"]

    # -- SQL -----------------------------------------------------------------------------

    def register_views(self, names: Sequence[str] | None = None) -> list[str]:
        """Temp views of the stored tables, with the column names user queries rely on."""
        names = list(names or self.tables())
        for t in names:
            df = self.read(t)
            if t == "pbp_data" and self.exists("rosters"):
                df = play_view(df, self.read("rosters"))
            elif t in VIEW_COLUMNS:
                df = repaired(df, VIEW_COLUMNS[t])
            df.createOrReplaceTempView(t)
        return names

    def query(self, sql: str, params: Sequence | None = None) -> DataFrame:
        """Run SQL over the registered views; ``?`` marks take ``params`` in order."""
        return self.spark.sql(sql, args=list(params)) if params else self.spark.sql(sql)

    def query_file(self, path: str, params: Sequence | None = None) -> list[DataFrame]:
        """Run the statements of an SQL file on any file system; one frame each, in order.

        Statements end with semicolons outside quotes and comments; ``params`` go to each.
        """
        text = self.spark.read.text(path, wholetext=True).first()
        return [self.query(sql, params) for sql in statements(text[0] if text else "")]


def statements(text: str) -> list[str]:
    """The statements of an SQL script, without those that hold comments only."""
    token = r"'(?:[^'\\]|\\.|'')*'|\"[^\"]*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|;"
    found, begin, bare = [], 0, ""
    for hit in [*re.finditer(token, text, re.DOTALL), None]:
        at = hit.start() if hit else len(text)
        bare += text[begin:at] if not hit or hit[0][:2] in ("--", "/*") or hit[0] == ";" else text[begin : hit.end()]
        begin = hit.end() if hit else at
        if not hit or hit[0] == ";":
            if bare.strip():
                found.append(bare.strip())
            bare = ""
    return found


#: Names user queries expect -> where the stored table keeps them.
VIEW_COLUMNS = {
    "weekly_stats": {"team": "recent_team"},
    "schedules": {"season_type": "game_type"},
    "injuries": {"player_name": "full_name", "injury_designation": "report_status"},
    "ecr_rankings": {"overall_rank": "rank", "season": "year"},
    "pbp_data": {"player_name": "fantasy_player_name", "team": "posteam"},
}


def repaired(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Add the expected names where the table lacks them; stored columns stay."""
    return df.withColumns({new: F.col(old) for new, old in names.items() if new not in df.columns})


def player_positions(rosters: DataFrame) -> DataFrame:
    """One position per player id over all seasons."""
    return rosters.where(F.col("player_id").isNotNull()).groupBy("player_id").agg(F.max("position").alias("position"))


def play_view(plays: DataFrame, rosters: DataFrame) -> DataFrame:
    """Plays with player name, team, position, and the touchdown flag as a boolean."""
    pos = player_positions(rosters).withColumnRenamed("player_id", "fantasy_player_id")
    named = repaired(plays, VIEW_COLUMNS["pbp_data"])
    flagged = named.withColumn("touchdown", F.col("touchdown").cast("double") == 1)
    return flagged.join(pos, "fantasy_player_id", "left")


def last_refresh(log: DataFrame, table: str, season: int, week: int | None = None) -> DataFrame:
    """One row with the time of the last successful refresh (NULL if none)."""
    hit = (F.col("table_name") == table) & (F.col("season") == season) & (F.col("status") == "SUCCESS")
    if week is not None:
        hit = hit & (F.col("week") == week)
    return log.where(hit).agg(F.max("refresh_date").alias("last_refresh"))


def export(df: DataFrame, path: str) -> None:
    """Write a result by the ending of ``path``: .csv with header, .parquet, else JSON lines.

    Files are written in parallel under ``path``.
    """
    writer = df.write.mode("overwrite")
    if path.endswith(".csv"):
        writer.option("header", True).csv(path)
    elif path.endswith(".parquet"):
        writer.parquet(path)
    else:
        writer.json(path)
