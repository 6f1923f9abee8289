"""Rows with cells that did not convert, kept beside the tables they were loaded into.

A load turns such a cell into NULL and keeps the row. With the quarantine each of these rows is also
kept as it landed, with its lost cells and why they were lost. The landed files are read once: one
pass types the rows, names their lost cells and writes both to the scratch folder; the table takes
the typed columns from there, the quarantine the rows with lost cells, if the pass counted any.

The quarantine is written before the table, so no cell is lost unseen; a load that fails after it
may leave rejects behind, under a load id of its own. Rows whose season cannot be read belong to no
season that was asked for: they are in the quarantine alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyfield.functions.scoring import score
from tallyfield.functions.typing import rejects, typed_columns
from tallyfield.schemas import TABLES
from tallyfield.session import stored
from tallyfield.sources.landing import Landing

if TYPE_CHECKING:
    from tallyfield.sources.warehouse import Warehouse

CELLS = "array<struct<column: string, reason: string, text: string>>"
QUARANTINE = f"load_id string, loaded_at timestamp, landed string, cells {CELLS}"

_CELLS, _LANDED = "_rejected_cells", "_landed_row"


def _folder(store: Warehouse, table: str) -> str:
    return f"{store.root}/_quarantine/{table}"


def checked(landed: DataFrame, table: str) -> DataFrame:
    """Typed rows with their lost cells, and the row as JSON where there are any."""
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in landed.columns]), {"ignoreNullFields": "false"})
    found = landed.withColumn(_CELLS, rejects(landed, table))
    return found.select(*typed_columns(landed, table), _CELLS, F.when(F.size(_CELLS) > 0, whole).alias(_LANDED))


def insert_checked(store: Warehouse, landing: Landing, table: str, seasons: Sequence[int] = ()) -> tuple[int, dict[int, int]]:
    """As Warehouse.insert_counted() on what Landing.read() gives, keeping the rows with lost cells."""
    seen = Observation()
    landed = landing.landed(table, seasons or None)
    once = stored(checked(landed, table).observe(seen, F.count_if(F.size(_CELLS) > 0).alias("rejected")))
    if seen.get["rejected"]:
        lost = once.where(F.size(_CELLS) > 0).select(
            F.lit(uuid.uuid4().hex).alias("load_id"),
            F.lit(datetime.now(timezone.utc).replace(tzinfo=None)).cast("timestamp").alias("loaded_at"),
            F.col(_LANDED).alias("landed"), F.col(_CELLS).alias("cells"),
        )
        lost.write.mode("append").parquet(_folder(store, table))
    rows = once.drop(_CELLS, _LANDED)
    if seasons and TABLES[table].by_season and "season" in rows.columns:
        rows = rows.where(F.col("season").isin([int(s) for s in seasons]))
    return store.insert_counted(score(rows) if TABLES[table].scored else rows, table, seasons)


def rows(store: Warehouse, table: str) -> DataFrame:
    """(load_id, loaded_at, landed, cells) of each row kept, of all loads; empty where none was."""
    kept = store._schema_at(_folder(store, table))
    if kept is None:
        return store.spark.createDataFrame([], QUARANTINE)
    return store.spark.read.schema(QUARANTINE).parquet(_folder(store, table))


def cells(store: Warehouse, table: str) -> DataFrame:
    """One row a lost cell: (load_id, loaded_at, landed, column, reason, text)."""
    one = rows(store, table).withColumn("cell", F.explode("cells"))
    return one.select("load_id", "loaded_at", "landed", "cell.*")


def report(store: Warehouse, tables: Sequence[str]) -> DataFrame:
    """Lost cells by table, load, column and reason, with the smallest text as an example."""
    out = None
    for table in tables:
        counted = cells(store, table).groupBy("load_id", "loaded_at", "column", "reason").agg(
            F.count(F.lit(1)).alias("cells"), F.min("text").alias("example")
        )
        counted = counted.select(F.lit(table).alias("table_name"), *counted.columns)
        out = counted if out is None else out.unionByName(counted)
    return out
