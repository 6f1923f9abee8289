"""Profiles of stored tables, kept beside them and renewed by each load.

A profile row holds the number of rows of one partition and the NULLs of each numeric column. Rows
of a table without partitions are counted while they are written. Of a partitioned table the write
reports which partitions it touched, and those alone are counted again, so that the profile is
right whatever was replaced or appended. Profile rows add up: the reports sum them and read no data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.operators.quality import count_where
from tallyfield.operators.quality import numeric_columns as numbers

if TYPE_CHECKING:
    from tallyfield.sources.warehouse import Warehouse

PROFILE = "season int, week int, row_count bigint, nulls map<string, bigint>"


def _name(table: str) -> str:
    return f"profile-{table}"


def partition_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A profile row for each partition of a frame."""
    columns = numbers(df)
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"), *[count_where(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(columns)]
    )
    pairs = [cell for i, c in enumerate(columns) for cell in (F.lit(c), F.col(f"_{i}"))]
    nulls = F.create_map(*pairs) if pairs else F.create_map().cast("map<string, bigint>")
    key = {k: F.col(k).cast("int") if k in keys else F.lit(None).cast("int") for k in ("season", "week")}
    return counted.select(key["season"].alias("season"), key["week"].alias("week"), "row_count", nulls.alias("nulls"))


def inside(keys: Sequence[str], partitions: Iterable[Sequence]) -> Column:
    """Whether a row lies in one of some partitions; literals, so that other partitions are not read."""
    weeks: dict[object, list] = {}
    for partition in partitions:
        weeks.setdefault(partition[0], []).append(partition[1] if len(partition) > 1 else None)
    some = []
    for first, rest in weeks.items():
        hit = F.col(keys[0]).eqNullSafe(F.lit(first))
        if len(keys) > 1:
            known = [w for w in rest if w is not None]
            second = F.col(keys[1]).isin(known) if known else F.lit(False)
            if None in rest:
                second = second | F.col(keys[1]).isNull()
            hit = hit & F.coalesce(second, F.lit(False))
        some.append(hit)
    return reduce(Column.__or__, some, F.lit(False))


def stored(store: Warehouse, table: str) -> DataFrame | None:
    """A table's profile rows; None if it has none."""
    folder = store.versions.current(_name(table))
    return store.spark.read.schema(PROFILE).parquet(folder) if folder else None


def _put(store: Warehouse, table: str, rows: DataFrame) -> None:
    store.versions.replace(rows.coalesce(1), _name(table))


def renew(store: Warehouse, table: str, keys: Sequence[str], partitions: Sequence[Sequence]) -> None:
    """Count the touched partitions again; a table stored without a profile is counted as a whole."""
    if not partitions:
        return
    known, rows = stored(store, table), store.read(table)
    if known is None:
        return _put(store, table, partition_rows(rows, keys))
    touched = inside(keys, partitions)
    return _put(store, table, known.where(~touched).unionByName(partition_rows(rows.where(touched), keys)))


def add(store: Warehouse, table: str, n: int, nulls: Mapping[str, int], *, anew: bool) -> None:
    """The profile of rows just written to a table without partitions."""
    row = store.spark.createDataFrame([(None, None, n, dict(nulls))], PROFILE)
    known = None if anew else stored(store, table)
    _put(store, table, row if known is None else known.unionByName(row))


def forget(store: Warehouse, table: str) -> None:
    """A table that was written by other means has no profile until it is counted again."""
    if store.versions.current(_name(table)):
        _put(store, table, store.spark.createDataFrame([], PROFILE))


def of(store: Warehouse, table: str) -> DataFrame:
    """Profile rows of a table; counted now, and kept, where there are none."""
    known = stored(store, table)
    if known is None or known.isEmpty():
        rows = store.read(table)
        _put(store, table, partition_rows(rows, [k for k in ("season", "week") if k in rows.columns][:2]))
        known = stored(store, table)
    return known
