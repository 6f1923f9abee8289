"""Landing data: one folder per table, in any format Spark reads.

    <root>/<table>/...        parquet (default), orc, csv with a header, or json lines

CSV and JSON are read as text and typed by the declared schema afterwards, so there is no
inference pass and a bad cell costs its value, not its row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfield.functions.scoring import score
from tallyfield.functions.typing import is_missing, rename_reserved, to_int, typed
from tallyfield.schemas import RESERVED_RENAMES, TABLES

#: More partitions than any scan has.
ALL_PARTITIONS = 2**31 - 1


@dataclass(frozen=True)
class Landing:
    """``extra_columns`` names the undeclared columns to take from JSON, by table, and so saves
    the pass over the data that collects them; the other formats say which columns they have."""

    spark: SparkSession
    root: str
    format: str = "parquet"
    extra_columns: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def raw(self, table: str) -> DataFrame:
        reader = self.spark.read.format(self.format)
        if self.format == "csv":
            reader = reader.option("header", True).option("inferSchema", False)
        elif self.format == "json":
            landed_as = {new: old for old, new in RESERVED_RENAMES.items()}
            names = [landed_as.get(c, c) for c in TABLES[table].types]
            # JSON rows name their own columns: without a list of them, one pass collects the names.
            more = self.extra_columns.get(table)
            if more is None:
                path = f"{self.root.rstrip('/')}/{table}"
                more = self.spark.read.option("primitivesAsString", True).json(path).columns
            names += [n for n in more if n not in names and n != "_corrupt_record"]
            reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
        return reader.load(f"{self.root.rstrip('/')}/{table}")

    def read(
        self, table: str, seasons: Iterable[int] | None = None, week: int | None = None
    ) -> DataFrame:
        """Typed rows of ``table``, scored where the table carries points.

        The season filter stands on the stored column, so a season-partitioned landing folder
        is pruned and a Parquet scan gets it pushed down.
        """
        df = self.raw(table)
        spec = TABLES[table]
        if seasons is not None and spec.by_season and "season" in df.columns:
            df = df.where(_whole_number(df, "season").isin([int(s) for s in seasons]))
        if week is not None and "week" in df.columns:
            df = df.where(_whole_number(df, "week") == int(week))
        if seasons is not None or week is not None:
            # Merges no partitions. It parts the filter from the conversions, whose code in one method with the
            # scan's takes the JVM seconds to compile, while every row of the folder passes uncompiled.
            df = df.coalesce(ALL_PARTITIONS)
        df = typed(rename_reserved(df), table)
        return score(df) if spec.scored else df

    def landed(self, table: str, seasons: Iterable[int] | None = None) -> DataFrame:
        """Rows as they landed, of some seasons and of none that can be read."""
        df = self.raw(table)
        if seasons is not None and TABLES[table].by_season and "season" in df.columns:
            season = _whole_number(df, "season")
            unread = season.isNull() & ~is_missing(F.col("season"))
            df = df.where(season.isin([int(s) for s in seasons]) | unread)
        return rename_reserved(df)


def _whole_number(df: DataFrame, name: str) -> Column:
    """The column itself if it holds numbers, so that filters reach the scan; text is parsed."""
    kind = df.schema[name].dataType
    return F.col(name) if isinstance(kind, T.NumericType) else to_int(name, kind)
