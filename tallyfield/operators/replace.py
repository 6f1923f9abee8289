"""Replace semantics as frames: what a stored table holds after a batch arrives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def replace_rows(existing: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` without the key values present in ``batch``, plus ``batch``.

    The keys are load units (season, week), few enough for adaptive execution to broadcast them
    once it has measured them; the stored rows then stay where they are.  Rows with a NULL key are never
    replaced.  Columns are matched by name; a new one is NULL in earlier rows.
    """
    arriving = batch.select(*keys).dropna().distinct()
    survivors = existing.join(arriving, list(keys), "left_anti")
    return survivors.unionByName(batch, allowMissingColumns=True)


def next_ids(log: DataFrame, new: DataFrame, order: Sequence[str], id_col: str = "id") -> DataFrame:
    """Number ``new`` log rows onward from the largest id in ``log``.

    ``new`` is one row per finished table load (tables x seasons), so its numbering may sit
    in a single window.
    """
    start = log.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint")).scalar()
    at = F.row_number().over(Window.orderBy(*order))
    return new.select((start + at).alias(id_col), *[c for c in new.columns if c != id_col])
