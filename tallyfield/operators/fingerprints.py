"""Has anything changed? Fingerprints of groups of rows that do not depend on the rows' order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.schemas import AUDIT_COLUMNS

#: Bits of a row hash that are summed together: no sum overflows below 2 ** 41 rows.
SUMMED_BITS = 22


def row_hash(columns: list[str]) -> Column:
    """A hash of a row in which a value's column counts, also if others are NULL."""
    return F.xxhash64(*[F.xxhash64(F.lit(i), F.col(f"`{c}`")) for i, c in enumerate(columns)])


def fingerprints(df: DataFrame, group: str) -> DataFrame:
    """(season, columns, n, sum_0, sum_1, sum_2, folded) of each group: a multiset hash of its rows.

    Rows may come in any order and any number of files; repeated rows count as often as they come.
    Columns are taken by name, and when rows were loaded does not matter. The sums and the exclusive
    or combine map-side.
    """
    columns = sorted(c for c in df.columns if c not in (*AUDIT_COLUMNS, group))
    hashed = df.select(F.col(group).cast("int").alias("season"), row_hash(columns).alias("h"))
    mask = (1 << SUMMED_BITS) - 1
    sums = [
        F.sum(F.shiftrightunsigned("h", SUMMED_BITS * i).bitwiseAND(F.lit(mask).cast("long"))).alias(f"sum_{i}") for i in range(3)
    ]
    return hashed.groupBy("season").agg(F.count(F.lit(1)).alias("n"), *sums, F.bit_xor("h").alias("folded")).select(
        "season", F.lit(",".join(columns)).alias("columns"), "n", "sum_0", "sum_1", "sum_2", "folded"
    )


def input_fingerprints(inputs: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Fingerprints of several inputs, each given with its grouping column."""
    parts = [fingerprints(df, group).withColumn("input", F.lit(name)) for name, (df, group) in inputs.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def changed_groups(before: DataFrame, now: DataFrame) -> DataFrame:
    """Seasons of which an input differs, was added or has gone; NULL is a season of its own."""
    return before.exceptAll(now).unionByName(now.exceptAll(before)).select("season").distinct()
