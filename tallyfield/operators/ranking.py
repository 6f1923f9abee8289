"""RANK / DENSE_RANK inside a few very large groups, without one task per group.

A plain window over (season, position) sends a whole group to one task and there are only a
handful of groups, so a cluster would sit idle behind them.  A rank only depends on how many
rows hold a larger value, so we work on the histogram of values instead:

1. count rows per (group, value): combined map-side, so a value shared by a third of all
   rows travels as one row per task;
2. cut each group's distinct values into buckets at their own quantiles; running counts inside
   a bucket and over the bucket totals are two small windows, whatever the values' spread;
3. join rank-per-value back on (group, value).

The number of buckets is a tuning knob only: any boundaries give the same ranks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 128

# Buckets outside every real one: NULL always comes last, NaN above every number.
_EDGE = 2**62


def _same(pairs: Mapping[str, str]) -> Column:
    """Join condition over column pairs, NULL equal to NULL."""
    return F.expr(" AND ".join(f"`{a}` <=> `{b}`" for a, b in pairs.items()))


def bucketed(hist: DataFrame, groups: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Adds ``_place``: how many of its group's quantiles of distinct values a value has reached."""
    steps = ", ".join(repr(i / buckets) for i in range(1, buckets))
    number = "CASE WHEN NOT isnan(_v) THEN _v END"
    cuts = hist.groupBy(*groups).agg(F.expr(f"percentile_approx({number}, array({steps}))").alias("_cuts"))
    cuts = cuts.withColumnsRenamed({g: f"_c_{g}" for g in groups})
    place = "CAST(coalesce(size(filter(_cuts, c -> c <= _v)), 0) AS BIGINT) AS _place"
    return hist.join(cuts, _same({g: f"_c_{g}" for g in groups})).selectExpr(*hist.columns, place)


def _rank_of_values(
    hist: DataFrame, groups: Sequence[str], *, buckets: int, method: str, descending: bool
) -> DataFrame:
    """``hist`` holds one row per (groups, _v) with a count _n; adds ``_rank``."""
    order = "DESC NULLS LAST" if descending else "ASC NULLS LAST"
    null_bucket = -_EDGE if descending else _EDGE + 1
    keyed = bucketed(hist, groups, buckets).selectExpr(
        "*",
        f"CASE WHEN _v IS NULL THEN {null_bucket}L WHEN isnan(_v) THEN {_EDGE}L ELSE _place END AS _b",
        f"{'_n' if method == 'rank' else '1L'} AS _w",
    )
    by = ", ".join(f"`{g}`" for g in groups)

    def before(what: str, partition: str, along: str) -> str:
        return (
            f"coalesce(sum({what}) OVER (PARTITION BY {partition} ORDER BY {along} {order} "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)"
        )

    inside = keyed.selectExpr("*", f"{before('_w', f'{by}, _b', '_v')} AS _inside")
    across = (
        keyed.groupBy(*groups, "_b").agg(F.sum("_w").alias("_w"))
        .selectExpr(*[f"`{g}` AS `_o_{g}`" for g in groups], "_b AS _o_b", f"{before('_w', by, '_b')} AS _across")
    )
    return inside.join(across, _same({**{g: f"_o_{g}" for g in groups}, "_b": "_o_b"})).selectExpr(
        *[f"`{g}`" for g in groups], "_v", "_inside + _across + 1 AS _rank"
    )


def rank_within(
    df: DataFrame,
    groups: Sequence[str],
    measures: Mapping[str, Column],
    *,
    method: str = "rank",
    descending: bool = True,
    buckets: int = BUCKETS,
    row_key: Sequence[str] = (),
    only: Column | None = None,
) -> DataFrame:
    """Add one bigint rank column per entry of ``measures`` (name -> numeric column).

    NULLs rank last.  Ranks depend on the group and the values alone, so rows repeated in
    ``df`` are safe.  ``row_key`` columns only spread the join back: with them a combination
    of values shared by many rows does not meet in one shuffle partition.  ``only`` limits which
    rows take part; the others get NULL.
    """
    if method not in ("rank", "dense_rank"):
        raise ValueError(f"unknown ranking method: {method}")
    groups = list(groups)
    opts = dict(buckets=buckets, method=method, descending=descending)
    names = list(measures)
    vals = [f"_m{i}" for i in range(len(names))]
    tagged = df.withColumns({v: measures[n].cast("double") for v, n in zip(vals, names)})

    taking_part = tagged if only is None else tagged.where(only)

    if len(names) == 1:
        hist = taking_part.groupBy(*groups, F.col(vals[0]).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        ranks = _rank_of_values(hist, groups, **opts).selectExpr(
            *[f"`{g}` AS `_r_{g}`" for g in groups], f"_v AS _r_{vals[0]}", f"_rank AS `{names[0]}`"
        )
        return _join_back(df, tagged, ranks, groups, vals, names)

    # Several measures: one histogram for all of them, told apart by the measure number.
    keys = [*row_key, *groups, *vals]
    narrow = taking_part.select(*keys)
    unpivot = f"posexplode(array({', '.join(vals)})) AS (_m, _v)"
    hist = narrow.selectExpr(*groups, unpivot).groupBy(*groups, "_m", "_v").agg(F.count(F.lit(1)).alias("_n"))
    by = _rank_of_values(hist, [*groups, "_m"], **opts).withColumnsRenamed(
        {c: f"_h_{c}" for c in (*groups, "_m", "_v")}
    )
    # A left join, though every value is found: it leaves only the value ranks, never the
    # stacked rows, as a side that may be broadcast.
    ranks = (
        narrow.distinct().selectExpr(*keys, unpivot)
        .join(by, _same({c: f"_h_{c}" for c in (*groups, "_m", "_v")}), "left")
        .groupBy(*keys)
        .agg(*[F.expr(f"max(CASE WHEN _m = {i} THEN _rank END)").alias(n) for i, n in enumerate(names)])
        .withColumnsRenamed({k: f"_r_{k}" for k in keys})
    )
    return _join_back(df, tagged, ranks, [*row_key, *groups], vals, names)


def _join_back(
    df: DataFrame, tagged: DataFrame, ranks: DataFrame, keys: list[str], vals: list[str], names: list[str]
) -> DataFrame:
    on = _same({k: f"_r_{k}" for k in [*keys, *vals]})
    return tagged.join(ranks, on, "left").drop(*vals, *[f"_r_{k}" for k in [*keys, *vals]])
