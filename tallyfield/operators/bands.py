"""Facts in a band of time around events, without pairing the two.

``fact JOIN event ON key AND fact.at BETWEEN event.at - before AND event.at + after``, summed by
event, makes as many pairs as facts and events of a key multiply to. A sum over a band is a difference
of two running sums, though, so each event asks for four of them instead: one plan merges facts and
the events' band edges in order of time and runs once along it.

A key's time line is cut at its own quantiles. Running sums inside a cut and over the totals of a
key's cuts are two windows, so that a key with a third of all rows is spread over many tasks. Facts
of one key and time are added up first, map-side.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfield.operators.ranking import BUCKETS, bucketed
from tallyfield.session import stored

#: A key and time of facts stands between the edges that leave it out and those that take it in.
_BELOW, _FACTS, _UPTO = 0, 1, 2


def _ticks(name: str, kind: T.DataType) -> Column:
    """Time as a whole number: days of dates, microseconds of timestamps."""
    c = F.col(f"`{name}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    return F.unix_micros(c.cast("timestamp"))


def _span(length: timedelta, kind: T.DataType) -> int:
    unit = timedelta(days=1) if isinstance(kind, T.DateType) else timedelta(microseconds=1)
    if length < timedelta(0) or length % unit:
        raise ValueError(f"{length} is no whole length of a band over {kind.simpleString()}")
    return length // unit


def around(
    facts: DataFrame, events: DataFrame, keys: Sequence[str], at: str, values: Sequence[str],
    before: timedelta, after: timedelta, *, buckets: int = BUCKETS,
) -> DataFrame:
    """For each (keys, at) of the events: how many events, and facts and sums of values beside them.

    Columns: keys, at, events, facts_before, ``<value>_before``, facts_after, ``<value>_after``. Facts before
    are those in [at - before, at), facts after those in (at, at + after]; facts at the very time are in neither.
    Values are whole numbers, so that sums are exact; a NULL adds nothing, and a sum over no fact is 0. Rows
    with a NULL key or time take no part. Both sides have times of the same type.
    """
    kind = events.schema[at].dataType
    if facts.schema[at].dataType != kind:
        raise ValueError(f"{at} is {facts.schema[at].dataType.simpleString()} in facts, {kind.simpleString()} in events")
    back, ahead = _span(before, kind), _span(after, kind)
    names = [f"_k{i}" for i in range(len(keys))]
    sums = ["_n", *[f"_s{i}" for i in range(len(values))]]

    def keyed(df: DataFrame, *more: Column) -> DataFrame:
        own = [F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)]
        return df.select(*own, _ticks(at, kind).alias("_v"), *more).dropna(subset=[*names, "_v"])

    amounts = keyed(facts, *[F.col(f"`{v}`").cast("bigint").alias(s) for v, s in zip(values, sums[1:])])
    added = amounts.groupBy(*names, "_v").agg(
        F.count(F.lit(1)).alias("_n"), *[F.coalesce(F.sum(s), F.lit(0)).cast("bigint").alias(s) for s in sums[1:]]
    )
    line = added.select(*names, "_v", F.lit(_FACTS).alias("_o"), F.lit(None).cast("int").alias("_edge"),
                        F.lit(None).cast("bigint").alias("_at"), F.lit(0).cast("bigint").alias("_events"), *sums)

    edges = [(F.col("_v") - back, _BELOW), (F.col("_v"), _BELOW), (F.col("_v"), _UPTO), (F.col("_v") + ahead, _UPTO)]
    four = F.array(*[F.struct(v.alias("_v"), F.lit(o).alias("_o"), F.lit(i).alias("_edge")) for i, (v, o) in enumerate(edges)])
    asked = keyed(events).groupBy(*names, "_v").agg(F.count(F.lit(1)).alias("_events"))
    asked = asked.select(*names, F.col("_v").alias("_at"), "_events", F.explode(four).alias("e"))
    asked = asked.select(*names, "e.*", "_at", "_events", *[F.lit(0).cast("bigint").alias(s) for s in sums])

    placed = bucketed(stored(line.unionByName(asked)), names, buckets)
    cut = [*names, "_place"]
    inside = Window.partitionBy(*cut).orderBy("_v", "_o").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*names).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*cut).agg(*[F.sum(s).alias(s) for s in sums])
    carried = totals.select(*cut, *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"_c{s}") for s in sums])
    ran = placed.select(*cut, "_edge", "_at", "_events", *[F.sum(s).over(inside).alias(s) for s in sums])
    upto = ran.where(F.col("_edge").isNotNull()).join(carried, cut)

    def between(s: str, low: int, high: int) -> Column:
        total = F.col(s) + F.col(f"_c{s}")
        return F.sum(F.when(F.col("_edge") == high, total).when(F.col("_edge") == low, -total))

    sides = [(side, low, low + 1) for side, low in (("before", 0), ("after", 2))]
    bands = upto.groupBy(*names, "_at").agg(
        F.max("_events").alias("events"),
        *[between(s, low, high).alias(f"{v}_{side}") for side, low, high in sides for v, s in zip(["facts", *values], sums)],
    )
    if isinstance(kind, T.DateType):
        when = F.date_from_unix_date(F.col("_at").cast("int"))
    elif isinstance(kind, T.TimestampNTZType):
        when = F.timestamp_add("MICROSECOND", F.col("_at"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    else:
        when = F.timestamp_micros("_at")
    own = [F.col(n).alias(k) for n, k in zip(names, keys)]
    return bands.select(*own, when.alias(at), *bands.columns[len(names) + 1 :])
