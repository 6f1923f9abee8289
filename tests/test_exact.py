"""Sums and spreads that do not depend on the order of rows."""

import random
import statistics
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallyfield.functions.exact import avg2, stddev2, sum2


def spreads(df):
    out = df.groupBy("k").agg(stddev2(F.col("x")).alias("s"), avg2(F.col("x")).alias("a"), sum2(F.col("x")).alias("t"))
    return {r["k"]: (r["s"], r["a"], r["t"]) for r in out.collect()}


def test_same_bits_for_any_partitioning(spark):
    draw = random.Random(2)
    rows = [(draw.randrange(3), round(draw.uniform(-900, 90000), 2)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "k int, x double")
    first = spreads(df.repartition(1))
    for many in (7, 200):
        for seed in (1, 2):
            assert spreads(df.orderBy(F.rand(seed)).repartition(many)) == first
    for k, (spread, _, _) in first.items():
        exact = statistics.variance([Fraction(round(x * 100), 100) for key, x in rows if key == k])
        assert spread == pytest.approx(float(exact) ** 0.5, rel=1e-15)


def test_few_and_missing_and_large_values(spark):
    rows = [(1, 5.0), (2, None), (3, 4.0), (3, None), (3, 4.0), (4, 1e13), (4, 1e13 + 0.01), (5, -2.0), (5, 2.0)]
    got = spreads(spark.createDataFrame(rows, "k int, x double"))
    assert got[1][0] is None and got[2] == (None, None, None) and got[3][0] == 0.0
    assert got[4][0] == pytest.approx(0.01 / 2**0.5, rel=1e-12)  # plain doubles would lose it all
    assert got[5][0] == pytest.approx(8**0.5)


def test_years_are_counted_by_bitmaps(spark):
    from tallyfield.plans import ranks

    draw = random.Random(4)
    schema = "year int, before_preseason boolean, player_name string, position string, rank double, avg_rank double"
    # Years on both sides of a bucket's edge, negative ones, NULLs and repeats.
    years = [None, -40000, -1, 0, 1, 32767, 32768, 32769, 65536, 2015, 2016]
    rows = [(draw.choice(years), draw.choice([True, False, None]), draw.choice(["a", "", None]), "QB", 1.0, None) for _ in range(300)]
    for some in (rows, rows[:1], []):
        df = ranks.verify(spark.createDataFrame(some, schema))
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()
        got = df.first()
        assert got["total_records"] == len(some) and got["missing_avg_ranks"] == len(some)
        for name, want in (
            ("unique_years", {r[0] for r in some}), ("years_with_prepreseason", {r[0] for r in some if r[1] is True}),
            ("years_with_preseason", {r[0] for r in some if r[1] is False}),
        ):
            assert got[name] == len(want - {None}), name
