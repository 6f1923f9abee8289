import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyfield.operators.ranking import bucketed, rank_within


def frame(spark, n=800, seed=3):
    rnd = random.Random(seed)
    special = [None, float("nan"), 0.0, -0.0, 1e9, -350.25, float("inf"), float("-inf"), 1e300]
    rows = []
    for i in range(n):
        g = rnd.choice(["a", "a", "a", "b", None])
        v = rnd.choice(special) if rnd.random() < 0.4 else round(rnd.uniform(-500, 900), 2)
        w = float(rnd.randrange(5))
        rows.append((i % 300, g, v, w))
    return spark.createDataFrame(rows, "id int, g string, v double, w double")


def expected(df, measures, method, descending):
    out = df
    for name, c in measures.items():
        order = F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last()
        fn = F.rank if method == "rank" else F.dense_rank
        out = out.withColumn(name, fn().over(Window.partitionBy("g").orderBy(order)).cast("bigint"))
    return out


def same(a, b):
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.select(a.columns).collect()))


@pytest.mark.parametrize("method", ["rank", "dense_rank"])
@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("buckets", [2, 128])
def test_one_measure_equals_window(spark, method, descending, buckets):
    df = frame(spark)
    got = rank_within(df, ["g"], {"r": F.col("v")}, method=method, descending=descending, buckets=buckets)
    same(got, expected(df, {"r": "v"}, method, descending))


def test_many_measures_with_repeated_rows(spark):
    df = frame(spark)
    df = df.unionAll(df)
    got = rank_within(df, ["g"], {"r": F.col("v"), "s": F.col("w")}, row_key=["id"])
    same(got, expected(df, {"r": "v", "s": "w"}, "rank", True))


def test_only_limits_the_field(spark):
    df = frame(spark)
    got = rank_within(df, ["g"], {"r": F.col("v"), "s": F.col("w")}, only=F.col("g") == "a", row_key=["id"])
    assert got.where("g IS NULL OR g <> 'a'").where("r IS NOT NULL OR s IS NOT NULL").count() == 0
    same(got.where("g = 'a'"), expected(df.where("g = 'a'"), {"r": "v", "s": "w"}, "rank", True))


def test_no_window_spans_a_whole_group(spark):
    """The rows themselves never meet in a window over the group, only value counts do."""
    df = frame(spark)
    plan = rank_within(df, ["g"], {"r": F.col("v")})._jdf.queryExecution().optimizedPlan().toString()
    windows = [ln for ln in plan.splitlines() if "Window [" in ln]
    assert len(windows) == 2 and not any("rank(" in w for w in windows)


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        rank_within(frame(spark), ["g"], {"r": F.col("v")}, method="ntile")


@pytest.mark.parametrize("spread", ["rand(3)", "pow(10, rand(3) * 12)"])
def test_buckets_follow_the_values(spark, spread):
    hist = spark.range(20000).selectExpr("'a' AS g", f"{spread} AS _v", "1L AS _n")
    sizes = [r["count"] for r in bucketed(hist, ["g"]).groupBy("_place").count().collect()]
    assert max(sizes) < 20000 / 50
