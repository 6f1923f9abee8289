"""One key holding a third of all rows or more: results stay whole and right."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyfield.operators import matching
from tallyfield.operators.quality import repeated_rows
from tallyfield.operators.ranking import rank_within
from tallyfield.plans import queries as q


@pytest.fixture()
def shuffled(spark):
    """No broadcasts, tiny skew thresholds: joins are sort-merge and get split."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rank_with_a_hot_value(shuffled):
    df = shuffled.range(30000).select(
        F.col("id").cast("string").alias("player_id"), F.lit(2020).alias("season"),
        F.when(F.col("id") % 3 > 0, "WR").otherwise("QB").alias("position"),
        F.when(F.col("id") % 2 == 0, 0.0).otherwise((F.col("id") * 37 % 10007) / 100).alias("v"),
    )
    got = rank_within(df, ["season", "position"], {"a": F.col("v"), "b": -F.col("v")}, row_key=["player_id"])
    w = Window.partitionBy("season", "position")
    bad = got.withColumn("x", F.rank().over(w.orderBy(F.desc("v")))).withColumn("y", F.rank().over(w.orderBy("v")))
    assert got.count() == 30000
    assert bad.where("a <> x OR b <> y OR a IS NULL OR b IS NULL").count() == 0


def test_match_with_a_hot_name(shuffled):
    raw = shuffled.range(20000).select(
        (F.lit(2000) + F.col("id") % 20).cast("int").alias("year"), F.lit(True).alias("before_preseason"),
        F.when(F.col("id") % 2 == 0, "A.J. Hot").otherwise(F.concat(F.lit("p "), (F.col("id") % 500).cast("string"))).alias("player_name"),
        F.lit("WR").alias("position"), F.col("id").cast("double").alias("rank"), F.lit(1.0).alias("adp"),
    )
    roster = shuffled.range(5000).select(
        F.col("id").cast("string").alias("player_id"),
        F.when(F.col("id") % 2 == 0, "AJ Hot").otherwise(F.concat(F.lit("P "), (F.col("id") % 400).cast("string"))).alias("player_name"),
        F.lit("WR").alias("position"),
    )
    got = matching.link_players(raw, roster).groupBy("player_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("player_id").alias("ids"), F.min("player_id").alias("id"),
        F.min("match_type").alias("kind"),
    )
    rows = {r.player_name: r for r in got.collect()}
    assert (rows["A.J. Hot"].n, rows["A.J. Hot"].id, rows["A.J. Hot"].kind) == (10000, "0", "partial_match")
    assert all(r.ids == 1 for r in rows.values())
    assert rows["p 399"].kind == "exact_match" and rows["p 399"].n == 40
    assert rows["p 411"].kind == "partial_match" and "p 401" not in rows


def test_injuries_of_a_hot_player(shuffled):
    weekly = shuffled.range(3000).select(
        F.lit("hot").alias("player_name"), F.lit("QB").alias("position"), F.lit("T").alias("team"),
        F.lit(2020).alias("season"), (F.col("id") % 18 + 1).cast("int").alias("week"),
        ((F.col("id") * 7919 % 3001) / 100).alias("fantasy_points_std"),
    )
    injuries = shuffled.range(2000).select(
        F.lit("hot").alias("player_name"), F.lit(2020).alias("season"), (F.col("id") % 17 + 1).cast("int").alias("week"),
        F.when(F.col("id") % 5 == 0, "Healthy").otherwise("Out").alias("injury_designation"),
    )
    r = q.injury_impact(weekly, injuries, 2020).first()
    pairs = weekly.alias("w").join(injuries.alias("i"), "player_name").where("injury_designation <> 'Healthy'")
    want = pairs.agg(
        F.count_if(F.expr("w.week < i.week")).alias("pre"), F.count_if(F.expr("w.week > i.week")).alias("post"),
        F.avg(F.expr("CASE WHEN w.week < i.week THEN fantasy_points_std END")).alias("pre_avg"),
    ).first()
    assert (r.pre_injury_games, r.post_injury_games) == (want.pre, want.post)
    assert r.pre_injury_avg == pytest.approx(want.pre_avg)


def test_repeats_of_a_hot_row(shuffled):
    df = shuffled.range(9000).select(F.when(F.col("id") % 3 > 0, -1).otherwise(F.col("id")).alias("k"), F.lit("x").alias("s"))
    assert repeated_rows(df).first()[0] == 5999
