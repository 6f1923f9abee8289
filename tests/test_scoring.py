import pytest

from tallyfield.functions import scoring


def one(df):
    return df.collect()[0].asDict()


def test_builtin_systems_differ_in_receptions_only():
    systems = scoring.builtin_systems()
    assert {n: r["receptions"] for n, r in systems.items()} == {"std": 0.0, "half_ppr": 0.5, "full_ppr": 1.0}
    rest = [{k: v for k, v in r.items() if k != "receptions"} for r in systems.values()]
    assert rest[0] == rest[1] == rest[2]


def test_points_and_filled_columns(spark):
    df = spark.createDataFrame(
        [("a", 255.0, 2, None, "abc", 5)],
        "player_id string, passing_yards double, passing_tds int, interceptions double, rushing_yards string, receptions int",
    )
    r = one(scoring.score(df))
    assert r["fantasy_points_std"] == pytest.approx(255 * 0.04 + 8)
    assert r["fantasy_points_half_ppr"] == r["fantasy_points_std"] + 2.5
    assert r["fantasy_points_full_ppr"] == r["fantasy_points_std"] + 5
    # NULL and unreadable text count 0 and are stored as 0; absent stats are added as 0
    assert r["interceptions"] == 0.0 and r["rushing_yards"] == 0.0
    assert r["receiving_tds"] == 0.0 and r["fumbles_lost"] == 0.0
    assert "two_point_conversions" not in r


def test_nan_counts_as_zero(spark):
    df = spark.createDataFrame([(float("nan"), "1e2"), (10.0, " 30 ")], "rushing_yards double, receiving_yards string")
    assert [r.fantasy_points_std for r in scoring.score(df).collect()] == [10.0, 4.0]


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,)], "x double")
    got = [r[0] for r in df.select(scoring.points(df, {"x": 1.0})).collect()]
    assert got == [0.12, 0.38]


def test_derived_stats(spark):
    df = spark.createDataFrame([(1, 1.0, None, 1)], "sack_fumbles_lost int, rushing_fumbles_lost double, "
                               "receiving_fumbles_lost double, passing_2pt_conversions int")
    assert one(scoring.score(df))["fantasy_points_std"] == 0.0
    r = one(scoring.score(df, derive_missing=True))
    assert r["fumbles_lost"] == 2.0 and r["fantasy_points_std"] == -4.0 + 2.0


def test_custom_and_unknown_system(spark):
    df = spark.createDataFrame([(4, 10)], "receptions int, carries int")
    systems = scoring.with_system(scoring.builtin_systems(), "mine", {"carries": 0.5, "no_such_stat": 9.0})
    assert one(scoring.score(df, systems))["fantasy_points_mine"] == 5.0
    assert "mine" not in scoring.builtin_systems()
    assert scoring.get_system(systems, "nope") == {}
    assert one(df.select(scoring.points_for(df, "full_ppr").alias("p"), scoring.points_for(df, "nope").alias("q"))) == {
        "p": 4.0, "q": 0.0,
    }


def test_top_performers(spark):
    df = spark.createDataFrame(
        [("a", "QB", 1.0), ("b", "QB", 3.0), ("c", "WR", 9.0), ("d", "QB", None), ("e", "QB", 3.0)],
        "player_id string, position string, fantasy_points_std double",
    )
    assert [r.player_id for r in scoring.top_performers(df, "std", "QB", 3).collect()] == ["b", "e", "a"]
    assert scoring.top_performers(df, "std", top_n=1).first().player_id == "c"
    assert scoring.top_performers(df, "unknown").count() == 5


def test_compare_systems(spark):
    df = spark.createDataFrame(
        [("a", "x", 1.0, 1.5, 2.25)],
        "player_id string, other string, fantasy_points_std double, fantasy_points_half_ppr double, fantasy_points_full_ppr double",
    )
    r = one(scoring.compare_systems(df, "a"))
    assert list(r) == ["player_id", "fantasy_points_std", "fantasy_points_half_ppr", "fantasy_points_full_ppr", "ppr_advantage"]
    assert r["ppr_advantage"] == 1.25
    assert scoring.compare_systems(df, "zz").count() == 0


def test_rules_as_rows(spark):
    rows = {(r.system, r.stat): r.weight for r in scoring.rules_frame(spark).collect()}
    assert len(rows) == 30 and rows[("half_ppr", "receptions")] == 0.5 and rows[("std", "interceptions")] == -2.0
