"""Landing files to season summary, end to end."""

import pytest
from pyspark.sql import functions as F

from tallyfield.plans import refresh, reports
from tallyfield.schemas import LOAD_TABLES
from tallyfield.sources.landing import Landing
from tallyfield.sources.warehouse import Warehouse

PLAYERS = [("p1", "Al One", "QB"), ("p2", "Bo Two", "WR"), ("p3", "Cy Three", "WR"), ("p4", "Di Four", "LB")]


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")

    def put(table, rows, schema, fmt="parquet"):
        spark.createDataFrame(rows, schema).write.format(fmt).option("header", True).save(str(root / table))

    put("teams", [("KC", "Team K", "West")], "team_abbr string, team_name string, team_division string")
    put("players", [(p, n, pos) for p, n, pos in PLAYERS], "gsis_id string, display_name string, position string")
    put("schedules", [(f"g{s}{w}", s, "REG", w, "KC", 20, "SF", 10) for s in (2021, 2022) for w in (1, 2)],
        "game_id string, season bigint, game_type string, week bigint, home_team string, home_score bigint, away_team string, away_score bigint")
    put("pbp_data", [("g1", "1", s, "a pass", 1.0) for s in (2021, 2022)],
        "game_id string, play_id string, season int, desc string, touchdown double")
    put("weekly_stats", [(p, n, pos, s, w, 100.0 * w, 1) for p, n, pos in PLAYERS for s in (2021, 2022) for w in (1, 2)],
        "player_id string, player_name string, position string, season int, week int, receiving_yards double, receptions int")
    put("seasonal_stats", [(p, s, "REG", 100.0 * (i + 1), 10, 2 if i else 0) for i, (p, _, _) in enumerate(PLAYERS) for s in (2021, 2022)],
        "player_id string, season int, season_type string, receiving_yards double, receptions int, games int")
    put("rosters", [(p, n, pos, s, w, "KC", 2021) for p, n, pos in PLAYERS for s in (2021, 2022) for w in (1, 2)],
        "player_id string, player_name string, position string, season int, week int, team string, rookie_year int")
    put("injuries", [(2021, 1, "Al One", "Out")], "season int, week int, full_name string, report_status string")
    return Landing(spark, str(root))


@pytest.fixture(scope="module")
def store(spark, landing, tmp_path_factory):
    w = Warehouse(spark, str(tmp_path_factory.mktemp("store")))
    w.loaded = refresh.extract_all(w, landing, [2021, 2022])
    return w


def test_extract_all(store):
    assert store.loaded == {
        "teams": 1, "players": 4, "schedules": 4, "pbp_data": 2, "weekly_stats": 16, "seasonal_stats": 8, "rosters": 16, "injuries": 1,
    }
    assert set(store.loaded) == set(LOAD_TABLES)
    w = store.read("weekly_stats").where("player_id = 'p2' AND season = 2021 AND week = 2").first()
    assert (w.fantasy_points_std, w.fantasy_points_half_ppr, w.fantasy_points_full_ppr) == (20.0, 20.5, 21.0)
    assert store.read("pbp_data").first().play_description == "a pass"


def test_reload_does_not_duplicate(store, landing):
    assert refresh.refresh_season(store, landing, 2021, ["weekly_stats", "rosters"]) == {"weekly_stats": 8, "rosters": 8}
    assert refresh.refresh_week(store, landing, 2022, 1) == 4
    assert refresh.refresh_week(store, landing, 2022, 9) == 0
    assert store.read("weekly_stats").count() == 16 and store.read("rosters").count() == 16
    assert store.last_refresh("weekly_stats", 2022, 1) is not None


def test_failed_table_does_not_stop_the_rest(spark, store, landing):
    broken = Landing(spark, landing.root + "/nowhere")
    assert refresh.refresh_season(store, broken, 2021, ["injuries"]) == {"injuries": 0}
    failed = store.read("data_refresh_log").where("status = 'FAILED'").collect()
    assert len(failed) == 1 and "injuries" in failed[0].error_message


def test_text_landing(spark, tmp_path):
    (tmp_path / "weekly_stats").mkdir()
    (tmp_path / "weekly_stats" / "a.csv").write_text(
        "player_id,season,week,passing_yards,passing_tds,recent_team\np,2020,3,250,nan,KC\nq,2020,x,abc,2,\n"
    )
    rows = Landing(spark, str(tmp_path), "csv").read("weekly_stats", [2020]).orderBy("player_id").collect()
    assert [(r.week, r.passing_yards, r.passing_tds, r.recent_team, r.fantasy_points_std) for r in rows] == [
        (3, 250.0, 0.0, "KC", 10.0), (None, 0.0, 2.0, None, 8.0),
    ]


def test_json_landing(spark, tmp_path):
    (tmp_path / "pbp_data").mkdir()
    (tmp_path / "pbp_data" / "a.json").write_text(
        '{"game_id": "g", "season": 2020, "desc": "run", "touchdown": 1, "epa": 0.5, "odd": 1}\n'
        '{"game_id": "h", "season": "x", "desc": "pass"}\n{"game_id": "i", "season": 2021}\n'
    )
    landing = Landing(spark, str(tmp_path), "json", {"pbp_data": ("epa",)})
    r = landing.read("pbp_data", [2020]).collect()
    assert [(x.game_id, x.season, x.play_description, x.touchdown, x.epa) for x in r] == [("g", 2020, "run", 1.0, 0.5)]
    assert landing.read("pbp_data").count() == 3


def test_rankings_and_summary(spark, store, tmp_path):
    (tmp_path / "FantasyPros_2021_preseason_tiers.xls").write_text(
        "\nx\t\ny\t\nz\t\n\nRank\tPlayer Name\tPosition\tADP\n1\tBo Two\tWR1\t4\n2\tCy III Three\tWR2\t5\n3\tNo Body\tQB1\t6\n"
    )
    assert refresh.refresh_raw_rankings(store, str(tmp_path)) == 3
    refresh.refresh_linked_rankings(store)
    assert [(r.player_name, r.player_id) for r in store.read("ecr_rankings").collect()] == [("Bo Two", "p2")]
    assert refresh.refresh_summaries(store) == {"smry_season": 8}
    s = {r.player_id: r for r in store.read("smry_season").where("season = 2021").collect()}
    assert (s["p3"].fullppr_tot_rnk, s["p2"].fullppr_tot_rnk, s["p1"].fullppr_tot_rnk) == (1, 2, 1)
    assert s["p4"].std_tot_rnk is None and s["p4"].std_ppg_rnk is None
    assert s["p1"].receiving_yards_per_game == 0.0 and s["p2"].receiving_yards_per_game == 100.0
    assert (s["p2"].ecr_preszn_rank, s["p2"].ecr_preszn_adp, s["p2"].ecr_rank, s["p3"].ecr_preszn_rank) == (1.0, 4.0, None, None)
    assert s["p1"].is_rookie == 1
    checks = reports.summary_checks(store.read("seasonal_stats"), store.read("smry_season"))
    assert all(r.passed for r in checks.collect())
    names = store.register_views()
    assert "smry_season" in names and spark.sql("SELECT max(std_tot_rnk) FROM smry_season").first()[0] == 2


def test_report(store):
    rows = reports.validation_report(store.frames()).collect()
    sizes = {r.table_name: r.value for r in rows if r.metric == "rows"}
    assert sizes["weekly_stats"] == 16 and sizes["teams"] == 1
    assert ("seasonal_stats", "2022", 4.0) in {(r.table_name, r.item, r.value) for r in rows if r.metric == "season_rows"}
    assert any(r.table_name == "rosters" and r.item == "weight" and r.value == 100.0 for r in rows if r.metric == "null_percentage")
    assert not [r for r in rows if r.table_name == "data_refresh_log" and r.metric != "rows"]


def test_commands(spark, landing, tmp_path, capsys):
    from tallyfield.__main__ import run

    store, ranks_dir = ["--store", str(tmp_path / "s")], tmp_path / "ranks"
    ranks_dir.mkdir()
    (ranks_dir / "FantasyPros_2021_preseason_tiers.xls").write_text(
        "\nx\t\ny\t\nz\t\n\nRank\tPlayer Name\tPosition\tADP\n1\tBo Two\tWR1\t4\n"
    )
    load = [*store, "--landing", landing.root]
    assert run(spark, [*load, "extract", "2021", "2022"]) == 0
    assert "weekly_stats: 16 rows" in capsys.readouterr().out
    assert run(spark, [*load, "refresh-season", "2021", "--tables", "rosters"]) == 0
    assert run(spark, [*load, "refresh-week", "2021", "2"]) == 0
    assert run(spark, [*store, "refresh-raw-ecr", "--ranks", str(ranks_dir)]) == 0
    assert run(spark, [*store, "refresh-transformed-ecr"]) == 0
    assert run(spark, [*store, "refresh-summary", "--run-tests"]) == 0
    capsys.readouterr()
    out = str(tmp_path / "r.csv")
    sql = "SELECT position, count(*) AS n FROM smry_season GROUP BY position ORDER BY position"
    assert run(spark, [*store, "query", "--sql", sql, "--output", out]) == 0
    assert {tuple(r) for r in spark.read.csv(out, header=True).collect()} == {("LB", "2"), ("QB", "2"), ("WR", "4")}
    assert run(spark, [*store, "validate"]) == 0 and run(spark, [*store, "schema"]) == 0
    assert "season_rows" in (text := capsys.readouterr().out) and "halfppr_ppg_rnk" in text


def test_session_settings(spark):
    from tallyfield import session

    keys = [*session.SETTINGS, "spark.sql.shuffle.partitions"]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        session.tune(spark)
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8", "given at start, so kept"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_scratch_dir_is_in_the_shared_folder(tmp_path):
    from types import SimpleNamespace

    from tallyfield.session import scratch_dir

    started_with = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": "/shared/x"}.get(key, default)))
    one, two = scratch_dir(started_with), scratch_dir(started_with)
    assert one.startswith("/shared/x/") and one != two
