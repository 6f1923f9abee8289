"""Rebuilds that are lost, readers that stay, profiles and summaries that follow the loads."""

import pytest
from pyspark.sql import functions as F

from tallyfield.functions import scoring
from tallyfield.operators.fingerprints import changed_groups, fingerprints
from tallyfield.plans import refresh, reports
from tallyfield.sources import profiles
from tallyfield.sources.warehouse import Warehouse


@pytest.fixture()
def store(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "store"))


def numbers(df):
    return sorted(r[0] for r in df.collect())


def test_lost_rebuild_leaves_the_old_rows(spark, store):
    store.rebuild(spark.range(3), "ecr_rankings")
    staged = store.versions.stage(spark.range(50), "ecr_rankings")
    assert numbers(store.read("ecr_rankings").select("id")) == [0, 1, 2]
    store.versions.switch("ecr_rankings", staged)
    assert store.read("ecr_rankings").count() == 50


def test_readers_keep_the_version_they_resolved(spark, store, tmp_path):
    store.rebuild(spark.range(3), "ecr_rankings")
    reader = store.read("ecr_rankings").select("id")
    store.rebuild(store.read("ecr_rankings").select((F.col("id") + 10).alias("id")), "ecr_rankings")  # reads itself
    assert numbers(reader) == [0, 1, 2]
    assert numbers(store.read("ecr_rankings").select("id")) == [10, 11, 12]
    store.rebuild(spark.range(1), "ecr_rankings")
    assert len(list((tmp_path / "store/_versions/ecr_rankings").iterdir())) == 2
    assert not [p for p in (tmp_path / "store/_current").iterdir() if p.name.startswith("_")]


def test_failed_load_keeps_the_table(spark, store):
    teams = spark.createDataFrame([("A", "Alphas")], "team_abbr string, team_name string")
    store.insert(teams, "teams")
    broken = teams.withColumn("team_name", F.expr("raise_error('lost')").cast("string"))
    with pytest.raises(Exception, match="lost"):
        store.insert(broken, "teams")
    assert [r.team_name for r in store.read("teams").collect()] == ["Alphas"]
    store.insert(teams.withColumn("team_abbr", F.lit("B")), "teams", replace=False)
    assert sorted(r.team_abbr for r in store.read("teams").collect()) == ["A", "B"]


def test_empty_partitioned_rebuild(spark, store):
    store.rebuild(spark.createDataFrame([], "player_id string, season int, x double"), "smry_season", ["season"])
    assert store.exists("smry_season") and store.read("smry_season").count() == 0


def rows_of(report):
    return sorted((str(tuple(r)) for r in report.select("table_name", "metric", "item", "value").collect()))


def same_as_full_scan(store):
    options = {"null_threshold": -1.0}
    assert rows_of(reports.kept_report(store, **options)) == rows_of(reports.validation_report(store.frames(), **options))


def test_profiles_follow_every_load(spark, store):
    schema = "player_id string, season int, week int, passing_yards double, attempts int"
    week = [("a", 2022, 1, 1.0, None), ("b", 2022, 2, None, 3), ("c", 2023, 1, 2.0, 4), ("d", None, 1, None, 5), ("e", 2023, None, 1.0, 1)]
    store.insert(spark.createDataFrame(week, schema), "weekly_stats")
    same_as_full_scan(store)
    late = spark.createDataFrame([("a", 2022, 2, 5.0, None), ("z", None, 1, 5.0, None)], schema).withColumn("bonus", F.lit(1))
    store.insert(late, "weekly_stats")  # a week replaced, a row without a season added, a new column
    store.insert(spark.createDataFrame([("t", "x")], "team_abbr string, team_name string"), "teams")
    games = spark.createDataFrame([("g", 2022, 7), ("h", 2023, None)], "game_id string, season int, home_score int")
    store.insert(games, "schedules")
    store.insert(games.where("season = 2023"), "schedules")
    store.insert(games, "schedules", replace=False)
    store.log_refresh("teams", 0, None, "ALL", "SUCCESS", records_processed=1)
    same_as_full_scan(store)
    store.insert(spark.createDataFrame([("u", "y"), ("v", None)], "team_abbr string, team_name string"), "teams")
    same_as_full_scan(store)


def test_report_reads_profiles_only(spark, store):
    store.insert(spark.createDataFrame([("a", 2022, 1, 1.0)], "player_id string, season int, week int, passing_yards double"), "weekly_stats")
    files = reports.kept_report(store, ["weekly_stats"]).inputFiles()
    assert files and all("/profile-weekly_stats/" in f for f in files)


def test_table_without_profile_is_counted_once(spark, store):
    store.rebuild(spark.createDataFrame([("a", 2022, None), ("b", 2023, 1.0)], "player_id string, season int, x double"), "smry_season", ["season"])
    same_as_full_scan(store)
    assert profiles.stored(store, "smry_season").count() == 2


def test_fingerprints(spark):
    schema = "season int, a string, b string, n int, created_at timestamp"
    rows = [(2022, "x", None, 1, None), (2022, "x", None, 1, None), (2022, "y", "z", 2, None), (2023, "q", "r", 3, None), (None, "s", None, 4, None)]
    df = spark.createDataFrame(rows, schema)
    base = fingerprints(df, "season")
    shuffled = df.orderBy(F.rand(1)).repartition(5).select("n", "b", "created_at", "a", "season")
    assert changed_groups(base, fingerprints(shuffled.withColumn("created_at", F.current_timestamp()), "season")).collect() == []

    def changed(changed_rows):
        return {r[0] for r in changed_groups(base, fingerprints(spark.createDataFrame(changed_rows, schema), "season")).collect()}

    assert changed([rows[0], *rows[2:]]) == {2022}  # a repeat less
    assert changed([(2022, None, "x", 1, None), *rows[1:]]) == {2022}  # a value moved to another column
    assert changed([*rows[:4], (None, "s", None, 5, None)]) == {None}
    assert changed([r for r in rows if r[0] != 2023]) == {2023}
    assert changed([*rows, (2024, "n", "n", 1, None)]) == {2024}


SEASONAL = "player_id string, season int, games int, passing_yards double, passing_tds double"


def seasonal(spark, rows):
    return scoring.score(spark.createDataFrame(rows, SEASONAL))


def loaded(spark, store):
    rows = [(f"p{i}", season, i, float(i * season % 17), 1.0) for season in (2021, 2022, 2023) for i in range(6)]
    store.insert(seasonal(spark, rows), "seasonal_stats")
    roster = "player_id string, season int, week int, team string, position string, player_name string"
    store.insert(spark.createDataFrame([(r[0], r[1], 1, "T", "QB", r[0].upper()) for r in rows], roster), "rosters")
    ranks = [("p1", 2022, True, 3.0), ("p2", 2023, False, 1.0)]
    store.rebuild(spark.createDataFrame(ranks, "player_id string, year int, before_preseason boolean, rank double").withColumns({
        c: F.lit(None).cast("double") for c in ("best_rank", "worst_rank", "avg_rank", "stddev_rank", "adp", "vs_adp", "position_rank")
    }), "ecr_rankings")
    return rows


def summary_rows(df):
    return sorted(str(tuple(r)) for r in df.select(sorted(df.columns)).collect())


def test_only_changed_seasons_are_built(spark, store):
    rows = loaded(spark, store)
    build = lambda: refresh.rebuild_summary(store, "smry_season", only_changed=True)
    assert build() == [2021, 2022, 2023]  # nothing is known yet
    assert build() == []
    folder = store.path("smry_season")
    changed = [(*r[:3], r[3] + 1, 2.0) for r in rows if r[1] == 2022]
    store.insert(seasonal(spark, changed), "seasonal_stats")
    assert build() == [2022]
    assert store.path("smry_season") == folder
    assert summary_rows(store.read("smry_season")) == summary_rows(refresh.SUMMARIES["smry_season"](store).select(store.read("smry_season").columns))
    store.insert(seasonal(spark, changed), "seasonal_stats")  # the same rows again, loaded later
    assert build() == []
    linked = store.read("ecr_rankings").withColumn("rank", F.when(F.col("year") == 2023, 9.0).otherwise(F.col("rank")))
    store.rebuild(linked, "ecr_rankings")
    assert build() == [2023]
    store.insert(seasonal(spark, [("p9", 2024, 1, 1.0, 1.0)]), "seasonal_stats")
    assert build() == [2024]
    assert store.read("smry_season").where("season = 2024").count() == 1
    assert refresh.refresh_summaries(store) == {"smry_season": 19}


def test_job_lost_before_the_fingerprints_builds_again(spark, store, monkeypatch):
    rows = loaded(spark, store)
    refresh.rebuild_summary(store, "smry_season")
    store.insert(seasonal(spark, [(*r[:3], 50.0, 2.0) for r in rows if r[1] == 2021]), "seasonal_stats")
    switch = store.versions.switch
    monkeypatch.setattr(store.versions, "switch", lambda table, name: None if table.startswith("inputs-") else switch(table, name))
    assert refresh.rebuild_summary(store, "smry_season", only_changed=True) == [2021]
    monkeypatch.undo()
    assert refresh.rebuild_summary(store, "smry_season", only_changed=True) == [2021]
    assert refresh.rebuild_summary(store, "smry_season", only_changed=True) == []
