import pytest
from pyspark.sql import functions as F

from tallyfield.sources import keyfilters
from tallyfield.sources.warehouse import Warehouse

KEYS = ["game_id", "play_id"]


@pytest.fixture()
def store(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "store"))


def plays(spark, rows):
    return spark.createDataFrame(rows, "game_id string, play_id int, season int")


def known(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def data_files(df, store):
    return sorted(f for f in df.inputFiles() if "/store/pbp_data/" in f)


def games(spark, season, n):
    return spark.range(n).select(
        F.concat(F.lit(f"{season}_"), F.col("id") % 16).alias("game_id"), F.col("id").cast("int").alias("play_id"),
        F.lit(season).alias("season"),
    )


def test_stored_and_repeated_keys(spark, store):
    store.insert(plays(spark, [("a", 1, 2022), ("a", 1, 2023), ("a", 2, 2023), ("b", 1, 2023), ("b", 1, 2023)]), "pbp_data")
    batch = plays(spark, [("a", 1, 2024), ("b", 1, 2024), ("b", 1, 2024), ("c", 9, 2024), ("c", 9, 2024), ("d", 1, 2024)])
    assert known(store.known_keys(batch, "pbp_data")) == [("a", 1, 1, 2), ("b", 1, 2, 2), ("c", 9, 2, 0)]


def test_null_keys_equal_each_other_and_texts_are_converted(spark, store):
    store.insert(plays(spark, [(None, 1, 2022), ("a", None, 2022), ("a", 3, None)]), "pbp_data")
    batch = spark.createDataFrame([(None, "1"), ("a", "x"), ("a", "3"), (None, None)], "game_id string, play_id string")
    assert known(store.known_keys(batch, "pbp_data")) == [("a", 3, 1, 1), ("a", None, 1, 1), (None, 1, 1, 1)]


def test_nothing_stored_and_empty_batches(spark, store):
    batch = plays(spark, [("a", 1, 2022), ("a", 1, 2022), ("b", 1, 2022)])
    assert known(store.known_keys(batch, "pbp_data")) == [("a", 1, 2, 0)]
    store.insert(batch, "pbp_data")
    assert known(store.known_keys(batch.limit(0), "pbp_data")) == []
    with pytest.raises(ValueError, match="play_id"):
        store.known_keys(batch.drop("play_id"), "pbp_data")


def test_only_partitions_that_may_hold_a_key_are_read(spark, store):
    for season in (2021, 2022, 2023, 2024):
        store.insert(games(spark, season, 5000), "pbp_data")
    batch = plays(spark, [("2022_1", 1, 2030), ("2022_1", 4, 2030), ("2022_3", 4979, 2030)])
    out = store.known_keys(batch, "pbp_data")
    assert known(out) == [("2022_1", 1, 1, 1), ("2022_3", 4979, 1, 1)]
    read = data_files(out, store)
    stored = data_files(store.read("pbp_data"), store)
    assert read and all("/season=2022/" in f for f in read) and len(read) < len(stored)
    none = store.known_keys(plays(spark, [("2030_1", 1, 2030)]), "pbp_data")
    assert known(none) == [] and data_files(none, store) == []


def test_filters_follow_whatever_is_written(spark, store):
    store.insert(games(spark, 2022, 100).unionByName(games(spark, 2023, 3000)), "pbp_data")
    assert keyfilters.refresh(store, "pbp_data", KEYS) == ["/season=2022/", "/season=2023/"]
    assert keyfilters.refresh(store, "pbp_data", KEYS) == []
    store.insert(games(spark, 2022, 50).withColumn("play_id", F.col("play_id") + 7000), "pbp_data")
    store.insert(games(spark, 2024, 10), "pbp_data", replace=False)
    batch = plays(spark, [("2022_1", 1, 0), ("2022_1", 7001, 0), ("2023_1", 1, 0), ("2024_1", 1, 0)])
    assert [r[:2] for r in known(store.known_keys(batch, "pbp_data"))] == [("2022_1", 7001), ("2023_1", 1), ("2024_1", 1)]
    assert keyfilters.refresh(store, "pbp_data", KEYS) == []
    assert keyfilters.refresh(store, "pbp_data", ["play_id"]) == ["/season=2022/", "/season=2023/", "/season=2024/"]


def test_a_refresh_lost_before_its_record_is_made_again(spark, store, monkeypatch):
    store.insert(games(spark, 2022, 100), "pbp_data")
    build = keyfilters._build

    def lost(*args):
        build(*args)
        raise RuntimeError("gone")

    monkeypatch.setattr(keyfilters, "_build", lost)
    with pytest.raises(RuntimeError):
        keyfilters.refresh(store, "pbp_data", KEYS)
    monkeypatch.undo()
    store.insert(games(spark, 2022, 10), "pbp_data")
    batch = plays(spark, [("2022_1", 1, 0), ("2022_14", 14, 0)])
    assert known(store.known_keys(batch, "pbp_data")) == [("2022_1", 1, 1, 1)]


def test_no_key_is_missed_and_few_partitions_are_read_for_nothing(spark, store):
    store.insert(games(spark, 2022, 20000).unionByName(games(spark, 2023, 300)), "pbp_data")
    keyfilters.refresh(store, "pbp_data", KEYS)
    arriving = games(spark, 2022, 20000).unionByName(games(spark, 2023, 300)).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("batch_rows"))
    maybe = keyfilters.candidates(store, "pbp_data", arriving, KEYS)
    own = maybe.where(F.col("_partition") == F.concat(F.lit("/season="), F.substring("game_id", 1, 4), F.lit("/")))
    assert own.count() == 20300
    absent = arriving.withColumn("play_id", F.col("play_id") + 100000)
    assert keyfilters.candidates(store, "pbp_data", absent, KEYS).count() < 0.02 * 2 * 20300


def test_tables_replaced_as_a_whole(spark, store):
    teams = spark.createDataFrame([("A", "Alphas"), ("B", "Betas")], "team_abbr string, team_name string")
    store.insert(teams, "teams")
    assert known(store.known_keys(teams.where("team_abbr = 'B'"), "teams")) == [("B", 1, 1)]
    store.insert(teams.where("team_abbr = 'A'"), "teams")
    assert known(store.known_keys(teams, "teams")) == [("A", 1, 1)]


def test_partitions_of_any_name_are_told_from_paths(spark, store):
    rows = [(i, v) for i, v in enumerate(["a+b", "a b", "50%", "x/y", "1=2", "é+%", None])]
    store.rebuild(spark.createDataFrame(rows, "k int, team string"), "odd", ["team"])
    batch = spark.createDataFrame([(i,) for i in range(9)], "k int")
    assert known(store.known_keys(batch, "odd", ["k"])) == [(i, 1, 1) for i, _ in rows]
    store.rebuild(spark.createDataFrame(rows, "k int, team string"), "flat")
    assert known(store.known_keys(batch, "flat", ["k"])) == [(i, 1, 1) for i, _ in rows]


def test_rows_are_not_moved_for_the_levels(spark, store):
    store.insert(games(spark, 2022, 100).unionByName(games(spark, 2023, 100)), "pbp_data")
    levels = {"/season=2022/": 0, "/season=2023/": 1}
    rows = keyfilters._rows_of(store, "pbp_data", list(levels), KEYS)
    for limit in ("-1", "10m"):
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            plan = keyfilters._placed(rows, levels, KEYS)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        assert "BroadcastHashJoin" in plan and "BuildRight" in plan and "hashpartitioning" not in plan
