import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyfield.operators.replace import next_ids, replace_rows
from tallyfield.sources import warehouse as wh
from tallyfield.sources.warehouse import Warehouse


@pytest.fixture()
def store(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "store"))


def weekly(spark, rows):
    return spark.createDataFrame(rows, "player_id string, season int, week int, passing_yards double")


def state(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_full_replace(spark, store):
    teams = spark.createDataFrame([("A", "Alphas"), ("B", "Betas")], "team_abbr string, team_name string")
    assert store.insert(teams, "teams") == 2
    assert store.insert(teams.where("team_abbr = 'B'"), "teams") == 1
    df = store.read("teams")
    assert state(df, "team_abbr", "team_name", "team_conf") == [("B", "Betas", None)]
    assert df.first().created_at is not None


def test_empty_batch_writes_nothing(spark, store):
    teams = spark.createDataFrame([("A", "Alphas")], "team_abbr string, team_name string")
    store.insert(teams, "teams")
    assert store.insert(teams.limit(0), "teams") == 0
    assert store.read("teams").count() == 1


def test_replace_season_week(spark, store):
    store.insert(weekly(spark, [("a", 2022, 1, 1.0), ("a", 2022, 2, 2.0), ("b", 2023, 1, 3.0)]), "weekly_stats")
    n = store.insert(weekly(spark, [("c", 2022, 2, 9.0), ("d", 2024, 1, 8.0)]), "weekly_stats")
    assert n == 2
    assert state(store.read("weekly_stats"), "player_id", "season", "week", "passing_yards") == [
        ("a", 2022, 1, 1.0), ("b", 2023, 1, 3.0), ("c", 2022, 2, 9.0), ("d", 2024, 1, 8.0),
    ]


def test_replace_season(spark, store):
    one = spark.createDataFrame([("p", 2022, "X"), ("q", 2023, "X")], "player_id string, season int, team string")
    two = spark.createDataFrame([("Y", 2023, "r", "new")], "team string, season int, player_id string, nickname string")
    store.insert(one, "rosters")
    store.insert(two, "rosters")
    df = store.read("rosters")
    assert state(df, "player_id", "season", "team", "nickname") == [("p", 2022, "X", None), ("r", 2023, "Y", "new")]


def test_rows_without_season_are_kept_and_never_replaced(spark, store):
    store.insert(weekly(spark, [("a", None, 1, 1.0), ("b", 2022, None, 2.0), ("c", 2022, 1, 3.0)]), "weekly_stats")
    assert store.insert(weekly(spark, [("d", 2022, 1, 4.0), ("e", None, 1, 5.0)]), "weekly_stats") == 2
    assert state(store.read("weekly_stats"), "player_id") == [("a",), ("b",), ("d",), ("e",)]


def test_append(spark, store):
    one = spark.createDataFrame([("p", 2022)], "player_id string, season int")
    store.insert(one, "rosters")
    store.insert(one, "rosters", replace=False)
    assert store.read("rosters").count() == 2


def test_season_filter_prunes_partitions(spark, store):
    store.insert(weekly(spark, [("a", s, 1, 1.0) for s in range(2015, 2024)]), "weekly_stats")
    df = store.read("weekly_stats").where(F.col("season") == 2020)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan
    assert df.count() == 1


def test_refresh_log(spark, store):
    assert store.last_refresh("teams", 0) is None
    store.log_refresh("teams", 0, None, "ALL", "SUCCESS", records_processed=32)
    store.log_refresh("weekly_stats", 2023, 4, "REG", "FAILED", "boom")
    store.log_refresh("weekly_stats", 2023, 5, "REG", "SUCCESS", records_processed=7)
    log = store.read(wh.LOG_TABLE)
    assert state(log, "id", "table_name", "week", "status") == [
        (1, "teams", None, "SUCCESS"), (2, "weekly_stats", 4, "FAILED"), (3, "weekly_stats", 5, "SUCCESS"),
    ]
    assert isinstance(store.last_refresh("weekly_stats", 2023), dt.datetime)
    assert store.last_refresh("weekly_stats", 2023, 4) is None
    with pytest.raises(ValueError):
        store.log_refresh("teams", 0, None, "ALL", "DONE")


def test_sql_over_views(spark, store, tmp_path):
    store.insert(
        spark.createDataFrame(
            [("a", "Al", "QB", "KC", 2023, 1), ("b", "Bo", "QB", "KC", 2023, 2), ("c", "Cy", "WR", "SF", 2022, 1)],
            "player_id string, player_name string, position string, recent_team string, season int, week int",
        ), "weekly_stats",
    )
    store.insert(
        spark.createDataFrame(
            [("g1", "1", 2023, "Al", "a", "KC", 1.0, 5), ("g1", "2", 2023, "Al", "a", "KC", 0.0, 5)],
            "game_id string, play_id string, season int, fantasy_player_name string, fantasy_player_id string, "
            "posteam string, touchdown double, yardline_100 int",
        ), "pbp_data",
    )
    store.insert(spark.createDataFrame([("a", "QB", 2023)], "player_id string, position string, season int"), "rosters")
    assert set(store.register_views()) == {"weekly_stats", "pbp_data", "rosters"}
    rows = store.query(
        "SELECT team, count(*) AS games FROM weekly_stats WHERE season = ? GROUP BY team HAVING games >= ?", [2023, 2]
    ).collect()
    assert [tuple(r) for r in rows] == [("KC", 2)]
    sql = tmp_path / "q.sql"
    sql.write_text("-- two; statements\nSELECT ';' AS mark;\nSELECT p.player_name, p.position, count(CASE WHEN p.touchdown = true THEN 1 END) AS tds\n"
                   "FROM pbp_data p GROUP BY ALL;\n")
    first, second = store.query_file(str(sql))
    assert [tuple(r) for r in first.collect()] == [(";",)] and [tuple(r) for r in second.collect()] == [("Al", "QB", 1)]


def test_later_columns_and_types(spark, store):
    ddl = "player_id string, season int"
    store.insert(spark.createDataFrame([("p", 2022, 5)], f"{ddl}, extra int"), "rosters")
    store.insert(spark.createDataFrame([("q", 2023, "7", "new")], f"{ddl}, extra string, nickname string"), "rosters")
    df = store.read("rosters")
    assert dict(df.dtypes)["extra"] == "int" and len(df.columns) == len(set(df.columns))
    assert state(df, "player_id", "extra", "nickname") == [("p", 5, None), ("q", 7, "new")]


def test_source_is_read_once(spark, store):
    def rows(given):
        seen = spark.sparkContext.accumulator(0)

        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return seen, weekly(spark, given).mapInArrow(count, weekly(spark, given).schema)

    seen, batch = rows([("a", 2022, 1, 1.0), ("b", 2023, 1, 2.0)])
    assert store.insert_counted(batch, "weekly_stats", [2022, 2023, 2024]) == (2, {2022: 1, 2023: 1, 2024: 0})
    assert seen.value == 2
    seen, batch = rows([("c", 2022, 1, 1.0), ("d", None, 1, 2.0)])
    assert store.insert(batch, "weekly_stats") == 2 and seen.value == 4
    stored = store.read("weekly_stats")
    assert state(stored, "player_id") == [("b",), ("c",), ("d",)]
    seen, batch = rows([])
    assert store.insert(batch, "weekly_stats") == 0 and store.read("weekly_stats").count() == 3


def test_only_a_missing_folder_is_no_table(spark, store, tmp_path):
    assert not store.exists("weekly_stats")
    broken = tmp_path / "store" / "weekly_stats"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        wh.Warehouse(spark, str(tmp_path / "store")).exists("weekly_stats")


@pytest.mark.parametrize("ending", [".csv", ".parquet", ".json"])
def test_export(spark, tmp_path, ending):
    df = spark.createDataFrame([(1, "x"), (2, None)], "n int, s string")
    path = str(tmp_path / f"out{ending}")
    wh.export(df, path)
    if ending == ".csv":
        back = spark.read.schema(df.schema).csv(path, header=True)
    elif ending == ".parquet":
        back = spark.read.parquet(path)
    else:
        back = spark.read.schema(df.schema).json(path)
    assert state(back, "n", "s") == [(1, "x"), (2, None)]


def test_replace_rows_frame(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("n", None)], "p string, season int")
    new = spark.createDataFrame([(2, "c", 5), (None, "m", 6)], "season int, p string, extra int")
    assert state(replace_rows(old, new, ["season"]), "p", "season", "extra") == [
        ("a", 1, None), ("c", 2, 5), ("m", None, 6), ("n", None, None),
    ]


def test_next_ids(spark):
    log = spark.createDataFrame([(4, "x")], "id int, t string")
    new = spark.createDataFrame([("b",), ("a",)], "t string")
    assert state(next_ids(log, new, ["t"]), "id", "t") == [(5, "a"), (6, "b")]
    assert state(next_ids(log.limit(0), new, ["t"]), "id", "t") == [(1, "a"), (2, "b")]
