import json

import pytest
from pyspark.sql import functions as F

from tallyfield.functions import typing as t
from tallyfield.plans.refresh import load_table
from tallyfield.sources import quarantine
from tallyfield.sources.landing import Landing
from tallyfield.sources.warehouse import Warehouse


@pytest.fixture()
def store(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "store"))


def cells(df):
    return sorted((r["column"], r["reason"], r["text"]) for r in df.collect())


def rejected(spark, ddl, row, table="schedules"):
    df = spark.createDataFrame([row], ddl)
    return [tuple(r) for r in df.select(t.rejects(df, table).alias("r")).first()["r"]]


@pytest.mark.parametrize("text, reason", [
    ("abc", "number"), ("7.5", "fraction"), ("99999999999", "range"), ("inf", "range"), ("1e300", "range"), ("12d", "number"),
    ("7", None), (" 7.0 ", None), ("-3e1", None), ("", None), ("  ", None), ("NaN", None), ("None", None), (None, None),
])
def test_whole_numbers(spark, text, reason):
    assert rejected(spark, "home_score string", (text,)) == ([("home_score", reason, text)] if reason else [])


def test_other_kinds(spark):
    got = rejected(
        spark, "overtime string, gameday string, spread_line string, stadium string, gametime string, created_at string",
        ("maybe", "2024-02-30", "3,5", "nowhere", "noon", "x"),
    )
    assert got == [("overtime", "flag", "maybe"), ("gameday", "date", "2024-02-30"), ("spread_line", "number", "3,5")]
    assert rejected(spark, "overtime double, home_score double, week bigint", (2.0, 7.5, 1 << 40)) == [
        ("overtime", "flag", "2.0"), ("home_score", "fraction", "7.5"), ("week", "range", str(1 << 40)),
    ]
    assert rejected(spark, "overtime double, home_score double, week bigint", (None, float("nan"), 3)) == []


def test_columns_that_cannot_fail_are_not_looked_at(spark):
    df = spark.createDataFrame([("g", 2023, 1.5, True)], "game_id string, season int, spread_line double, overtime boolean")
    assert "filter" not in df.select(t.rejects(df, "schedules"))._jdf.queryExecution().optimizedPlan().toString()


def test_a_rejected_cell_is_one_that_becomes_null(spark):
    texts = ["7", "x", "1e400", "0", "yes", "2024-01-01", "nan", "", " ", None, "-0.0", "1_000", "٣"]
    names = ["home_score", "spread_line", "overtime", "gameday", "game_id"]
    df = spark.createDataFrame([tuple([x] * len(names)) for x in texts], ", ".join(f"{n} string" for n in names))
    out = df.select(t.rejects(df, "schedules").alias("r"), *t.typed_columns(df, "schedules"), *[F.col(n).alias(f"raw_{n}") for n in names])
    for row in out.collect():
        lost = {c["column"] for c in row["r"]}
        for n in names:
            raw = row[f"raw_{n}"]
            blank = raw is None or raw.strip().lower() in ("", "nan", "none")
            assert (n in lost) == (row[n] is None and not blank), (n, raw)


def test_load_keeps_rows_and_reasons(spark, store, tmp_path):
    (tmp_path / "landing" / "schedules").mkdir(parents=True)
    (tmp_path / "landing" / "schedules" / "a.csv").write_text(
        "game_id,season,home_score,gameday,cells\n"
        "a,2022,7,2022-09-01,own\nb,2022,x,soon,own\nc,20x2,3,,own\nd,2021,bad,,own\ne,,bad,,own\n"
    )
    landing = Landing(spark, str(tmp_path / "landing"), "csv")
    assert load_table(store, landing, "schedules", [2022], keep_rejects=True) == 2
    got = store.read("schedules").orderBy("game_id").select("game_id", "season", "home_score", "cells").collect()
    assert [tuple(r) for r in got] == [("a", 2022, 7, "own"), ("b", 2022, None, "own")]
    assert cells(quarantine.cells(store, "schedules")) == [
        ("gameday", "date", "soon"), ("home_score", "number", "x"), ("season", "number", "20x2"),
    ]
    kept = {json.loads(r["landed"])["game_id"]: json.loads(r["landed"]) for r in quarantine.rows(store, "schedules").collect()}
    assert kept["b"] == {"game_id": "b", "season": "2022", "home_score": "x", "gameday": "soon", "cells": "own"}
    assert sorted(kept) == ["b", "c"]
    plain = Warehouse(spark, str(tmp_path / "plain"))
    assert load_table(plain, landing, "schedules", [2022]) == 2
    columns = ["game_id", "season", "home_score", "gameday", "cells"]
    assert plain.read("schedules").select(*columns).exceptAll(store.read("schedules").select(*columns)).isEmpty()


def test_each_load_counts_for_itself(spark, store, tmp_path):
    rows = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "3")], "gsis_id string, draft_number string")
    rows.write.json(str(tmp_path / "landing" / "players"))
    landing = Landing(spark, str(tmp_path / "landing"), "json")
    assert quarantine.report(store, ["players", "schedules"]).isEmpty()
    for loads in (1, 2):
        load_table(store, landing, "players", keep_rejects=True)
        got = quarantine.report(store, ["schedules", "players"]).collect()
        assert [(r["table_name"], r["column"], r["reason"], r["cells"], r["example"]) for r in got] == [
            ("players", "draft_number", "number", 2, "x")
        ] * loads
        assert len({r["load_id"] for r in got}) == loads


def test_clean_and_empty_batches_leave_nothing(spark, store, tmp_path):
    rows = spark.createDataFrame([("a", "2022", "7")], "game_id string, season string, home_score string")
    rows.write.option("header", True).csv(str(tmp_path / "landing" / "schedules"))
    landing = Landing(spark, str(tmp_path / "landing"), "csv")
    assert load_table(store, landing, "schedules", [2022], keep_rejects=True) == 1
    assert load_table(store, landing, "schedules", [1990], keep_rejects=True) == 0
    assert quarantine.rows(store, "schedules").isEmpty()
    assert quarantine.cells(store, "schedules").columns == ["load_id", "loaded_at", "landed", "column", "reason", "text"]


def test_landed_files_are_read_once(spark, store, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("a", "2022", "x")], "game_id string, season string, home_score string")
    rows.write.option("header", True).csv(str(tmp_path / "landing" / "schedules"))
    scans, stored = [], quarantine.stored

    def counted(df):
        scans.append([f for f in df.inputFiles() if "/landing/" in f])
        return stored(df)

    monkeypatch.setattr(quarantine, "stored", counted)
    seen = []
    insert = Warehouse.insert_counted
    monkeypatch.setattr(Warehouse, "insert_counted", lambda self, batch, *a, **k: (seen.append(batch.inputFiles()), insert(self, batch, *a, **k))[1])
    load_table(store, Landing(spark, str(tmp_path / "landing"), "csv"), "schedules", [2022], keep_rejects=True)
    assert len(scans) == 1 and scans[0] and not [f for f in seen[0] if "/landing/" in f]
