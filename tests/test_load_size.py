"""What loads write and move: landed text, and rows on their way into partitions."""

import os

import pytest
from pyspark.sql import functions as F

from tallyfield.functions.typing import number_sql
from tallyfield.operators import quality
from tallyfield.registry import queries
from tallyfield.schemas import TABLES
from tallyfield.sources import profiles
from tallyfield.sources.landing import Landing
from tallyfield.sources.warehouse import Warehouse


def test_landed_json_is_compressed_in_files_of_bounded_rows(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "scratch_dir", lambda _: str(tmp_path / "json"))
    monkeypatch.setattr(queries, "JSON_FILE_ROWS", 1000, raising=False)
    store = queries._loaded(spark, sf_dir, "json")
    landed = tmp_path / "json" / "landing" / "weekly_stats"
    files = [f for f in os.listdir(landed) if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
    assert all(spark.read.text(str(landed / f)).count() <= 1000 for f in files)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    assert spark.read.text(str(landed)).count() == lines.count()
    want = lines.where(F.year("l_shipdate").isin(queries.SEASON, queries.SEASON + 1)).count()
    assert store.read("weekly_stats").count() == store.read("pbp_data").count() == want


@pytest.mark.parametrize("batch_keys", [["season", "week"], ["season"]])
def test_rows_are_sorted_before_absent_columns_are_added(spark, tmp_path, monkeypatch, batch_keys):
    seen, write = [], Warehouse._write

    def spied(self, rows, spec, mode, seasons, **options):
        whole = options.get("whole")
        if whole is not None:
            options["whole"] = lambda df: (seen.append(df), whole(df))[1]
        return write(self, rows, spec, mode, seasons, **options)

    monkeypatch.setattr(Warehouse, "_write", spied)
    store = Warehouse(spark, str(tmp_path))
    rows = [(f"P{i}", 2000 + i % 2 if i % 5 else None, i % 3) for i in range(40)]
    batch = spark.createDataFrame(rows, "player_id string, season int, week int").select("player_id", *batch_keys)
    assert store.insert(batch, "weekly_stats") == 40
    moved = seen[0]
    assert moved.columns[:2] == ["player_id", "season"] and len(moved.columns) == 3
    assert "Sort [season" in moved._jdf.queryExecution().analyzed().toString()
    got = store.read("weekly_stats")
    assert set(TABLES["weekly_stats"].types) < set(got.columns)
    week = F.col("week") if "week" in batch_keys else F.lit(None).cast("int")
    want = batch.withColumn("week", week).select("player_id", "season", "week")
    assert sorted(got.select(*want.columns).collect(), key=str) == sorted(want.collect(), key=str)


def test_numbers_without_the_pattern_are_those_with_it(spark):
    texts = [
        "12", " 12.5\t", ".5", "5.", "+1e3", "1E-2", "-0", "12d", "1f", "0x1p3", "NaN", "nan", "Inf", " inf\n", "-infinity",
        "INF", "Infinity", "1e400", "+-1", "e5", "1e", ".", "+", "", " ", "1 2", "1\n2", "\u000112", "12 ", "٣", "1,5", None,
    ]
    pattern = r"r'^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI]nf(inity)?)$'"
    text = r"btrim(t, ' \t\r\n\u000C\u000B')"
    by_pattern = f"CASE WHEN {text} RLIKE {pattern} THEN try_cast({text} AS DOUBLE) END"
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, got, want in frame.select("t", F.expr(number_sql("t", frame.schema["t"].dataType)), F.expr(by_pattern)).collect():
        assert got == want, repr(t)
    assert "OR" in number_sql("t")


def test_rows_are_not_copied_between_exchange_and_write(spark, tmp_path, monkeypatch):
    seen, write = [], Warehouse._write

    def spied(self, rows, spec, mode, seasons, **options):
        whole = options["whole"]
        options["whole"] = lambda df: (seen.append(df), whole(df))[1]
        return write(self, rows, spec, mode, seasons, **options)

    monkeypatch.setattr(Warehouse, "_write", spied)
    rows = [(f"P{i}", 2000 + i % 2 if i % 5 else None, i % 3 or None, i if i % 4 else None) for i in range(60)]
    batch = spark.createDataFrame(rows, "player_id string, season int, week int, attempts int")
    store = Warehouse(spark, str(tmp_path))
    counted = store.insert_counted(batch, "weekly_stats", [2000, 2001, 1990])
    assert counted == (60, {s: sum(r[1] == s for r in rows) for s in (2000, 2001, 1990)})
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("CollectMetrics") < plan.index("Sort [season") < plan.index("RebalancePartitions")
    assert "_common_expr" not in plan
    assert sorted(store.read("weekly_stats").select(*batch.columns).collect(), key=str) == sorted(batch.collect(), key=str)


def test_profiles_add_no_column_for_each_count(spark):
    rows = [(2000, 1, 1, 0.5), (2000, 1, None, float("nan")), (2000, None, 3, None), (None, None, None, None)]
    frame = spark.createDataFrame(rows, "season int, week int, attempts int, sacks double")
    profile = profiles.partition_rows(frame, ["season", "week"])
    got = {(r.season, r.week): (r.row_count, r.nulls["attempts"], r.nulls["sacks"]) for r in profile.collect()}
    assert got == {(2000, 1): (2, 1, 0), (2000, None): (1, 0, 1), (None, None): (1, 1, 1)}
    for counted in (profile, quality.null_profile(frame)):
        assert "_common_expr" not in counted._jdf.queryExecution().optimizedPlan().toString()


def test_landed_rows_are_filtered_apart_from_their_conversion(spark, tmp_path):
    rows = [(f"P{i}", 2000 + i % 3, i % 4, float(i) if i % 7 else float("nan")) for i in range(200)]
    frame = spark.createDataFrame(rows, "player_id string, season int, week int, sacks double")
    frame.repartition(5).write.parquet(str(tmp_path / "weekly_stats"))
    landing = Landing(spark, str(tmp_path))
    got = landing.read("weekly_stats", [2000], 3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Project") < plan.index("Coalesce") < plan.index("Filter") < plan.index("FileScan")
    assert "EqualTo(season,2000)" in plan and "EqualTo(week,3)" in plan
    assert got.rdd.getNumPartitions() == landing.raw("weekly_stats").rdd.getNumPartitions() > 1
    assert sorted(r.player_id for r in got.collect()) == sorted(r[0] for r in rows if r[1:3] == (2000, 3))
    assert "Coalesce" not in landing.read("weekly_stats")._jdf.queryExecution().executedPlan().toString()
