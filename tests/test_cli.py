"""The command line: whole results, files, golden ranks."""

from tallyfield.__main__ import run
from tallyfield.functions.scoring import score
from tallyfield.sources.warehouse import Warehouse


def test_prints_all_or_says_so(spark, tmp_path, capsys):
    store = ["--store", str(tmp_path)]
    sql = ["query", "--sql", "SELECT id FROM range(1500) ORDER BY id"]
    assert run(spark, [*store, *sql]) == 0
    lines = capsys.readouterr().out.splitlines()
    assert len(lines) == 1002 and lines[-1].startswith("... more rows than 1000")
    run(spark, [*store, "--limit", "0", *sql])
    lines = capsys.readouterr().out.splitlines()
    assert len(lines) == 1501 and lines[-1] == "1499"
    run(spark, [*store, *sql, "--output", str(tmp_path / "out.csv")])
    assert spark.read.csv(str(tmp_path / "out.csv"), header=True).count() == 1500


def test_several_statements(spark, tmp_path, capsys):
    script = tmp_path / "two.sql"
    script.write_text("SELECT 1 AS a; -- then\nSELECT 'x;y' AS b;\n")
    assert run(spark, ["--store", str(tmp_path), "query", "--file", str(script)]) == 0
    assert capsys.readouterr().out.split("\n")[:4] == ["a", "1", "b", "x;y"]


def test_golden_ranks(spark, tmp_path, capsys):
    store = Warehouse(spark, str(tmp_path / "store"))
    stats = score(spark.createDataFrame(
        [(f"p{i}", 2021, "REG", 100.0 * i, 10) for i in range(1, 8)],
        "player_id string, season int, season_type string, receiving_yards double, games int",
    ))
    store.insert(stats, "seasonal_stats")
    store.insert(
        spark.createDataFrame([(f"p{i}", f"Name {i}", "WR", 2021) for i in range(1, 8)],
                              "player_id string, player_name string, position string, season int"), "rosters"
    )
    ranks = spark.createDataFrame([("p1", 2021, False, 1.0)], "player_id string, year int, before_preseason boolean, rank double")
    store.insert(ranks, "ecr_rankings")
    expect = tmp_path / "expect.csv"
    head = "season,position,rank_column,expected_rank,name_part\n"
    command = ["--store", str(tmp_path / "store"), "refresh-summary", "--run-tests", "--expect", str(expect)]
    expect.write_text(head + "2021,WR,halfppr_tot_rnk,1,name 7\n2021,WR,fullppr_ppg_rnk,2,Name 6\n")
    assert run(spark, command) == 0
    assert "false" not in capsys.readouterr().out.lower()
    expect.write_text(head + "2021,WR,halfppr_tot_rnk,1,name 3\n")
    assert run(spark, command) == 1
    out = capsys.readouterr().out
    assert all(f"Name {i}" in out for i in (7, 6, 5, 4, 3)) and "Name 2" not in out
