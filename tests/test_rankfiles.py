import pytest

from tallyfield.sources import rankfiles as rf

TITLES = "\nsite \t \nTitle - Overall \t \nSubtitle (X) \t \n\n"


def write(folder, name, header, rows, titles=TITLES, end="\n"):
    text = titles + header + "\n" + "\n".join(rows) + "\n"
    (folder / name).write_bytes(text.replace("\n", end).encode())


@pytest.fixture()
def folder(tmp_path):
    write(
        tmp_path, "FantasyPros_2014_preseason_tiers.xls",
        " Rank \t Player Name \tPosition \tTeam \t Bye Week \tBest Rank \t Worst Rank \t Ave Rank \t Std Dev \tADP \t",
        ["1\tAl One\tRB\tKC\t6\t1\t2\t1.5\t0.5\t2\t", "2\tBo Two\tWR\tPHI\t7\t1\t7\t2.25\t1.75\t\t",
         "\tCy Three\tRB\tCHI\t9\t3\t7\t3.75\t1.3\t3\t", "2\tDi Four\tRB\tCHI\t9\t3\t7\t3.75\t1.3\t3\t"],
    )
    write(
        tmp_path, "FantasyPros_2015_prepreseason_tiers.xls",
        "Rank\tPlayer Name\tPosition\tAvg Rank\tADP",
        ["1\tRob Stone III\tQB12\t1.25\t4", "", "2\t\tWR3\t2\t9", "3\tnan\tWR4\t2\t9", "\tZed\twr5\t3\tx"], end="\r\n",
    )
    write(
        tmp_path, "FantasyPros_2017_preseason_tiers.xls",
        "RK\tOverall (Team)\tPos\tBest\tWorst\tAvg.\tStd.Dev\tvs. ADP",
        ["1\tJoe Able (SF)\tTE1\t1\t3\t2\t0.1\t-3.0", "2\tIda Baker CAR\tDST1\t1\t3\t2\t0.1\tN/A"],
        titles="\nx\ty\n\n\n\n\n",
    )
    write(tmp_path, "FantasyPros_notes_tiers.xls", "Rank\tPlayer", ["1\tNo Year"])
    write(
        tmp_path, "FantasyPros_2021_long_title.xls", "Rank\tPlayer Name\tPosition", ["1\tLong Title\tK"],
        titles="\n" + "a, b, c, " * 200 + "\n\n\n\n",
    )
    (tmp_path / "FantasyPros_2022_binary.xls").write_bytes(b"\0\1\n\n\n\n\nRank\tPlayer\n1\tBinary\n")
    write(tmp_path, "FantasyPros_2018_commas.xls", "Rank,Player", ["1,x\ty"], titles="a,b,c\nd,e,f\n\n\n")
    write(tmp_path, "FantasyPros_2020_tiers.xlsx", "Rank\tPlayer", ["1\tFrom Workbook"])
    (tmp_path / "FantasyPros_2019_empty.xls").write_text("")
    (tmp_path / "other_2020.xls").write_text("Rank\tPlayer\n1\tIgnored\n")
    return str(tmp_path)


def by_name(df):
    return {r.player_name: r for r in df.collect()}


def test_all_layouts_in_one_frame(spark, folder):
    got = by_name(rf.read_rankings(spark, folder))
    assert set(got) == {"Al One", "Bo Two", "Cy Three", "Di Four", "Rob Stone", "Zed", "Joe Able", "Ida Baker", "Long Title"}
    al = got["Al One"]
    assert (al.year, al.before_preseason, al.position, al.rank, al.adp, al.vs_adp) == (2014, False, "RB", 1.0, 2.0, None)
    assert (al.best_rank, al.worst_rank, al.avg_rank, al.stddev_rank) == (1.0, 2.0, 1.5, 0.5)
    assert got["Bo Two"].adp is None
    # a blank rank is the row's place in the file; ranks in a position are dense
    assert got["Cy Three"].rank == 3.0
    assert [got[n].position_rank for n in ("Al One", "Di Four", "Cy Three")] == [1, 2, 3]
    rg = got["Rob Stone"]
    assert (rg.before_preseason, rg.position, rg.avg_rank) == (True, "QB", 1.25)
    # blank lines are not counted, nameless rows are counted and ranked before they leave
    assert (got["Zed"].rank, got["Zed"].position, got["Zed"].position_rank, got["Zed"].adp) == (4.0, "WR", 3, None)
    joe, ida = got["Joe Able"], got["Ida Baker"]
    assert (joe.year, joe.adp, joe.vs_adp, joe.position) == (2017, 4.0, -3.0, "TE")
    assert (ida.adp, ida.vs_adp, ida.position) == (None, None, "DST")


def test_flags(spark, folder):
    assert "Rob Stone III" in by_name(rf.read_rankings(spark, folder, keep_generation=True))
    rows = rf.parse_rows(rf.read_lines(spark, folder), dict(rf.HEADER_ALIASES))
    assert by_name(rf.normalise_rows(rows))["Rob Stone"].avg_rank is None


def test_file_report(spark, folder):
    files = rf.list_files(spark, folder)
    report = {r.file_name: (r.row_count, r.status) for r in rf.file_report(files, rf.read_rankings(spark, folder)).collect()}
    assert report == {
        "FantasyPros_2014_preseason_tiers.xls": (4, "processed"),
        "FantasyPros_2015_prepreseason_tiers.xls": (2, "processed"),
        "FantasyPros_2017_preseason_tiers.xls": (2, "processed"),
        "FantasyPros_2018_commas.xls": (0, "failed"),
        "FantasyPros_2019_empty.xls": (0, "failed"),
        "FantasyPros_2020_tiers.xlsx": (0, "failed"),
        "FantasyPros_2021_long_title.xls": (1, "processed"),
        "FantasyPros_2022_binary.xls": (0, "failed"),
        "FantasyPros_notes_tiers.xls": (0, "failed"),
    }
    assert [r.file_name for r in rf.rejected_files(files).collect()] == ["FantasyPros_notes_tiers.xls"]


def test_line_order_over_many_splits(spark, tmp_path):
    """A file cut into many splits reads the same: blank ranks take the row's place."""
    rows = [f"\tPlayer {i:05d} Name\tRB" for i in range(1, 3001)]
    write(tmp_path, "FantasyPros_2016_preseason_tiers.xls", "Rank\tPlayer Name\tPosition", rows)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        lines = rf.read_lines(spark, str(tmp_path))
        assert lines.select("split").distinct().count() > 5
        got = rf.read_rankings(spark, str(tmp_path)).select("player_name", "rank", "position_rank").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got) == 3000
    assert all(r.player_name == f"Player {int(r.rank):05d} Name" and r.position_rank == int(r.rank) for r in got)
