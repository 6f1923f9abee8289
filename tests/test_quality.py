from tallyfield.operators import quality as q


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, "b"), (3, None, None)], "n int, d double, s string")
    got = {r.column_name: (r.null_count, r.row_count, round(r.null_percentage, 3)) for r in q.null_profile(df).collect()}
    assert got == {"n": (1, 3, 33.333), "d": (3, 3, 100.0)}
    assert [r.column_name for r in q.high_null_columns(q.null_profile(df), 50).collect()] == ["d"]
    assert {r.column_name for r in q.null_profile(df, df.columns).collect()} == {"n", "d", "s"}
    assert [r.null_percentage for r in q.null_profile(df.limit(0)).collect()] == [0.0, 0.0]
    assert q.null_profile(df.select("s")).count() == 0


def test_repeats(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "k int, s string")
    assert q.repeated_rows(df).first()[0] == 2
    assert q.repeated_rows(df, ["k"]).first()[0] == 3
    assert q.first_column_repeats(df).first()[0] == 4
    assert q.repeated_rows(df.limit(0)).first()[0] == 0


def test_sizes_coverage_schema(spark):
    a = spark.createDataFrame([(2020, 1), (2021, 2), (2020, 3)], "season int, x int")
    b = a.limit(0)
    assert {(r.table_name, r.row_count, r.column_count) for r in q.table_sizes({"a": a, "b": b}).collect()} == {("a", 3, 2), ("b", 0, 2)}
    assert {(r.season, r.row_count) for r in q.season_coverage({"a": a, "b": b}).collect()} == {(2020, 2), (2021, 1)}
    assert [tuple(r) for r in q.season_lists({"a": a}).collect()] == [("a", "2020,2021")]
    assert [tuple(r) for r in q.describe(spark, {"a": a}).collect()] == [("a", 1, "season", "int"), ("a", 2, "x", "int")]


def test_checks(spark):
    a = spark.createDataFrame([("p", 1), ("p", 2), ("q", 1)], "player_id string, season int")
    assert q.same_count(a, a).first().passed and not q.same_count(a, a.limit(1)).first().passed
    assert q.unique_on(a, ["player_id", "season"]).first().passed
    assert not q.unique_on(a.unionAll(a), ["player_id", "season"]).first().passed
    assert not q.unique_on(spark.createDataFrame([(None, 1)], a.schema), ["player_id", "season"]).first().passed


def test_golden_ranks(spark):
    df = spark.createDataFrame(
        [(2021, "WR", "Conrad K.", 1), (2021, "WR", "Dorian", 2), (2021, "QB", "X", 1), (2021, "QB", "Y", 1)],
        "season int, position string, player_name string, rnk bigint",
    )
    want = spark.createDataFrame(
        [(2021, "WR", "conrad", 1), (2021, "WR", "Nobody", 2), (2021, "QB", "X", 1), (2021, "TE", "Z", 1)],
        "season int, position string, name_part string, rank bigint",
    )
    got = {(r.position, r.name_part): (r.found, r.passed) for r in q.expect_at_rank(df, "rnk", want).collect()}
    assert got == {("WR", "conrad"): (1, True), ("WR", "Nobody"): (1, False), ("QB", "X"): (2, False), ("TE", "Z"): (0, False)}
