import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfield.functions import names
from tallyfield.functions import typing as t
from tallyfield.schemas import PLAY_TYPES, TABLES, declared_type, table_schema


def values(spark, texts, column):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_numbers(spark):
    texts = ["7", " 7.0 ", "7.5", "abc", "", None, "1e3", "12d", "nan", "-0.5", ".5", "99999999999"]
    assert values(spark, texts, t.to_double("x")) == [
        7.0, 7.0, 7.5, None, None, None, 1000.0, None, None, -0.5, 0.5, 99999999999.0,
    ]
    assert values(spark, texts, t.to_int("x")) == [7, 7, None, None, None, None, 1000, None, None, None, None, None]


def test_dates(spark):
    texts = ["2024-02-29", "2023-02-29", "02/03/2024", "", None]
    assert values(spark, texts, t.to_date(F.col("x"))) == [dt.date(2024, 2, 29), None, None, None, None]
    assert values(spark, texts, t.to_date(F.col("x"), ["MM/dd/yyyy"]))[2] == dt.date(2024, 2, 3)
    assert values(spark, ["2024-01-02 03:04:05", "x"], t.to_timestamp(F.col("x"))) == [dt.datetime(2024, 1, 2, 3, 4, 5), None]


def test_bool(spark):
    texts = ["TRUE", "1", "yes", "Y", "false", "0", "No", "n", "nan", "None", "", "maybe", None]
    assert values(spark, texts, t.to_bool(F.col("x"))) == [True] * 4 + [False] * 4 + [None] * 5


def test_text(spark):
    assert values(spark, ["nan", "None", "", "NaN", "a"], t.clean_text(F.col("x"))) == [None, None, None, "NaN", "a"]
    assert values(spark, ["nan", "", "13:00"], t.clean_time_text(F.col("x"))) == [None, "", "13:00"]


def test_typed_frame(spark):
    df = spark.createDataFrame(
        [("g", "2023", "2023-09-07", "nan", 1.0, "3.5", "extra", 5)],
        "game_id string, season string, gameday string, gametime string, overtime double, spread_line string, note string, n smallint",
    )
    out = t.typed(df, "schedules")
    assert out.schema["season"].dataType == T.IntegerType()
    assert out.schema["gameday"].dataType == T.DateType()
    assert out.schema["n"].dataType == T.IntegerType()
    r = out.first()
    assert (r.season, r.gametime, r.overtime, r.spread_line, r.note) == (2023, None, True, 3.5, "extra")


def test_rename_audit_align(spark):
    df = spark.createDataFrame([("p", "d", 1)], "play_id string, desc string, zzz int")
    out = t.align(t.with_audit(t.rename_reserved(df)), "pbp_data")
    assert out.columns[: len(TABLES["pbp_data"].types)] == list(TABLES["pbp_data"].types)
    assert out.columns[-3:] == ["zzz", "created_at", "updated_at"]
    assert out.first().play_description == "d"


def test_play_columns():
    text, num = T.StringType(), T.DoubleType()
    for name in ("air_yards", "yards_after_catch", "sack", "success", "spread_line", "home_wp_post", "pass_touchdown"):
        assert declared_type("pbp_data", name, text) == num
    for flag in ("shotgun", "fumble", "drive_ended_with_score", "third_down_failed", "lateral_rush", "first_down"):
        assert declared_type("pbp_data", flag, text) == T.BooleanType()
    for count in ("home_timeouts_remaining", "score_differential_post", "drive_quarter_end", "total", "posteam_score"):
        assert declared_type("pbp_data", count, text) == T.IntegerType()
    for name in ("two_point_conv_result", "solo_tackle_1_player_id", "stadium"):
        assert declared_type("pbp_data", name, text) == text
    assert len(PLAY_TYPES) + len(TABLES["pbp_data"].types) == 235
    assert declared_type("weekly_stats", "unheard_of", num) == num


def test_player_names(spark):
    texts = ["Marcus Field (SF)", " Joe Wide CIN ", "Rob Stone III", "B.J. Blue", None, "D'Arcy Hill"]
    assert values(spark, texts, names.clean_player_name(F.col("x"))) == [
        "Marcus Field", "Joe Wide", "Rob Stone", "B.J. Blue", "", "D'Arcy Hill",
    ]
    assert values(spark, texts, names.clean_player_name(F.col("x"), keep_generation=True))[2] == "Rob Stone III"


def test_positions(spark):
    texts = ["RB12", "wr3", "DST", " k1", "FLEX", None, "TE"]
    assert values(spark, texts, names.clean_position(F.col("x"))) == ["RB", "WR", "DST", "K", "FLEX", "", "TE"]
    assert values(spark, [" B.J. Blue"], names.bare_key(F.col("x"))) == ["bjblue"]


def test_table_schema():
    found = T.StructType.fromJson({"type": "struct", "fields": [
        {"name": n, "type": t, "nullable": True, "metadata": {}}
        for n, t in (("player_id", "string"), ("week", "double"), ("season", "long"), ("odd", "float"))
    ]})
    schema, key = table_schema("weekly_stats", found)
    assert [(f.name, f.dataType.simpleString()) for f in schema.fields] == [
        ("player_id", "string"), ("week", "int"), ("season", "int"), ("odd", "double"),
        ("created_at", "timestamp"), ("updated_at", "timestamp"),
    ]
    assert key == ["player_id", "season", "week"]
