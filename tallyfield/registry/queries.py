"""name -> callable(spark, sf_dir): the library run over the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.functions import scoring
from tallyfield.functions import typing as t
from tallyfield.operators import matching, quality, replace
from tallyfield.operators.bands import around
from tallyfield.operators.ranking import rank_within
from tallyfield.plans import queries as q
from tallyfield.plans import ranks, reports
from tallyfield.plans import season_summary as ss
from tallyfield.plans.refresh import extract_all, load_table, rebuild_summary, refresh_season, refresh_week
from tallyfield.registry import standins as s
from tallyfield.session import scratch_dir
from tallyfield.sources import quarantine, rankfiles
from tallyfield.sources.landing import Landing
from tallyfield.sources.warehouse import Warehouse, export, last_refresh, player_positions

Query = Callable[[SparkSession, str], DataFrame]

SEASON = 2000
POINTS = ("fantasy_points_std", "fantasy_points_half_ppr", "fantasy_points_full_ppr")

#: A custom system: bonus for catches, harsher on interceptions.
BONUS_SYSTEM = {"receptions": 1.5, "receiving_yards": 0.15, "interceptions": -3.0, "carries": 0.25}


def scored(spark: SparkSession, sf: str, *seasons: int) -> DataFrame:
    return scoring.score(s.weekly(spark, sf, *seasons))


# -- scoring ------------------------------------------------------------------------------


def score_weekly(spark, sf):
    return scored(spark, sf).select("player_id", "season", "week", *scoring.FILLED_STATS, *POINTS)


def score_with_derived_stats(spark, sf):
    out = scoring.score(s.weekly(spark, sf), derive_missing=True)
    return out.select("player_id", "season", "week", "fumbles_lost", "two_point_conversions", *POINTS)


def custom_system(spark, sf):
    systems = scoring.with_system(scoring.builtin_systems(), "bonus", BONUS_SYSTEM)
    out = scoring.score(s.weekly(spark, sf), systems)
    return out.select("player_id", "season", "week", *POINTS, "fantasy_points_bonus")


def score_one_system(spark, sf):
    df = s.weekly(spark, sf)
    return df.select(
        "player_id", "season", "week",
        scoring.points_for(df, "half_ppr").alias("points"),
        scoring.points_for(df, "no such system").alias("fallback_points"),
    )


def top_performers(spark, sf):
    df = scored(spark, sf).select("player_id", "position", "season", "week", *POINTS)
    return scoring.top_performers(df, "half_ppr", "WR", 25, ("player_id", "season", "week", *POINTS))


def compare_systems(spark, sf):
    return scoring.compare_systems(scored(spark, sf).drop("fantasy_points_ppr"))


# -- typing -------------------------------------------------------------------------------

_TEXT_NUMBER = (
    "CASE event_id % 7 WHEN 0 THEN CAST(user_id AS STRING) WHEN 1 THEN concat(' ', CAST(user_id AS STRING), '.0 ') "
    "WHEN 2 THEN concat(CAST(user_id AS STRING), '.5') WHEN 3 THEN props WHEN 4 THEN '' WHEN 5 THEN 'nan' "
    "ELSE concat('-', CAST(user_id AS STRING), 'e1') END"
)
_TEXT_DATE = (
    "CASE event_id % 4 WHEN 0 THEN concat('2024-01-', lpad(CAST(1 + user_id % 31 AS STRING), 2, '0')) "
    "WHEN 1 THEN concat('2023-02-', lpad(CAST(1 + user_id % 31 AS STRING), 2, '0')) "
    "WHEN 2 THEN event_type ELSE '' END"
)
_TEXT_FLAG = (
    "CASE event_id % 9 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'no' WHEN 2 THEN 'Y' WHEN 3 THEN '0' WHEN 4 THEN '1' "
    "WHEN 5 THEN 'none' WHEN 6 THEN '' WHEN 7 THEN event_type ELSE 'False' END"
)
_TEXT_CELL = (
    "CASE event_id % 5 WHEN 0 THEN 'nan' WHEN 1 THEN 'None' WHEN 2 THEN '' WHEN 3 THEN 'NaN' ELSE event_type END"
)


def _texts(spark: SparkSession, sf: str, **columns: str) -> DataFrame:
    return s.project(s.read(spark, sf, "events"), {"event_id": "event_id", **columns})


def cast_numeric(spark, sf):
    df = _texts(spark, sf, text=_TEXT_NUMBER)
    return df.select(
        "event_id",
        t.to_int("text").alias("as_int"),
        t.to_double("text").alias("as_double"),
    )


def cast_temporal(spark, sf):
    df = _texts(spark, sf, text=_TEXT_DATE)
    return df.select(
        "event_id",
        F.date_format(t.to_date(F.col("text")), "yyyy-MM-dd").alias("as_date"),
        F.date_format(t.to_timestamp(F.col("text")), "yyyy-MM-dd HH:mm:ss").alias("as_timestamp"),
    )


def bool_parse(spark, sf):
    return _texts(spark, sf, text=_TEXT_FLAG).select("event_id", t.to_bool(F.col("text")).alias("flag"))


def text_clean(spark, sf):
    df = _texts(spark, sf, text=_TEXT_CELL)
    return df.select(
        "event_id",
        t.clean_text(F.col("text")).alias("cleaned"),
        t.clean_time_text(F.col("text")).alias("time_text"),
    )


def typed_table(spark, sf):
    """A landing frame of text columns into the declared types of schedules."""
    landed = _texts(
        spark, sf, game_id=s._tag("G", "event_id"), season=_TEXT_NUMBER, gameday=_TEXT_DATE,
        gametime=_TEXT_CELL, overtime=_TEXT_FLAG, spread_line=_TEXT_NUMBER, stadium=_TEXT_CELL, desc="event_type",
    ).drop("event_id")
    out = t.with_audit(t.typed(t.rename_reserved(landed), "schedules"))
    return out.select(
        "game_id", "season", F.date_format("gameday", "yyyy-MM-dd").alias("gameday"), "gametime", "overtime",
        "spread_line", "stadium", "play_description",
        (F.col("created_at").isNotNull() & F.col("updated_at").isNotNull()).alias("audited"),
    )


# -- analytic queries -----------------------------------------------------------------------


def q01(spark, sf):
    return q.top_players(scored(spark, sf, SEASON), SEASON)


def q02(spark, sf):
    return q.system_comparison(scored(spark, sf, SEASON), SEASON)


def q03(spark, sf):
    return q.volatility(scored(spark, sf, SEASON), SEASON)


def q04(spark, sf):
    return q.defense_matchups(scored(spark, sf, SEASON), SEASON)


def q05(spark, sf):
    return q.red_zone(s.plays(spark, sf, SEASON), player_positions(s.rosters(spark, sf)), SEASON)


def q06(spark, sf):
    return q.quarterback_efficiency(s.weekly(spark, sf, SEASON), SEASON)


def q07(spark, sf):
    return q.running_back_workload(s.weekly(spark, sf, SEASON), SEASON)


def q08(spark, sf):
    return q.team_offense(s.teams(spark, sf), s.schedules(spark, sf, SEASON), SEASON)


def q09(spark, sf):
    return q.division_standings(s.teams(spark, sf), s.schedules(spark, sf, SEASON), SEASON)


def q10(spark, sf):
    return q.consistency(scored(spark, sf, SEASON), SEASON)


def q11(spark, sf):
    return q.breakouts(scored(spark, sf, SEASON - 1, SEASON), SEASON)


def q12(spark, sf):
    return q.home_away_splits(scored(spark, sf, SEASON), s.schedules(spark, sf, SEASON), SEASON)


def q13(spark, sf):
    return q.injury_impact(scored(spark, sf, SEASON), s.injuries(spark, sf), SEASON)


def q14(spark, sf):
    return q.monthly_form(scored(spark, sf, SEASON), SEASON)


def q15(spark, sf):
    return q.weekly_trend(scored(spark, sf, SEASON), SEASON)


def q16(spark, sf):
    return q.stats_with_ranks(s.weekly(spark, sf, SEASON), s.player_ranks(spark, sf), SEASON, 1)


# -- replace, log -----------------------------------------------------------------------------


def _games(spark: SparkSession, sf: str) -> DataFrame:
    return s.schedules(spark, sf).select("game_id", "season", "week", "home_score")


def _second_load(games: DataFrame) -> DataFrame:
    """A later batch: the two last seasons with one more point, and a new column."""
    return games.where(F.col("season") >= SEASON).select(
        "game_id", "season", "week", (F.col("home_score") + 1).alias("home_score"), F.lit("new").alias("note")
    )


def replace_full(spark, sf):
    """Two loads of all players through the store; of the first one nothing stays."""
    store = Warehouse(spark, scratch_dir(spark))
    players = t.typed(s.players(spark, sf), "players")
    store.insert(players, "players")
    later = players.where("position <> 'K'").select(
        "gsis_id", "display_name", "position", (F.col("draft_number") + 1).alias("draft_number"), F.upper("position").alias("nickname")
    )
    store.insert(later, "players")
    return store.read("players").select("gsis_id", "display_name", "position", "draft_number", "weight", "nickname")


def rebuild_interrupted(spark, sf):
    """Linked rankings before a rebuild, after one that was lost just before its switch, and after a whole one."""
    store = Warehouse(spark, scratch_dir(spark))
    linked = s.player_ranks(spark, sf)
    store.rebuild(linked, "ecr_rankings")
    later = linked.where("NOT before_preseason").withColumn("rank", F.col("rank") + 1)

    def seen(at: str) -> DataFrame:
        found = store.read("ecr_rankings").groupBy("player_id", "year")
        return found.agg(F.count(F.lit(1)).alias("entries"), F.sum("rank").alias("ranks")).withColumn("at", F.lit(at))

    before = seen("before")
    store.versions.stage(later, "ecr_rankings")  # written, and then nothing more: the job is gone
    lost = seen("lost")
    store.rebuild(later, "ecr_rankings")
    return before.unionByName(lost).unionByName(seen("after"))


def store_empty_batch(spark, sf):
    """Batches without rows change nothing and count 0."""
    store = Warehouse(spark, scratch_dir(spark))
    parts = []
    for table, batch in (("teams", s.teams(spark, sf)), ("schedules", s.schedules(spark, sf))):
        store.insert(batch, table)
        written = store.insert(batch.where("false"), table)
        size = quality.table_size(store.read(table), table).select("table_name", "row_count")
        parts.append(size.withColumn("written", F.lit(written).cast("bigint")))
    return reduce(DataFrame.unionByName, parts)


def replace_season(spark, sf):
    games = _games(spark, sf)
    return replace.replace_rows(games, _second_load(games), ["season"])


def replace_season_week(spark, sf):
    games = _games(spark, sf)
    batch = _second_load(games).where((F.col("week") % 2 == 0) | F.col("week").isNull())
    return replace.replace_rows(games, batch, ["season", "week"])


def store_replace_season(spark, sf):
    """The same through the store: two loads into season partitions, then read back."""
    games = _games(spark, sf).withColumn("game_type", F.lit("REG"))
    store = Warehouse(spark, scratch_dir(spark))
    store.insert(games, "schedules")
    store.insert(_second_load(games).drop("note"), "schedules")
    return store.read("schedules").select("game_id", "season", "week", "home_score", "game_type")


def store_replace_week(spark, sf):
    """Weekly totals loaded twice; the second load brings the even weeks of the last seasons."""
    totals = s.weekly(spark, sf).groupBy("player_id", "season", "week").agg(
        F.sum("passing_yards").alias("passing_yards"), F.sum("attempts").cast("int").alias("attempts")
    )
    late = totals.where((F.col("season") >= SEASON) & (F.col("week") % 2 == 0)).withColumn("attempts", F.lit(0))
    store = Warehouse(spark, scratch_dir(spark))
    store.insert(totals, "weekly_stats")
    store.insert(late, "weekly_stats")
    return store.read("weekly_stats").select("player_id", "season", "week", "passing_yards", "attempts")


def export_roundtrip(spark, sf):
    """A query result written as CSV with a header and read back."""
    path = f"{scratch_dir(spark)}/teams.csv"
    export(q07(spark, sf), path)
    return spark.read.csv(path, header=True, schema=q07(spark, sf).schema)


def append_log(spark, sf):
    """Two seasons of unequal size loaded by the real job: one log entry each, numbered onward."""
    folder = scratch_dir(spark)
    games = s.schedules(spark, sf).where((F.col("season") != SEASON) | (F.col("week") <= 2))
    games.write.parquet(f"{folder}/landing/schedules")
    store = Warehouse(spark, f"{folder}/store")
    log = s.refresh_log(spark, sf).withColumns({"id": F.col("id").cast("int"), "refresh_date": F.col("refresh_date").cast("timestamp")})
    t.align(log, "data_refresh_log").write.parquet(store.path("data_refresh_log"))
    load_table(store, Landing(spark, f"{folder}/landing"), "schedules", [SEASON, SEASON + 1])
    return store.read("data_refresh_log").select("id", "table_name", "season", "status", "records_processed")


def store_new_column(spark, sf):
    """A later batch brings a column nobody declared; the plain read shows it, NULL before."""
    rosters = s.rosters(spark, sf).select("player_id", "season", "position")
    store = Warehouse(spark, scratch_dir(spark))
    store.insert(rosters, "rosters")
    late = rosters.where(F.col("season") >= SEASON)
    store.insert(late.withColumn("nickname", F.upper("position")), "rosters")
    return store.read("rosters").select("player_id", "season", "position", "nickname")


def query_file(spark, sf):
    """A script of two statements, run from the shared folder."""
    folder = scratch_dir(spark)
    script = (
        f"-- sizes; of the season\nSELECT 'first; statement' AS part, count(*) AS n FROM weekly_stats WHERE season = {SEASON};"
        "\nSELECT 'second' AS part, count(DISTINCT player_id) AS n FROM weekly_stats;\n"
    )
    spark.createDataFrame([(script,)], "value string").coalesce(1).write.option("lineSep", "\n\n").text(f"{folder}/sql")
    store = Warehouse(spark, f"{folder}/store")
    store.insert(s.weekly(spark, sf), "weekly_stats")
    store.register_views(["weekly_stats"])
    return reduce(DataFrame.unionByName, store.query_file(f"{folder}/sql"))


def typed_plays(spark, sf):
    """Text cells of plays into their declared types."""
    landed = _texts(
        spark, sf, play_id=s._tag("P", "event_id"), air_yards=_TEXT_NUMBER, sack=_TEXT_NUMBER, spread_line=_TEXT_NUMBER,
        series=_TEXT_NUMBER, shotgun=_TEXT_FLAG, game_date=_TEXT_DATE, stadium=_TEXT_CELL,
    ).drop("event_id")
    out = t.typed(landed, "pbp_data")
    return out.withColumn("game_date", F.date_format("game_date", "yyyy-MM-dd"))


_TEXT_SEASON = (
    "CASE event_id % 11 WHEN 3 THEN props WHEN 5 THEN '1999.5' WHEN 6 THEN 'nan' WHEN 7 THEN '99999999999' "
    "ELSE concat(CAST(1995 + event_id % 7 AS STRING), '.0') END"
)


def _rejecting_load(spark: SparkSession, sf: str) -> Warehouse:
    """Games as dirty text files, loaded by the job for the seasons from 1996 on, with a quarantine."""
    folder = scratch_dir(spark)
    landed = _texts(
        spark, sf, game_id=s._tag("G", "event_id"), season=_TEXT_SEASON, week="CAST(1 + event_id % 17 AS STRING)",
        gameday=_TEXT_DATE, overtime=_TEXT_FLAG, home_score=_TEXT_NUMBER, spread_line=_TEXT_NUMBER, stadium=_TEXT_CELL,
    ).drop("event_id")
    landed.write.option("header", True).csv(f"{folder}/landing/schedules")
    store = Warehouse(spark, f"{folder}/store")
    load_table(store, Landing(spark, f"{folder}/landing", "csv"), "schedules", range(1996, 2002), keep_rejects=True)
    return store


def load_rejects(spark, sf):
    """Cells that did not convert, by column and reason, beside the rows that were loaded all the same."""
    store = _rejecting_load(spark, sf)
    loaded = store.read("schedules").agg(F.count(F.lit(1)).alias("cells")).select(
        F.lit("schedules").alias("table_name"), F.lit("loaded").alias("column"), F.lit(None).cast("string").alias("reason"),
        "cells", F.lit(None).cast("string").alias("example"),
    )
    return quarantine.report(store, ["schedules"]).select(*loaded.columns).unionByName(loaded)


def quarantine_rows(spark, sf):
    """Every lost cell with its text, and the row it stood in as it landed."""
    cells = quarantine.cells(_rejecting_load(spark, sf), "schedules")
    row = F.from_json("landed", "game_id string, season string")
    return cells.select(row["game_id"].alias("game_id"), row["season"].alias("season_text"), "column", "reason", "text")


#: A third of all games and events is one player's.
HOT_SUPPLIER = "CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END"
HOT_USER = "CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END"
REPORT_DAY = "event_id * 37 % 2500"


def injury_days(spark, sf):
    """Points in the 28 days before and after each injury report, games and reports by date."""
    games = s.project(s.read(spark, sf, "lineitem"), {
        "player_name": s._tag("Player ", HOT_SUPPLIER), "game_date": "CAST(l_shipdate AS DATE)",
        "fantasy_points_std": "CASE WHEN l_linenumber < 6 THEN l_quantity END",
    })
    reports = s.project(s.read(spark, sf, "events"), {
        "player_name": s._tag("Player ", HOT_USER), "report_date": f"date_add(DATE '1995-01-01', CAST({REPORT_DAY} AS INT))",
        "injury_designation": s.INJURIES["injury_designation"],
    })
    return q.injury_days(games, reports).withColumn("report_date", F.date_format("report_date", "yyyy-MM-dd"))


def event_windows(spark, sf):
    """Events and their value in the six hours before and the two after each error of a user."""
    events = s.project(s.read(spark, sf, "events"), {
        "user": HOT_USER, "ts": "ts", "event_type": "event_type", "cents": "CAST(round(value * 100) AS BIGINT)",
    })
    bands = around(events, events.where("event_type = 'error'"), ["user"], "ts", ["cents"], timedelta(hours=6), timedelta(hours=2))
    return bands.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def store_known_keys(spark, sf):
    """Play keys of a batch that are stored or come twice: all plays, a quarter renamed, one season not stored."""
    plays = s.plays(spark, sf)
    store = Warehouse(spark, scratch_dir(spark))
    store.insert(plays.where(~F.col("season").eqNullSafe(F.lit(SEASON))), "pbp_data")
    renamed = F.when(F.col("yardline_100") % 8 == 1, F.concat("play_id", F.lit("x"))).otherwise(F.col("play_id"))
    batch = plays.withColumn("play_id", renamed).select("game_id", "play_id")
    twice = batch.where("play_id = '3'")
    return store.known_keys(batch.unionByName(twice), "pbp_data")


#: Table -> the stand-in that lands in it.
LANDED = {
    "teams": s.teams, "players": s.players, "schedules": s.schedules, "pbp_data": s.plays, "weekly_stats": s.weekly,
    "seasonal_stats": s.seasonal, "rosters": s.rosters, "injuries": s.injuries,
}


#: Rows of a landed JSON file at most.
JSON_FILE_ROWS = 500_000


def _loaded(spark, sf, kind: str) -> Warehouse:
    """All tables written to a landing folder and loaded by the job, two seasons of the seasonal ones."""
    folder = scratch_dir(spark)
    for table, frame in LANDED.items():
        writer = frame(spark, sf).write.option("header", True)
        if kind == "json":  # names in every row: compressed, in files that each one task reads
            writer = writer.option("compression", "gzip").option("maxRecordsPerFile", JSON_FILE_ROWS)
        writer.format(kind).save(f"{folder}/landing/{table}")
    store = Warehouse(spark, f"{folder}/store")
    extract_all(store, Landing(spark, f"{folder}/landing", kind), [SEASON, SEASON + 1])
    return store


def _rows_of(store: Warehouse) -> DataFrame:
    """Rows of each stored table, and what its log entries say."""
    log = store.read("data_refresh_log").where("status = 'SUCCESS'").groupBy("table_name").agg(
        F.sum("records_processed").cast("bigint").alias("logged_rows"), F.count(F.lit(1)).alias("entries")
    )
    return quality.table_sizes(store.frames(list(LANDED))).select("table_name", "row_count").join(log, "table_name")


def load_parquet(spark, sf):
    return _rows_of(_loaded(spark, sf, "parquet"))


def load_csv(spark, sf):
    return _rows_of(_loaded(spark, sf, "csv"))


def load_json(spark, sf):
    return _rows_of(_loaded(spark, sf, "json"))


def reload_season(spark, sf):
    """A season loaded again replaces itself."""
    folder = scratch_dir(spark)
    s.weekly(spark, sf).write.parquet(f"{folder}/landing/weekly_stats")
    store, landing = Warehouse(spark, f"{folder}/store"), Landing(spark, f"{folder}/landing")
    for season in (SEASON, SEASON + 1, SEASON):
        refresh_season(store, landing, season, ["weekly_stats"])
    refresh_week(store, landing, SEASON, 3)
    return store.read("weekly_stats").groupBy("season", "week").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("attempts").alias("attempts")
    )


def last_refresh_time(spark, sf):
    log = s.refresh_log(spark, sf)
    whole = last_refresh(log, "weekly_stats", SEASON).select(F.lit("season").alias("scope"), "last_refresh")
    week = last_refresh(log, "weekly_stats", SEASON, 3).select(F.lit("week").alias("scope"), "last_refresh")
    out = whole.unionByName(week)
    return out.select("scope", F.date_format("last_refresh", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_refresh"))


# -- rank files ---------------------------------------------------------------------------------

# Three layouts, one per file.  Lines are made from ``part``; the reader's own plan takes over
# from there.  c1.. are cells in the order of the header.
_RANK_FILE = (
    "CASE p_partkey % 3 WHEN 0 THEN 'ranks_1995_preseason.xls' WHEN 1 THEN 'ranks_1996_prepreseason.xls' "
    "ELSE 'ranks_1997_preseason.xls' END"
)
_RANK_HEADERS = {
    "ranks_1995_preseason.xls": "Rank \tPlayer Name \tPosition\tBest Rank\tWorst Rank\tAve Rank\tStd Dev\tADP\t",
    "ranks_1996_prepreseason.xls": "RK\tOverall (Team)\tPos\tBest\tWorst\tAvg.\tStd.Dev\tvs. ADP",
    "ranks_1997_preseason.xls": "Rank\tPlayer (Team)\tBest\tWorst\tAvg Rank\tStd Dev",
}
RANK_CELLS = {
    "rank_text": "CASE WHEN p_partkey % 10 = 9 THEN '' ELSE CAST(1 + p_partkey % 200 AS STRING) END",
    "name_text": (
        "CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN concat(p_name, ' (SF)') "
        "WHEN 2 THEN concat(p_name, ' CAR') ELSE CASE WHEN p_partkey % 28 = 3 THEN '' ELSE p_name END END"
    ),
    "position_text": (
        "CASE p_size % 5 WHEN 0 THEN 'RB' WHEN 1 THEN concat('wr', CAST(p_size AS STRING)) WHEN 2 THEN ' QB1' "
        "WHEN 3 THEN 'DST2' ELSE 'LB' END"
    ),
    "best_text": "CAST(p_size AS STRING)",
    "worst_text": "CASE WHEN p_size = 7 THEN 'N/A' ELSE CAST(p_size + 30 AS STRING) END",
    "avg_text": "concat(CAST(p_size AS STRING), '.25')",
    "std_text": "'1.5'",
    "adp_text": "CASE WHEN p_size % 6 = 0 THEN '' ELSE CAST(p_size * 3 AS STRING) END",
    "vs_text": "CASE WHEN p_size % 6 = 1 THEN 'N/A' ELSE CAST(p_size - 20 AS STRING) END",
}
_LINE_LAYOUTS = {
    "ranks_1995_preseason.xls": ("rank", "name", "position", "best", "worst", "avg", "std", "adp"),
    "ranks_1996_prepreseason.xls": ("rank", "name", "position", "best", "worst", "avg", "std", "vs"),
    "ranks_1997_preseason.xls": ("rank", "name", "best", "worst", "avg", "std"),
}
#: Lines per split of the made-up files; a real split is some 100 MB.
_SPLIT_LINES = 1000


def rank_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of three rank files of different layout holding every part."""
    parts = s.project(
        s.read(spark, sf, "part"),
        {"p_partkey": "p_partkey", "file_name": _RANK_FILE, **RANK_CELLS},
    )
    line: Column | None = None
    for name, cells in _LINE_LAYOUTS.items():
        text = F.concat_ws("\t", *[F.col(f"{c}_text") for c in cells])
        if name.startswith("ranks_1995"):
            text = F.concat(text, F.lit("\t"))
        hit = F.col("file_name") == name
        line = F.when(hit, text) if line is None else line.when(hit, text)
    at = F.col("p_partkey") + 10
    body = parts.select("file_name", at.alias("_at"), line.alias("value"))
    tops = ["", "site \t ", "title \t ", "subtitle \t ", ""]
    rows = ", ".join(
        f"('{f}', {n}L, '{v}')" for f, h in _RANK_HEADERS.items() for n, v in enumerate([*tops, h], 1)
    )
    head = spark.sql(f"SELECT * FROM VALUES {rows} AS t(file_name, _at, value)")
    return body.unionByName(head).select(
        "file_name", F.floor(F.col("_at") / _SPLIT_LINES).cast("bigint").alias("split"), F.col("_at").alias("at"), "value"
    )


def rank_clean(spark, sf):
    return rankfiles.normalise_rows(rankfiles.parse_rows(rank_lines(spark, sf)))


#: Lines of one made-up file: each is written by one task, however many parts there are.
FILE_LINES = 1_000_000
#: How rank files of other dialects are written: encoding, byte order mark, delimiter.
_DIALECTS = {
    "ranks_1995_preseason.xls": ("UTF-16LE", "\ufeff", "\t"),
    "ranks_1996_prepreseason.xls": ("UTF-8", "", ","),
    "ranks_1997_preseason.xls": ("ISO-8859-1", "", ";"),
}


def _rank_folder(spark, sf, file_lines: int = FILE_LINES, dialects: bool = False) -> str:
    """The same lines as text files, one layout with a long title full of commas; their folder.

    A layout's lines go to as many files as they need, each with titles and header of its own.
    """
    folder = scratch_dir(spark)
    at, number = F.col("at"), F.floor((F.col("at") - 10) / file_lines).cast("bigint")
    long_title = F.when((at == 3) & F.col("file_name").contains("1995"), F.repeat(F.lit("title, "), 300))
    lines = rank_lines(spark, sf).withColumn("value", F.coalesce(long_title, F.col("value")))
    body = lines.where(at >= 10).withColumn("file", number)
    tops = lines.where(at < 10).join(body.select("file_name", "file").distinct(), "file_name")
    every = body.unionByName(tops)
    files = spark._jvm.org.apache.hadoop.fs
    for name, (encoding, mark, delimiter) in _DIALECTS.items():
        own = every.where(F.col("file_name") == name)
        written = own.repartition("file").sortWithinPartitions("file", "at")
        value, options = F.col("value"), {}
        if dialects:
            head = F.when(at == 1, F.lit(mark)).otherwise("")
            data = F.encode(F.concat(head, F.replace(value, F.lit("\t"), F.lit(delimiter))), encoding)
            # The text writer puts out a text's bytes as they are.
            value, options = data.cast("string"), {"encoding": encoding, "lineSep": "\n"}
        written.select("file", value.alias("value")).write.partitionBy("file").options(**options).text(f"{folder}/parts/{name}")
        root = files.Path(f"{folder}/parts/{name}")
        store = root.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(files.Path(f"{folder}/ranks"))
        for part in store.listStatus(root):
            if not part.isDirectory():
                continue
            number_of = part.getPath().getName().partition("=")[2]
            data_file = next(f.getPath() for f in store.listStatus(part.getPath()) if f.getPath().getName().startswith("part-"))
            store.rename(data_file, files.Path(f"{folder}/ranks/{name.replace('.xls', f'_{number_of}.xls')}"))
    return f"{folder}/ranks"


def rankfile_read(spark, sf):
    return rankfiles.read_rankings(spark, _rank_folder(spark, sf), "ranks_*")


def rankfile_dialects(spark, sf):
    """The same files in UTF-16, with commas, and in an 8-bit encoding with semicolons, told apart by their bytes."""
    return rankfiles.read_rankings(spark, _rank_folder(spark, sf, dialects=True), "ranks_*", sniff=True)


def rankfile_report(spark, sf):
    """Rows read of each file found."""
    folder = _rank_folder(spark, sf)
    return rankfiles.file_report(
        rankfiles.list_files(spark, folder, "ranks_*"), rankfiles.read_rankings(spark, folder, "ranks_*")
    )


def rank_position(spark, sf):
    """Dense position ranks over the raw rankings table."""
    return rank_within(
        s.raw_ranks(spark, sf).select("year", "position", "player_name", "rank"), ["year", "position"],
        {"place": F.col("rank")}, method="dense_rank", descending=False,
    )


def rank_verify_years(spark, sf):
    return ranks.coverage_by_year(s.raw_ranks(spark, sf))


def rank_verify(spark, sf):
    return ranks.verify(s.raw_ranks(spark, sf))


# -- matching --------------------------------------------------------------------------------------


def match_exact(spark, sf):
    names = matching.ranked_names(s.raw_ranks(spark, sf))
    return matching.exact_matches(names, matching.roster_names(s.roster_names(spark, sf)))


def match_partial(spark, sf):
    names = matching.ranked_names(s.raw_ranks(spark, sf))
    roster = matching.roster_names(s.roster_names(spark, sf))
    return matching.partial_matches(matching.not_exact(names, roster), roster)


def _linked(spark: SparkSession, sf: str) -> DataFrame:
    return ranks.linked_rankings(s.raw_ranks(spark, sf), s.roster_names(spark, sf))


def match_final(spark, sf):
    return _linked(spark, sf)


def match_unmatched(spark, sf):
    return ranks.unmatched_names(s.raw_ranks(spark, sf), _linked(spark, sf))


def match_types(spark, sf):
    return ranks.match_types(_linked(spark, sf), s.roster_names(spark, sf))


def match_report(spark, sf):
    return ranks.match_report(s.raw_ranks(spark, sf), _linked(spark, sf))


# -- season summary -----------------------------------------------------------------------------------


def _seasonal(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.score(s.seasonal(spark, sf))


def roster_collapse(spark, sf):
    return ss.roster_summary(s.rosters(spark, sf))


def per_game(spark, sf):
    return _seasonal(spark, sf).select(
        "player_id", "season", "games", *[c.alias(n) for n, c in ss.per_game_columns().items()]
    )


def _ranked(spark, sf, totals, per_game_ranks):
    base = ss.base_rows(_seasonal(spark, sf), s.rosters(spark, sf)).select(
        "player_id", "season", "position", "games", *POINTS
    )
    return ss.position_ranks(base, totals, per_game_ranks).drop("games", *POINTS)


def rank_total(spark, sf):
    return _ranked(spark, sf, True, False)


def rank_ppg(spark, sf):
    return _ranked(spark, sf, False, True)


def rank_pivot(spark, sf):
    return ss.rankings_by_player(s.player_ranks(spark, sf))


def season_summary(spark, sf):
    return ss.season_summary(_seasonal(spark, sf), s.rosters(spark, sf), s.player_ranks(spark, sf))


def summary_sample(spark, sf):
    return ss.summary_sample(season_summary(spark, sf))


# -- quality ---------------------------------------------------------------------------------------------


def _domain(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "teams": s.teams(spark, sf),
        "schedules": s.schedules(spark, sf),
        "weekly_stats": s.weekly(spark, sf),
        "rosters": s.rosters(spark, sf),
        "data_refresh_log": s.refresh_log(spark, sf),
    }


def dq_counts(spark, sf):
    return quality.table_sizes(_domain(spark, sf))


def dq_nulls(spark, sf):
    return quality.null_profile(s.weekly(spark, sf))


def dq_high_nulls(spark, sf):
    profile = quality.null_profile(s.weekly(spark, sf))
    return quality.high_null_columns(profile, reports.ON_VALIDATE)


def dq_duplicates(spark, sf):
    games = s.schedules(spark, sf).select("season", "week", "home_team", "away_team", "home_score")
    whole = quality.repeated_rows(games).withColumn("scope", F.lit("row"))
    key = quality.repeated_rows(s.plays(spark, sf), ["game_id", "play_id"]).withColumn("scope", F.lit("key"))
    first = quality.first_column_repeats(games).withColumn("scope", F.lit("first column"))
    return whole.unionByName(key).unionByName(first)


def _seasoned(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "weekly_stats": s.weekly(spark, sf).select("season"),
        "schedules": s.schedules(spark, sf).select("season"),
        "rosters": s.rosters(spark, sf).select("season"),
    }


def dq_coverage(spark, sf):
    return quality.season_coverage(_seasoned(spark, sf))


def dq_season_lists(spark, sf):
    return quality.season_lists(_seasoned(spark, sf))


def dq_schema(spark, sf):
    """Columns of every table beside the table's size."""
    tables = {n: s.read(spark, sf, n) for n in s.ALL_GIVEN}
    sizes = quality.table_sizes(tables).select("table_name", "row_count")
    # The files hold zone-less timestamps; whether Spark says so depends on a session setting.
    columns = quality.describe(spark, tables).withColumn("column_type", F.replace("column_type", F.lit("_ntz")))
    return columns.join(sizes, "table_name")


def check_counts(spark, sf):
    return quality.same_count(s.seasonal(spark, sf), season_summary(spark, sf))


def check_unique(spark, sf):
    return quality.unique_on(season_summary(spark, sf), ["player_id", "season"])


def check_ranks(spark, sf):
    """Expected leaders: the player with the most points per season and position, by rule."""
    base = ss.base_rows(_seasonal(spark, sf), s.rosters(spark, sf)).select(
        "player_id", "player_name", "season", "position", "games", *POINTS
    )
    leaders = (
        base.where(F.col("position").isin(*ss.RANKED_POSITIONS))
        .groupBy("season", "position")
        .agg(F.max_by("player_name", "fantasy_points_half_ppr").alias("name_part"))
        .withColumn("rank", F.lit(1).cast("bigint"))
    )
    ranked = ss.position_ranks(base, True, False)
    return quality.expect_at_rank(ranked, "halfppr_tot_rnk", leaders).select(
        "season", "position", "rank", "found", "passed"
    )


def ranking_top(spark, sf):
    base = ss.base_rows(_seasonal(spark, sf), s.rosters(spark, sf)).select(
        "player_id", "player_name", "season", "position", "games", *POINTS
    )
    ranked = ss.position_ranks(base, True, False)
    return quality.top_of_ranking(ranked, "halfppr_tot_rnk", SEASON, "WR", "fantasy_points_half_ppr")


def validate_report(spark, sf):
    return reports.validation_report(_domain(spark, sf))


def validate_kept(spark, sf):
    """Sizes, seasons and NULL shares from the profiles kept by loads, after seasons and weeks were loaded again."""
    store = Warehouse(spark, scratch_dir(spark))
    games = _games(spark, sf)
    store.insert(games, "schedules")
    late = games.where(F.col("season") >= SEASON).withColumns({
        "home_score": F.when(F.col("week") % 3 != 0, F.col("home_score")), "bonus": F.col("week").cast("int"),
    })
    store.insert(late, "schedules")
    totals = s.weekly(spark, sf).groupBy("player_id", "season", "week").agg(
        F.sum("passing_yards").alias("passing_yards"), F.sum("attempts").cast("int").alias("attempts")
    )
    store.insert(totals, "weekly_stats")
    replaced = totals.where((F.col("season") >= SEASON) & (F.col("week") % 2 == 0))
    store.insert(replaced.withColumn("attempts", F.lit(None).cast("int")), "weekly_stats")
    columns = {"schedules": ["season", "week", "home_score", "bonus"], "weekly_stats": ["season", "week", "attempts", "passing_yards"]}
    report = reports.kept_report(store, list(columns), null_threshold=-1.0, duplicate_tables=())
    wanted = F.col("metric").isin("rows", "season_rows")
    for table, names in columns.items():
        wanted = wanted | ((F.col("metric") == "null_percentage") & (F.col("table_name") == table) & F.col("item").isin(names))
    return report.where(wanted)


def summary_by_change(spark, sf):
    """The season summary after one season was loaded again, and which seasons that built anew."""
    store = Warehouse(spark, scratch_dir(spark))
    seasonal = _seasonal(spark, sf)
    store.insert(seasonal, "seasonal_stats")
    store.insert(s.rosters(spark, sf), "rosters")
    store.rebuild(s.player_ranks(spark, sf), "ecr_rankings")
    rebuild_summary(store, "smry_season")
    again = seasonal.where(F.col("season") == SEASON).withColumn("fantasy_points_std", 1000.0 - F.col("fantasy_points_std"))
    store.insert(again, "seasonal_stats")
    built = rebuild_summary(store, "smry_season", only_changed=True)
    return store.read("smry_season").select(
        "player_id", "season", "position", "games", "fantasy_points_std", "std_tot_rnk", "halfppr_ppg_rnk",
        "passing_yards_per_game", "ecr_rank", F.col("season").isin(built).alias("rebuilt"),
    )


def summary_checks(spark, sf):
    return reports.summary_checks(s.seasonal(spark, sf), season_summary(spark, sf))


# -- SQL -------------------------------------------------------------------------------------------------


def sql_params(spark, sf):
    """Ad-hoc SQL with positional parameters over a stored table's view."""
    store = Warehouse(spark, scratch_dir(spark))
    store.insert(s.weekly(spark, sf), "weekly_stats")
    store.register_views(["weekly_stats"])
    return store.query(
        "SELECT team, position, count(*) AS games, sum(passing_yards) AS yards FROM weekly_stats "
        "WHERE season = ? AND week <= ? GROUP BY team, position HAVING games >= ? ORDER BY team, position",
        [SEASON, 10, 2],
    )


QUERIES: dict[str, Query] = {
    "score_weekly": score_weekly,
    "score_with_derived_stats": score_with_derived_stats,
    "custom_system": custom_system,
    "score_one_system": score_one_system,
    "top_performers": top_performers,
    "compare_systems": compare_systems,
    "cast_numeric": cast_numeric,
    "cast_temporal": cast_temporal,
    "bool_parse": bool_parse,
    "text_clean": text_clean,
    "typed_table": typed_table,
    "q01_top_players": q01,
    "q02_system_comparison": q02,
    "q03_volatility": q03,
    "q04_defense_matchups": q04,
    "q05_red_zone": q05,
    "q06_quarterback_efficiency": q06,
    "q07_running_back_workload": q07,
    "q08_team_offense": q08,
    "q09_division_standings": q09,
    "q10_consistency": q10,
    "q11_breakouts": q11,
    "q12_home_away_splits": q12,
    "q13_injury_impact": q13,
    "q14_monthly_form": q14,
    "q15_weekly_trend": q15,
    "q16_stats_with_ranks": q16,
    "replace_full": replace_full,
    "rebuild_interrupted": rebuild_interrupted,
    "store_empty_batch": store_empty_batch,
    "replace_season": replace_season,
    "replace_season_week": replace_season_week,
    "store_replace_season": store_replace_season,
    "store_replace_week": store_replace_week,
    "export_roundtrip": export_roundtrip,
    "append_log": append_log,
    "last_refresh": last_refresh_time,
    "rank_clean": rank_clean,
    "rank_position": rank_position,
    "rank_verify_years": rank_verify_years,
    "rank_verify": rank_verify,
    "match_exact": match_exact,
    "match_partial": match_partial,
    "match_final": match_final,
    "match_unmatched": match_unmatched,
    "match_types": match_types,
    "match_report": match_report,
    "roster_collapse": roster_collapse,
    "per_game": per_game,
    "rank_total": rank_total,
    "rank_ppg": rank_ppg,
    "rank_pivot": rank_pivot,
    "rankfile_read": rankfile_read,
    "store_new_column": store_new_column,
    "query_file": query_file,
    "load_parquet": load_parquet,
    "load_csv": load_csv,
    "load_json": load_json,
    "reload_season": reload_season,
    "rankfile_report": rankfile_report,
    "typed_plays": typed_plays,
    "season_summary": season_summary,
    "summary_sample": summary_sample,
    "dq_counts": dq_counts,
    "dq_nulls": dq_nulls,
    "dq_high_nulls": dq_high_nulls,
    "dq_duplicates": dq_duplicates,
    "dq_coverage": dq_coverage,
    "dq_season_lists": dq_season_lists,
    "dq_schema": dq_schema,
    "check_counts": check_counts,
    "check_unique": check_unique,
    "check_ranks": check_ranks,
    "ranking_top": ranking_top,
    "validate_report": validate_report,
    "validate_kept": validate_kept,
    "summary_by_change": summary_by_change,
    "summary_checks": summary_checks,
    "sql_params": sql_params,
    "load_rejects": load_rejects,
    "quarantine_rows": quarantine_rows,
    "store_known_keys": store_known_keys,
    "injury_days": injury_days,
    "event_windows": event_windows,
    "rankfile_dialects": rankfile_dialects,
}
