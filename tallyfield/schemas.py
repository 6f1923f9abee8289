"""Declared tables: columns, keys and how a batch replaces earlier rows.

Types: TEXT -> string, INTEGER -> int, REAL -> double (32-bit floats lose cents),
TIME -> string.  Columns are matched by name, never by position.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: column names and types of the published data set -----------------

TEAMS = """
    team_abbr string, team_name string, team_id string, team_nick string, team_conf string,
    team_division string, team_color string, team_color2 string, team_color3 string,
    team_color4 string, team_logo_wikipedia string, team_logo_espn string,
    team_wordmark string, team_conference_logo string, team_league_logo string,
    team_logo_squared string
"""

PLAYERS = """
    college_conference string, college_name string, current_team_id string,
    display_name string, draft_club string, draft_number int, draftround double,
    entry_year int, esb_id string, first_name string, football_name string,
    gsis_id string, gsis_it_id string, jersey_number int, last_name string,
    position string, position_group string, rookie_year int, short_name string,
    status string, status_description_abbr string, status_short_description string,
    team_abbr string, uniform_number string, height string, weight int, headshot string,
    smart_id string, years_of_experience string, birth_date date, team_seq double,
    suffix string
"""

SCHEDULES = """
    game_id string, season int, game_type string, week int, gameday date, weekday string,
    gametime string, away_team string, away_score int, home_team string, home_score int,
    location string, result int, total int, overtime boolean, old_game_id string,
    gsis double, nfl_detail_id string, pfr string, pff double, espn double, ftn double,
    away_rest int, home_rest int, away_moneyline int, home_moneyline int,
    spread_line double, away_spread_odds int, home_spread_odds int, total_line double,
    under_odds int, over_odds int, div_game boolean, roof string, surface string,
    temp int, wind int, away_qb_id string, home_qb_id string, away_qb_name string,
    home_qb_name string, away_coach string, home_coach string, referee string,
    stadium_id string, stadium string
"""

# Stat block shared by the weekly and the seasonal table.
_STATS = """
    completions int, attempts int, passing_yards double, passing_tds int,
    interceptions double, sacks double, sack_yards double, sack_fumbles int,
    sack_fumbles_lost int, passing_air_yards double, passing_yards_after_catch double,
    passing_first_downs double, passing_epa double, passing_2pt_conversions int,
    pacr double, dakota double, carries int, rushing_yards double, rushing_tds int,
    rushing_fumbles double, rushing_fumbles_lost double, rushing_first_downs double,
    rushing_epa double, rushing_2pt_conversions int, receptions int, targets int,
    receiving_yards double, receiving_tds int, receiving_fumbles double,
    receiving_fumbles_lost double, receiving_air_yards double,
    receiving_yards_after_catch double, receiving_first_downs double,
    receiving_epa double, receiving_2pt_conversions int, racr double,
    target_share double, air_yards_share double, {wopr} double, special_teams_tds double,
    fantasy_points double, fantasy_points_ppr double
"""

WEEKLY_STATS = """
    player_id string, player_name string, player_display_name string, position string,
    position_group string, headshot_url string, recent_team string, season int, week int,
    season_type string, opponent_team string,
""" + _STATS.format(wopr="wopr")

SEASONAL_STATS = """
    player_id string, season int, season_type string,
""" + _STATS.format(wopr="wopr_x") + """
    , games int, tgt_sh double, ay_sh double, yac_sh double, wopr_y double, ry_sh double,
    rtd_sh double, rfd_sh double, rtdfd_sh double, dom double, w8dom double,
    yptmpa double, ppr_sh double
"""

ROSTERS = """
    season int, team string, position string, depth_chart_position string,
    jersey_number int, status string, player_name string, first_name string,
    last_name string, birth_date date, height string, weight int, college string,
    player_id string, espn_id string, sportradar_id string, yahoo_id string,
    rotowire_id string, pff_id string, pfr_id string, fantasy_data_id string,
    sleeper_id string, years_exp int, headshot_url string, ngs_position string, week int,
    game_type string, status_description_abbr string, football_name string,
    esb_id string, gsis_it_id string, smart_id string, entry_year int, rookie_year int,
    draft_club string, draft_number int, age double
"""

INJURIES = """
    season int, game_type string, team string, week int, gsis_id string, position string,
    full_name string, first_name string, last_name string, report_primary_injury string,
    report_secondary_injury string, report_status string, practice_primary_injury string,
    practice_secondary_injury string, practice_status string, date_modified timestamp
"""

# The columns that queries read come first.
PLAYS = """
    play_id string, game_id string, home_team string, away_team string,
    season_type string, week int, posteam string, defteam string, yardline_100 int,
    game_date date, qtr int, down int, ydstogo int, play_description string,
    play_type string, yards_gained double, touchdown double, passer_player_id string,
    passer_player_name string, receiver_player_id string, receiver_player_name string,
    rusher_player_id string, rusher_player_name string, season int,
    fantasy_player_name string, fantasy_player_id string
"""

# Of the play table's other columns those that are not text, by type; what is not named here is
# stored as it is found, text as text.
PLAY_NUMBERS = """
    air_yards yards_after_catch no_score_prob opp_fg_prob opp_safety_prob opp_td_prob fg_prob
    safety_prob td_prob extra_point_prob two_point_conversion_prob ep epa total_home_epa
    total_away_epa total_home_rush_epa total_away_rush_epa total_home_pass_epa
    total_away_pass_epa air_epa yac_epa comp_air_epa comp_yac_epa total_home_comp_air_epa
    total_away_comp_air_epa total_home_comp_yac_epa total_away_comp_yac_epa
    total_home_raw_air_epa total_away_raw_air_epa total_home_raw_yac_epa total_away_raw_yac_epa
    wp def_wp home_wp away_wp wpa vegas_wpa vegas_home_wpa home_wp_post away_wp_post vegas_wp
    vegas_home_wp total_home_rush_wpa total_away_rush_wpa total_home_pass_wpa
    total_away_pass_wpa air_wpa yac_wpa comp_air_wpa comp_yac_wpa total_home_comp_air_wpa
    total_away_comp_air_wpa total_home_comp_yac_wpa total_away_comp_yac_wpa
    total_home_raw_air_wpa total_away_raw_air_wpa total_home_raw_yac_wpa total_away_raw_yac_wpa
    punt_inside_twenty punt_in_endzone punt_out_of_bounds punt_downed punt_fair_catch
    kickoff_inside_twenty kickoff_in_endzone kickoff_out_of_bounds kickoff_downed
    kickoff_fair_catch fumble_forced fumble_not_forced solo_tackle safety penalty
    tackled_for_loss fumble_lost own_kickoff_recovery own_kickoff_recovery_td qb_hit
    rush_attempt pass_attempt sack pass_touchdown rush_touchdown return_touchdown
    extra_point_attempt two_point_attempt field_goal_attempt kickoff_attempt punt_attempt
    passing_yards receiving_yards rushing_yards lateral_receiving_yards lateral_rushing_yards
    fumble_recovery_1_yards fumble_recovery_2_yards return_yards penalty_yards
    defensive_two_point_attempt defensive_two_point_conv defensive_extra_point_attempt
    defensive_extra_point_conv cp cpoe play_deleted special_teams_play drive_real_start_time
    drive_time_of_possession drive_play_id_started drive_play_id_ended spread_line total_line
    aborted_play success passer_jersey_number rusher_jersey_number receiver_jersey_number pass
    rush special play out_of_bounds home_opening_kickoff qb_epa xyac_epa xyac_mean_yardage
    xyac_median_yardage xyac_success xyac_fd xpass pass_oe defenders_in_box
    number_of_pass_rushers n_offense n_defense ngs_air_yards time_to_throw
"""

PLAY_COUNTS = """
    quarter_seconds_remaining half_seconds_remaining game_seconds_remaining drive ydsnet
    kick_distance home_timeouts_remaining away_timeouts_remaining posteam_timeouts_remaining
    defteam_timeouts_remaining total_home_score total_away_score posteam_score defteam_score
    score_differential posteam_score_post defteam_score_post score_differential_post series
    order_sequence play_clock fixed_drive drive_play_count drive_first_downs drive_quarter_start
    drive_quarter_end drive_yards_penalized drive_start_yard_line drive_end_yard_line away_score
    home_score result total temp wind jersey_number
"""

PLAY_FLAGS = """
    quarter_end sp goal_to_go shotgun no_huddle qb_dropback qb_kneel qb_spike qb_scramble
    timeout punt_blocked first_down_rush first_down_pass first_down_penalty third_down_converted
    third_down_failed fourth_down_converted fourth_down_failed incomplete_pass touchback
    interception fumble_out_of_bounds fumble complete_pass assist_tackle lateral_reception
    lateral_rush lateral_return lateral_recovery tackle_with_assist replay_or_challenge
    series_success drive_inside20 drive_ended_with_score div_game first_down
"""

REFRESH_LOG = """
    id int, table_name string, season int, week int, season_type string,
    refresh_date timestamp, status string, error_message string, records_processed int
"""

RAW_RANKS = """
    year int, before_preseason boolean, player_name string, position string, rank double,
    best_rank double, worst_rank double, avg_rank double, stddev_rank double, adp double,
    vs_adp double, position_rank bigint
"""

LINKED_RANKS = RAW_RANKS + ", player_id string"

#: Columns renamed because the plain name is a SQL keyword.
RESERVED_RENAMES = {
    "desc": "play_description",
    "order": "play_order",
    "time": "game_time",
    "date": "game_date_field",
}

AUDIT_COLUMNS = ("created_at", "updated_at")
REFRESH_STATUSES = ("SUCCESS", "FAILED", "IN_PROGRESS")

# --- end of fixed values -----------------------------------------------------------


_SQL_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


#: Type of each play column named above.
PLAY_TYPES = {
    name: kind
    for kind, names in (("double", PLAY_NUMBERS), ("int", PLAY_COUNTS), ("boolean", PLAY_FLAGS))
    for name in names.split()
}


@dataclass(frozen=True)
class TableSpec:
    """One stored table.

    ``replace_by`` lists the partition columns whose values, when present in a batch,
    replace the earlier rows.  Empty with ``full_replace`` means the whole table is
    replaced; empty without it means plain append.
    """

    name: str
    ddl: str
    key: tuple[str, ...] = ()
    replace_by: tuple[str, ...] = ()
    full_replace: bool = False
    scored: bool = False
    by_season: bool = True

    @property
    def types(self) -> dict[str, T.DataType]:
        return {name: _SQL_TYPES[t] for name, t in (c.split() for c in self.ddl.split(","))}

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t) for n, t in self.types.items()])


TABLES: dict[str, TableSpec] = {
    t.name: t
    for t in (
        TableSpec("teams", TEAMS, ("team_abbr",), full_replace=True, by_season=False),
        TableSpec("players", PLAYERS, ("gsis_id",), full_replace=True, by_season=False),
        TableSpec("schedules", SCHEDULES, ("game_id",), ("season",)),
        TableSpec("weekly_stats", WEEKLY_STATS,
                  ("player_id", "season", "week", "season_type"), ("season", "week"), scored=True),
        TableSpec("seasonal_stats", SEASONAL_STATS,
                  ("player_id", "season", "season_type"), ("season",), scored=True),
        TableSpec("rosters", ROSTERS, ("player_id", "season", "week", "team"), ("season",)),
        TableSpec("pbp_data", PLAYS, ("game_id", "play_id"), ("season",)),
        TableSpec("injuries", INJURIES, ("gsis_id", "season", "week"), ("season",)),
        TableSpec("data_refresh_log", REFRESH_LOG, ("id",), by_season=False),
        TableSpec("raw_ecr_rankings", RAW_RANKS, full_replace=True, by_season=False),
        TableSpec("ecr_rankings", LINKED_RANKS, full_replace=True, by_season=False),
        TableSpec("smry_season", "player_id string, season int", ("player_id", "season"),
                  full_replace=True, by_season=False),
    )
}

#: Tables one season refresh reloads, in order.
SEASON_TABLES = ("pbp_data", "weekly_stats", "seasonal_stats", "rosters", "injuries")

#: Tables a multi-season load fills, in order.
LOAD_TABLES = ("teams", "players", "schedules") + SEASON_TABLES

#: Tables whose whole-row repeats are counted by the quality report.
DUPLICATE_CHECKED = ("teams", "players", "schedules")

#: Tables listed in the season coverage report.
COVERAGE_TABLES = ("weekly_stats", "seasonal_stats", "pbp_data", "schedules")


def table_schema(table: str, found: T.StructType) -> tuple[T.StructType, list[str]]:
    """Stored schema of a frame with schema ``found``, and the key columns it has.

    Keys are a promise the quality checks test; nothing enforces them.
    """
    fields = [
        T.StructField(f.name, f.dataType if f.name in AUDIT_COLUMNS else declared_type(table, f.name, f.dataType))
        for f in found.fields
    ]
    fields += [T.StructField(c, T.TimestampType()) for c in AUDIT_COLUMNS if c not in found.names]
    key = TABLES[table].key if table in TABLES else ()
    return T.StructType(fields), [k for k in key if k in found.names]


def declared_type(table: str, column: str, found: T.DataType) -> T.DataType:
    """Type of ``column`` in ``table``: declared name first, then what was found."""
    spec = TABLES.get(table)
    if spec is not None and column in spec.types:
        return spec.types[column]
    if table == "pbp_data" and column in PLAY_TYPES:
        return _SQL_TYPES[PLAY_TYPES[column]]
    return fallback_type(found)


def fallback_type(found: T.DataType) -> T.DataType:
    """Storage type for a column nobody declared."""
    if isinstance(found, (T.ByteType, T.ShortType, T.IntegerType)):
        return T.IntegerType()
    if isinstance(found, (T.FloatType, T.DoubleType, T.DecimalType)):
        return T.DoubleType()
    if isinstance(found, (T.LongType, T.BooleanType, T.DateType, T.TimestampType)):
        return found
    if isinstance(found, T.TimestampNTZType):
        return T.TimestampType()
    return T.StringType()
