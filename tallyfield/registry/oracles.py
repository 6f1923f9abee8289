"""name -> DuckDB SQL over the driver tables, giving the same rows as the query of that name.

The SQL states each result the direct way (windows, OR joins, LIKE), so it checks the
rewrites the library makes for scale.
"""

from __future__ import annotations

from tallyfield.functions import scoring
from tallyfield.plans import season_summary as ss
from tallyfield.registry import queries as rq
from tallyfield.registry.standins import ALL_GIVEN, SQL, STATS, WEEKLY, _tag, with_tables

SEASON = rq.SEASON
PREVIOUS = SEASON - 1
POINTS = rq.POINTS

# -- pieces -------------------------------------------------------------------------------


def _rint2(x: str) -> str:
    return f"round_even(({x}) * 100e0, 0) / 100e0"


def _points(rules, have) -> str:
    terms = [f"coalesce(CAST({stat} AS DOUBLE), 0e0) * {float(w)!r}::DOUBLE" for stat, w in rules.items() if stat in have]
    return _rint2(" + ".join(["0e0", *terms]))


def _scored(table: str, extra: dict[str, str] | None = None, systems=None) -> str:
    """SELECT of ``table`` with filled stats and points columns."""
    extra = {"fumbles_lost": "0e0"} | (extra or {})
    have = [c for c in scoring.builtin_systems()["std"] if c in STATS or c in extra] + ["carries"]
    filled = [c for c in scoring.FILLED_STATS if c in STATS]
    replaced = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0e0) AS {c}" for c in filled)
    added = ", ".join(f"{e} AS {n}" for n, e in extra.items())
    pts = ", ".join(
        f"{_points(rules, have)} AS fantasy_points_{name}"
        for name, rules in (systems or scoring.builtin_systems()).items()
    )
    return f"SELECT *, {pts} FROM (SELECT * REPLACE ({replaced}), {added} FROM {table})"


def _avg2(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18, 2))) AS DOUBLE) / nullif(count({x}), 0)"


def _sum2(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18, 2))) AS DOUBLE)"


def _stddev2(x: str) -> str:
    """Sample standard deviation of hundredths, from integers."""
    h, n = f"CAST(round({x} * 100) AS HUGEINT)", f"count({x})"
    return f"sqrt(CAST({n} * sum({h} * {h}) - sum({h}) * sum({h}) AS DOUBLE) / nullif({n} * ({n} - 1), 0)) / 100"


def _big(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


_WEEKLY_SCORED = f"WITH scored AS ({_scored('weekly')}) "
_SKILL = "('QB', 'RB', 'WR', 'TE')"
_POINT_LIST = ", ".join(POINTS)


def _from_weekly(body: str) -> str:
    return with_tables(["weekly"], _WEEKLY_SCORED + body)


ORACLES: dict[str, str] = {}

# -- scoring --------------------------------------------------------------------------------

ORACLES["score_weekly"] = _from_weekly(
    f"SELECT player_id, season, week, {', '.join(scoring.FILLED_STATS)}, {_POINT_LIST} FROM scored"
)


def _sum_of(parts) -> str:
    return " + ".join(f"coalesce(CAST({p} AS DOUBLE), 0e0)" for p in parts)


ORACLES["score_with_derived_stats"] = with_tables(
    ["weekly"],
    "WITH scored AS ("
    + _scored("weekly", {n: _sum_of(parts) for n, parts in scoring.DERIVED_STATS.items()})
    + f") SELECT player_id, season, week, fumbles_lost, two_point_conversions, {_POINT_LIST} FROM scored",
)

ORACLES["custom_system"] = with_tables(
    ["weekly"],
    "WITH scored AS ("
    + _scored("weekly", systems=scoring.builtin_systems() | {"bonus": rq.BONUS_SYSTEM})
    + f") SELECT player_id, season, week, {_POINT_LIST}, fantasy_points_bonus FROM scored",
)

ORACLES["score_one_system"] = _from_weekly(
    "SELECT player_id, season, week, fantasy_points_half_ppr AS points, fantasy_points_std AS fallback_points FROM scored"
)

ORACLES["top_performers"] = _from_weekly(
    f"SELECT player_id, position, season, week, {_POINT_LIST} FROM scored WHERE position = 'WR' "
    f"ORDER BY fantasy_points_half_ppr DESC NULLS LAST, player_id, season, week, {_POINT_LIST} LIMIT 25"
)

ORACLES["compare_systems"] = _from_weekly(
    f"SELECT player_id, player_name, position, team, {_POINT_LIST}, "
    f"{_rint2('fantasy_points_full_ppr - fantasy_points_std')} AS ppr_advantage FROM scored"
)

# -- typing -----------------------------------------------------------------------------------


def _texts(**columns: str) -> str:
    return "SELECT event_id, " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + " FROM events"


_DBL = "TRY_CAST(CASE WHEN lower(trim({0})) IN ('nan', '') THEN NULL ELSE trim({0}) END AS DOUBLE)"


def _dbl(c: str) -> str:
    return _DBL.format(c)


def _int(c: str) -> str:
    return f"CASE WHEN {_dbl(c)} = floor({_dbl(c)}) THEN TRY_CAST({_dbl(c)} AS INTEGER) END"


def _flag(c: str) -> str:
    return (
        f"CASE WHEN lower({c}) IN ('true', '1', 'yes', 'y') THEN true "
        f"WHEN lower({c}) IN ('false', '0', 'no', 'n') THEN false END"
    )


def _clean(c: str) -> str:
    return f"CASE WHEN {c} NOT IN ('nan', 'None', '') THEN {c} END"


ORACLES["cast_numeric"] = (
    f"SELECT event_id, {_int('text')} AS as_int, {_dbl('text')} AS as_double FROM ({_texts(text=rq._TEXT_NUMBER)})"
)
ORACLES["cast_temporal"] = (
    "SELECT event_id, strftime(TRY_CAST(text AS DATE), '%Y-%m-%d') AS as_date, "
    "strftime(TRY_CAST(text AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS as_timestamp "
    f"FROM ({_texts(text=rq._TEXT_DATE)})"
)
ORACLES["bool_parse"] = f"SELECT event_id, {_flag('text')} AS flag FROM ({_texts(text=rq._TEXT_FLAG)})"
ORACLES["text_clean"] = (
    f"SELECT event_id, {_clean('text')} AS cleaned, nullif(text, 'nan') AS time_text FROM ({_texts(text=rq._TEXT_CELL)})"
)
ORACLES["typed_table"] = (
    f"SELECT {_tag('G', 'event_id')} AS game_id, {_int('num')} AS season, "
    "strftime(TRY_CAST(day AS DATE), '%Y-%m-%d') AS gameday, nullif(cell, 'nan') AS gametime, "
    f"{_flag('flag')} AS overtime, {_dbl('num')} AS spread_line, {_clean('cell')} AS stadium, "
    "event_type AS play_description, true AS audited FROM ("
    + _texts(num=rq._TEXT_NUMBER, day=rq._TEXT_DATE, cell=rq._TEXT_CELL, flag=rq._TEXT_FLAG, event_type="event_type")
    + ")"
)

# -- analytic queries ---------------------------------------------------------------------------

ORACLES["q01_top_players"] = _from_weekly(f"""
    SELECT player_name, position, team, count(*) AS games_played,
           {_avg2('fantasy_points_std')} AS avg_fantasy_points,
           {_sum2('fantasy_points_std')} AS total_fantasy_points
    FROM scored WHERE season = {SEASON} AND position IN {_SKILL}
    GROUP BY player_name, position, team HAVING count(*) >= 10
    ORDER BY position, avg_fantasy_points DESC""")

ORACLES["q02_system_comparison"] = _from_weekly(f"""
    SELECT player_name, position, team,
           {_avg2('fantasy_points_std')} AS avg_std,
           {_avg2('fantasy_points_full_ppr')} AS avg_ppr,
           {_avg2('fantasy_points_full_ppr - fantasy_points_std')} AS ppr_advantage
    FROM scored WHERE season = {SEASON} AND position IN ('RB', 'WR', 'TE')
    GROUP BY player_name, position, team HAVING count(*) >= 10
    ORDER BY ppr_advantage DESC""")

ORACLES["q03_volatility"] = _from_weekly(f"""
    SELECT player_name, position, team,
           {_avg2('fantasy_points_std')} AS avg_points,
           {_stddev2('fantasy_points_std')} AS volatility,
           min(fantasy_points_std) AS min_points, max(fantasy_points_std) AS max_points
    FROM scored WHERE season = {SEASON} AND position = 'RB'
    GROUP BY player_name, position, team HAVING count(*) >= 10
    ORDER BY volatility""")

ORACLES["q04_defense_matchups"] = _from_weekly(f"""
    SELECT opponent_team AS defense, position, count(*) AS games,
           {_avg2('fantasy_points_std')} AS avg_points_allowed,
           avg(passing_yards) AS avg_pass_yards, avg(rushing_yards) AS avg_rush_yards,
           avg(receiving_yards) AS avg_rec_yards
    FROM scored WHERE season = {SEASON} AND position IN {_SKILL}
    GROUP BY opponent_team, position
    ORDER BY position, avg_points_allowed DESC""")

ORACLES["q05_red_zone"] = with_tables(["plays", "rosters"], f"""
    WITH pos AS (SELECT player_id, max(position) AS position FROM rosters WHERE player_id IS NOT NULL GROUP BY 1),
    p AS (SELECT plays.*, pos.position, fantasy_player_name AS player_name, posteam AS team
          FROM plays LEFT JOIN pos ON fantasy_player_id = pos.player_id)
    SELECT player_name, position, team,
           count(CASE WHEN touchdown = 1 THEN 1 END) AS touchdowns,
           count(CASE WHEN yardline_100 <= 20 THEN 1 END) AS redzone_plays,
           round(count(CASE WHEN touchdown = 1 THEN 1 END) * 100e0
                 / nullif(count(CASE WHEN yardline_100 <= 20 THEN 1 END), 0), 2) AS redzone_td_rate
    FROM p
    WHERE season = {SEASON} AND yardline_100 <= 20
      AND (passer_player_name IS NOT NULL OR rusher_player_name IS NOT NULL OR receiver_player_name IS NOT NULL)
    GROUP BY player_name, position, team
    HAVING count(CASE WHEN yardline_100 <= 20 THEN 1 END) >= 10
    ORDER BY redzone_td_rate DESC""")

ORACLES["q06_quarterback_efficiency"] = with_tables(["weekly"], f"""
    SELECT player_name, team, {_big('attempts')} AS total_attempts, {_big('completions')} AS total_completions,
           round(sum(completions) * 100e0 / nullif(sum(attempts), 0), 2) AS completion_pct,
           sum(passing_yards) AS total_yards,
           round(sum(passing_yards) * 1e0 / nullif(sum(attempts), 0), 2) AS yards_per_attempt,
           {_big('passing_tds')} AS total_tds, sum(interceptions) AS total_ints,
           round(sum(passing_tds) * 1e0 / nullif(sum(interceptions), 0), 2) AS td_int_ratio
    FROM weekly WHERE season = {SEASON} AND position = 'QB'
    GROUP BY player_name, team HAVING sum(attempts) >= 100
    ORDER BY yards_per_attempt DESC""")

ORACLES["q07_running_back_workload"] = with_tables(["weekly"], f"""
    SELECT player_name, team, count(*) AS games_played, {_big('carries')} AS total_carries,
           round(sum(carries) * 1e0 / count(*), 2) AS carries_per_game,
           {_big('targets')} AS total_targets, round(sum(targets) * 1e0 / count(*), 2) AS targets_per_game,
           {_big('carries + targets')} AS total_touches,
           round(sum(carries + targets) * 1e0 / count(*), 2) AS touches_per_game
    FROM weekly WHERE season = {SEASON} AND position = 'RB'
    GROUP BY player_name, team HAVING count(*) >= 10
    ORDER BY touches_per_game DESC""")

_WON = (
    "(home_team = team_abbr AND home_score > away_score) OR (away_team = team_abbr AND away_score > home_score)"
)
_LOST = (
    "(home_team = team_abbr AND home_score < away_score) OR (away_team = team_abbr AND away_score < home_score)"
)
_SCORED_BY = "CASE WHEN home_team = team_abbr THEN home_score WHEN away_team = team_abbr THEN away_score END"
_TEAM_JOIN = (
    "FROM teams LEFT JOIN schedules ON (home_team = team_abbr OR away_team = team_abbr) "
    f"WHERE season = {SEASON} AND season_type = 'REG'"
)

ORACLES["q08_team_offense"] = with_tables(["teams", "schedules"], f"""
    SELECT team_name, team_division, count(DISTINCT game_id) AS games_played,
           {_big(_SCORED_BY)} AS total_points,
           round(sum({_SCORED_BY}) * 1e0 / count(DISTINCT game_id), 2) AS points_per_game,
           {_big(f'CASE WHEN {_WON} THEN 1 ELSE 0 END')} AS wins,
           round(sum(CASE WHEN {_WON} THEN 1 ELSE 0 END) * 100e0 / count(DISTINCT game_id), 2) AS win_pct
    {_TEAM_JOIN} GROUP BY team_name, team_division, team_abbr ORDER BY points_per_game DESC""")

ORACLES["q09_division_standings"] = with_tables(["teams", "schedules"], f"""
    SELECT team_division, team_name, count(DISTINCT game_id) AS games_played,
           {_big(f'CASE WHEN {_WON} THEN 1 ELSE 0 END')} AS wins,
           {_big(f'CASE WHEN {_LOST} THEN 1 ELSE 0 END')} AS losses,
           round(sum(CASE WHEN {_WON} THEN 1 ELSE 0 END) * 100e0 / count(DISTINCT game_id), 2) AS win_pct
    {_TEAM_JOIN} GROUP BY team_division, team_name, team_abbr ORDER BY team_division, win_pct DESC""")

ORACLES["q10_consistency"] = _from_weekly(f"""
    SELECT player_name, position, team, count(*) AS games, {_avg2('fantasy_points_std')} AS avg_points,
           {_stddev2('fantasy_points_std')} AS std_dev,
           round({_stddev2('fantasy_points_std')} / nullif({_avg2('fantasy_points_std')}, 0), 3) AS coefficient_of_variation
    FROM scored WHERE season = {SEASON} AND position IN {_SKILL}
    GROUP BY player_name, position, team
    HAVING count(*) >= 10 AND {_avg2('fantasy_points_std')} > 5
    ORDER BY coefficient_of_variation""")


def _season_means(season: int) -> str:
    return (
        f"SELECT player_name, position, team, {_avg2('fantasy_points_std')} AS avg_{season} FROM scored "
        f"WHERE season = {season} GROUP BY player_name, position, team HAVING count(*) >= 10"
    )


ORACLES["q11_breakouts"] = with_tables(["weekly"], f"""
    WITH scored AS ({_scored('weekly')}), c AS ({_season_means(SEASON)}), p AS ({_season_means(PREVIOUS)})
    SELECT c.player_name, c.position, c.team, p.avg_{PREVIOUS}, c.avg_{SEASON},
           round(c.avg_{SEASON} - p.avg_{PREVIOUS}, 2) AS improvement,
           round((c.avg_{SEASON} - p.avg_{PREVIOUS}) / nullif(p.avg_{PREVIOUS}, 0) * 100, 2) AS improvement_pct
    FROM c JOIN p ON c.player_name = p.player_name
    WHERE c.avg_{SEASON} > p.avg_{PREVIOUS} ORDER BY improvement_pct DESC""")

_HOME = "CASE WHEN home_team = team THEN fantasy_points_std END"
_AWAY = "CASE WHEN away_team = team THEN fantasy_points_std END"
ORACLES["q12_home_away_splits"] = with_tables(["weekly", "schedules"], f"""
    WITH scored AS ({_scored('weekly')}),
    j AS (SELECT player_name, position, team, home_team, away_team, fantasy_points_std
          FROM scored JOIN schedules ON team = home_team OR team = away_team
          WHERE scored.season = {SEASON} AND schedules.season = {SEASON} AND position = 'QB')
    SELECT player_name, position, team,
           count(CASE WHEN home_team = team THEN 1 END) AS home_games, round({_avg2(_HOME)}, 2) AS home_avg,
           count(CASE WHEN away_team = team THEN 1 END) AS away_games, round({_avg2(_AWAY)}, 2) AS away_avg,
           round({_avg2(_HOME)} - {_avg2(_AWAY)}, 2) AS home_advantage
    FROM j GROUP BY player_name, position, team
    HAVING count(CASE WHEN home_team = team THEN 1 END) >= 5 AND count(CASE WHEN away_team = team THEN 1 END) >= 5
    ORDER BY home_advantage DESC""")

_PRE = "CASE WHEN week < hurt THEN fantasy_points_std END"
_POST = "CASE WHEN week > hurt THEN fantasy_points_std END"
ORACLES["q13_injury_impact"] = with_tables(["weekly", "injuries"], f"""
    WITH scored AS ({_scored('weekly')}),
    j AS (SELECT w.player_name, w.position, w.team, w.week, i.week AS hurt, fantasy_points_std
          FROM scored w JOIN injuries i ON w.player_name = i.player_name AND w.season = i.season
          WHERE w.season = {SEASON} AND injury_designation <> 'Healthy')
    SELECT player_name, position, team, {_avg2(_PRE)} AS pre_injury_avg, {_avg2(_POST)} AS post_injury_avg,
           count(CASE WHEN week < hurt THEN 1 END) AS pre_injury_games,
           count(CASE WHEN week > hurt THEN 1 END) AS post_injury_games
    FROM j GROUP BY player_name, position, team
    HAVING count(CASE WHEN week < hurt THEN 1 END) >= 3 AND count(CASE WHEN week > hurt THEN 1 END) >= 3""")

ORACLES["q14_monthly_form"] = _from_weekly(f"""
    SELECT player_name, position, team,
           CASE WHEN week <= 4 THEN 'September' WHEN week <= 8 THEN 'October' WHEN week <= 12 THEN 'November'
                WHEN week <= 16 THEN 'December' ELSE 'January' END AS month,
           count(*) AS games, {_avg2('fantasy_points_std')} AS avg_points
    FROM scored WHERE season = {SEASON} AND position = 'RB'
    GROUP BY player_name, position, team, month HAVING count(*) >= 2
    ORDER BY player_name, month""")

ORACLES["q15_weekly_trend"] = _from_weekly(f"""
    SELECT week, count(*) AS player_performances, {_avg2('fantasy_points_std')} AS avg_std_points,
           {_avg2('fantasy_points_full_ppr')} AS avg_ppr_points,
           min(fantasy_points_std) AS min_points, max(fantasy_points_std) AS max_points
    FROM scored WHERE season = {SEASON} AND position IN {_SKILL} GROUP BY week ORDER BY week""")

ORACLES["q16_stats_with_ranks"] = with_tables(["weekly", "player_ranks"], f"""
    SELECT player_name, position, team, fantasy_points_ppr, r.rank AS ecr_rank
    FROM weekly w LEFT JOIN player_ranks r ON w.player_id = r.player_id AND w.season = r.year
    WHERE w.season = {SEASON} AND w.week = 1
    ORDER BY fantasy_points_ppr DESC NULLS LAST, w.player_id, r.rank LIMIT 20""")

# -- replace, log ----------------------------------------------------------------------------------

ORACLES["replace_full"] = with_tables(["players"], """
    SELECT gsis_id, nullif(display_name, 'nan') AS display_name, position,
           TRY_CAST(draft_number AS INTEGER) + 1 AS draft_number, CAST(NULL AS INTEGER) AS weight,
           upper(position) AS nickname FROM players WHERE position <> 'K'""")
ORACLES["rebuild_interrupted"] = with_tables(["player_ranks"], """
    WITH r AS (SELECT player_id, year, before_preseason, rank FROM player_ranks)
    SELECT 'before' AS at, player_id, year, count(*) AS entries, sum(rank) AS ranks FROM r GROUP BY player_id, year
    UNION ALL SELECT 'lost', player_id, year, count(*), sum(rank) FROM r GROUP BY player_id, year
    UNION ALL SELECT 'after', player_id, year, count(*), sum(rank + 1) FROM r WHERE NOT before_preseason GROUP BY player_id, year""")
ORACLES["store_empty_batch"] = with_tables(["teams", "schedules"], """
    SELECT 'teams' AS table_name, count(*) AS row_count, CAST(0 AS BIGINT) AS written FROM teams
    UNION ALL SELECT 'schedules', count(*), CAST(0 AS BIGINT) FROM schedules""")
_NEW_GAMES = f"SELECT game_id, season, week, home_score + 1 AS home_score, 'new' AS note FROM schedules WHERE season >= {SEASON}"
ORACLES["replace_season"] = with_tables(["schedules"], f"""
    SELECT game_id, season, week, home_score, CAST(NULL AS VARCHAR) AS note FROM schedules WHERE season < {SEASON}
    UNION ALL {_NEW_GAMES}""")
ORACLES["replace_season_week"] = with_tables(["schedules"], f"""
    SELECT game_id, season, week, home_score, CAST(NULL AS VARCHAR) AS note FROM schedules
    WHERE NOT (season >= {SEASON} AND week % 2 = 0)
    UNION ALL {_NEW_GAMES} AND week % 2 = 0""")
ORACLES["store_replace_season"] = with_tables(["schedules"], f"""
    SELECT game_id, season, week, home_score, 'REG' AS game_type FROM schedules WHERE season < {SEASON}
    UNION ALL
    SELECT game_id, season, week, home_score + 1, CAST(NULL AS VARCHAR) FROM schedules WHERE season >= {SEASON}""")
ORACLES["store_replace_week"] = with_tables(["weekly"], f"""
    SELECT player_id, season, week, sum(passing_yards) AS passing_yards,
           CAST(CASE WHEN season >= {SEASON} AND week % 2 = 0 THEN 0 ELSE sum(attempts) END AS INTEGER) AS attempts
    FROM weekly GROUP BY player_id, season, week""")
ORACLES["export_roundtrip"] = ORACLES["q07_running_back_workload"]
ORACLES["append_log"] = with_tables(["refresh_log", "schedules"], f"""
    WITH asked AS (SELECT unnest([{SEASON}, {SEASON} + 1]) AS season)
    SELECT id, table_name, season, status, records_processed FROM refresh_log
    UNION ALL
    SELECT (SELECT max(id) FROM refresh_log) + row_number() OVER (ORDER BY a.season), 'schedules', a.season, 'SUCCESS',
           CAST((SELECT count(*) FROM schedules g WHERE g.season = a.season AND (g.season > {SEASON} OR g.week <= 2)) AS INTEGER)
    FROM asked a""")
ORACLES["store_new_column"] = with_tables(["rosters"], f"""
    SELECT player_id, season, position, CASE WHEN season >= {SEASON} THEN upper(position) END AS nickname FROM rosters""")
ORACLES["query_file"] = with_tables(["weekly"], f"""
    SELECT 'first; statement' AS part, count(*) AS n FROM weekly WHERE season = {SEASON}
    UNION ALL SELECT 'second', count(DISTINCT player_id) FROM weekly""")
ORACLES["typed_plays"] = (
    f"SELECT {_tag('P', 'event_id')} AS play_id, {_dbl('num')} AS air_yards, {_dbl('num')} AS sack, {_dbl('num')} AS spread_line, "
    f"{_int('num')} AS series, {_flag('flag')} AS shotgun, strftime(TRY_CAST(day AS DATE), '%Y-%m-%d') AS game_date, "
    f"{_clean('cell')} AS stadium FROM ("
    + _texts(num=rq._TEXT_NUMBER, day=rq._TEXT_DATE, cell=rq._TEXT_CELL, flag=rq._TEXT_FLAG) + ")"
)
_LAST = (
    "strftime(max(refresh_date), '%Y-%m-%d %H:%M:%S.%f') AS last_refresh FROM refresh_log "
    f"WHERE table_name = 'weekly_stats' AND season = {SEASON} AND status = 'SUCCESS'"
)
ORACLES["last_refresh"] = with_tables(
    ["refresh_log"], f"SELECT 'season' AS scope, {_LAST} UNION ALL SELECT 'week' AS scope, {_LAST} AND week = 3"
)

# -- rankings ----------------------------------------------------------------------------------------

def _rank_rows(file_name: str) -> str:
    cells = ", ".join(f"{e} AS {n}" for n, e in rq.RANK_CELLS.items())
    return f"SELECT p_partkey, {file_name} AS file_name, {cells} FROM part"


def _num(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


def rank_clean(file_name: str) -> str:
    """Rankings of all parts, their lines dealt to files by an SQL expression."""
    return f"""
    WITH cells AS ({_rank_rows(file_name)}),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY p_partkey) AS row_no FROM cells),
    clean AS (
      SELECT file_name, CAST(substring(file_name, 7, 4) AS INTEGER) AS year,
             file_name LIKE '%prepreseason%' AS before_preseason,
             trim(replace(replace(name_text, '(SF)', ''), ' CAR', '')) AS player_name,
             CASE WHEN file_name LIKE '%1997%' THEN ''
                  WHEN trim(position_text) LIKE 'wr%' THEN 'WR' WHEN trim(position_text) LIKE 'QB%' THEN 'QB'
                  WHEN position_text LIKE 'DST%' THEN 'DST' ELSE position_text END AS position,
             coalesce({_num("nullif(rank_text, '')")}, CAST(row_no AS DOUBLE)) AS rank,
             {_num('best_text')} AS best_rank, {_num('worst_text')} AS worst_rank, {_num('avg_text')} AS avg_rank,
             {_num('std_text')} AS stddev_rank,
             CASE WHEN file_name LIKE '%1995%' THEN {_num("nullif(adp_text, '')")} END AS given_adp,
             CASE WHEN file_name LIKE '%1996%' THEN {_num('vs_text')} END AS vs_adp
      FROM numbered),
    ranked AS (SELECT *, dense_rank() OVER (PARTITION BY file_name, position ORDER BY rank) AS position_rank FROM clean)
    SELECT file_name, year, before_preseason, player_name, position, rank, best_rank, worst_rank, avg_rank, stddev_rank,
           CASE WHEN file_name LIKE '%1995%' THEN given_adp ELSE rank - vs_adp END AS adp, vs_adp, position_rank
    FROM ranked WHERE player_name <> ''"""


def rank_files(lines: int) -> str:
    """Name of the file a part's line is in, when files hold so many lines."""
    return f"replace({rq._RANK_FILE}, '.xls', '_' || (p_partkey // {lines}) || '.xls')"


ORACLES["rank_clean"] = rank_clean(rq._RANK_FILE)
ORACLES["rank_position"] = with_tables(["raw_ranks"], """
    SELECT year, position, player_name, rank,
           dense_rank() OVER (PARTITION BY year, position ORDER BY rank ASC NULLS LAST) AS place
    FROM raw_ranks""")
ORACLES["rank_verify_years"] = with_tables(["raw_ranks"], f"""
    SELECT year, count(*) AS total_records,
           {_big('CASE WHEN before_preseason THEN 1 ELSE 0 END')} AS before_preseason_records,
           {_big('CASE WHEN before_preseason THEN 0 ELSE 1 END')} AS after_preseason_records
    FROM raw_ranks GROUP BY year ORDER BY year""")
ORACLES["rank_verify"] = with_tables(["raw_ranks"], f"""
    SELECT count(*) AS total_records,
           {_big("CASE WHEN player_name IS NULL OR player_name = '' THEN 1 ELSE 0 END")} AS missing_player_names,
           {_big("CASE WHEN position IS NULL OR position = '' THEN 1 ELSE 0 END")} AS missing_positions,
           {_big('CASE WHEN rank IS NULL THEN 1 ELSE 0 END')} AS missing_ranks,
           {_big('CASE WHEN avg_rank IS NULL THEN 1 ELSE 0 END')} AS missing_avg_ranks,
           min(year) AS min_year, max(year) AS max_year, count(DISTINCT year) AS unique_years,
           count(DISTINCT CASE WHEN before_preseason THEN year END) AS years_with_prepreseason,
           count(DISTINCT CASE WHEN NOT before_preseason THEN year END) AS years_with_preseason
    FROM raw_ranks""")

# -- matching -----------------------------------------------------------------------------------------

_KEYS = """
    WITH e AS (SELECT *, lower(trim(player_name)) AS nk, upper(trim(position)) AS pk FROM raw_ranks),
    r AS (SELECT player_id, lower(trim(player_name)) AS nk, upper(trim(position)) AS pk FROM roster_names)"""
_PARTIAL_ON = (
    "e.pk = r.pk AND (replace(replace(e.nk, '.', ''), ' ', '') = replace(replace(r.nk, '.', ''), ' ', '') "
    "OR e.nk LIKE '%' || r.nk || '%' OR r.nk LIKE '%' || e.nk || '%')"
)
_NOT_EXACT = "NOT EXISTS (SELECT 1 FROM r r2 WHERE e.nk = r2.nk AND e.pk = r2.pk)"
_RAW = (
    "year, before_preseason, player_name, position, rank, best_rank, worst_rank, avg_rank, stddev_rank, adp, "
    "vs_adp, position_rank"
)
_LINKED = f"""{_KEYS},
    found AS (
      SELECT DISTINCT {_RAW}, r.player_id, 1 AS kind FROM e JOIN r ON e.nk = r.nk AND e.pk = r.pk
      UNION ALL
      SELECT DISTINCT {_RAW}, r.player_id, 2 AS kind FROM e JOIN r ON {_PARTIAL_ON} WHERE {_NOT_EXACT}),
    linked AS (
      SELECT {_RAW}, player_id FROM (
        SELECT *, row_number() OVER (PARTITION BY year, before_preseason, player_name, position, rank
                                     ORDER BY kind, player_id NULLS LAST) AS rn FROM found) WHERE rn = 1)"""
_MATCH = ["raw_ranks", "roster_names"]

ORACLES["match_exact"] = with_tables(_MATCH, f"""{_KEYS}
    SELECT e.nk AS name_key, e.pk AS pos_key, min(r.player_id) AS player_id
    FROM e JOIN r ON e.nk = r.nk AND e.pk = r.pk GROUP BY 1, 2""")
ORACLES["match_partial"] = with_tables(_MATCH, f"""{_KEYS}
    SELECT e.nk AS name_key, e.pk AS pos_key, min(r.player_id) AS player_id
    FROM e JOIN r ON {_PARTIAL_ON} WHERE {_NOT_EXACT} GROUP BY 1, 2""")
ORACLES["match_final"] = with_tables(_MATCH, f"{_LINKED} SELECT {_RAW}, player_id FROM linked")
ORACLES["match_unmatched"] = with_tables(_MATCH, f"""{_LINKED}
    SELECT x.player_name, x.position, count(*) AS occurrence_count
    FROM raw_ranks x LEFT JOIN linked l ON x.year = l.year AND x.before_preseason = l.before_preseason
      AND x.player_name = l.player_name AND x.position = l.position AND x.rank = l.rank
    WHERE l.player_id IS NULL GROUP BY x.player_name, x.position
    ORDER BY occurrence_count DESC, x.player_name NULLS LAST, x.position NULLS LAST LIMIT 20""")
ORACLES["match_types"] = with_tables(_MATCH, f"""{_LINKED}
    SELECT match_type, count(*) AS count FROM (
      SELECT CASE WHEN EXISTS (SELECT 1 FROM r WHERE lower(trim(l.player_name)) = r.nk AND upper(trim(l.position)) = r.pk)
                  THEN 'exact_match' ELSE 'partial_match' END AS match_type FROM linked l)
    GROUP BY match_type""")
ORACLES["match_report"] = with_tables(_MATCH, f"""{_LINKED}
    SELECT a AS total_raw_records, b AS total_matched_records,
           round(b * 1e0 / nullif(a, 0) * 100, 2) AS match_rate, a - b AS unmatched_count
    FROM (SELECT (SELECT count(*) FROM raw_ranks) AS a, (SELECT count(*) FROM linked) AS b)""")

# -- season summary --------------------------------------------------------------------------------------

_ROSTER = (
    "SELECT player_id, season, " + ", ".join(f"max({c}) AS {c}" for c in ss.ROSTER_COLUMNS)
    + " FROM rosters GROUP BY player_id, season"
)


def _per_game(c: str, prefix: str = "") -> str:
    return f"CASE WHEN {prefix}games > 0 THEN CAST({prefix}{c} AS DOUBLE) / {prefix}games ELSE 0e0 END"


_PER_GAME = ", ".join(f"{_per_game(c)} AS {c}_per_game" for c in ss.PER_GAME_STATS)
_SEASONAL_SCORED = _scored("seasonal")
_BASE = f"""
    scored AS ({_SEASONAL_SCORED}), roster_summary AS ({_ROSTER}),
    base AS (
      SELECT s.*, r.player_name, r.position, r.years_exp, r.draft_number AS draft_position, r.weight, r.height,
             CASE WHEN s.season = r.rookie_year THEN 1 ELSE 0 END AS is_rookie, {_PER_GAME}
      FROM scored s LEFT JOIN roster_summary r ON s.player_id = r.player_id AND s.season = r.season)"""


def _rank(expr: str) -> str:
    return (
        "CASE WHEN position IN ('QB', 'RB', 'WR', 'TE', 'K') THEN rank() OVER "
        f"(PARTITION BY season, position ORDER BY {expr} DESC NULLS LAST) END"
    )


_TOTAL_RANKS = ", ".join(f"{_rank(c)} AS {p}_tot_rnk" for p, c in ss.RANK_PREFIXES.items())
_PPG_RANKS = ", ".join(f"{_rank(_per_game(c))} AS {p}_ppg_rnk" for p, c in ss.RANK_PREFIXES.items())
_PIVOT = (
    "SELECT player_id, year AS season, "
    + ", ".join(
        f"min({{'at': coalesce(rank, CAST('Infinity' AS DOUBLE)), 'v': {v}}}) FILTER (WHERE before_preseason = {str(early).lower()} AND {v} IS NOT NULL)['v'] AS {prefix}_{v}"
        for prefix, early in ss.RANKING_PHASES.items() for v in ss.RANKING_VALUES
    )
    + " FROM player_ranks GROUP BY player_id, year"
)
_SUMMARY = f"""WITH {_BASE.strip()},
    ranked AS (SELECT *, {_TOTAL_RANKS}, {_PPG_RANKS} FROM base), pivoted AS ({_PIVOT}),
    summary AS (SELECT ranked.*, pivoted.* EXCLUDE (player_id, season)
                FROM ranked LEFT JOIN pivoted ON ranked.player_id = pivoted.player_id AND ranked.season = pivoted.season)"""
_SUMMARY_TABLES = ["seasonal", "rosters", "player_ranks"]

ORACLES["roster_collapse"] = with_tables(["rosters"], _ROSTER)
ORACLES["per_game"] = with_tables(
    ["seasonal"], f"SELECT player_id, season, games, {_PER_GAME} FROM ({_SEASONAL_SCORED})"
)
ORACLES["rank_total"] = with_tables(
    ["seasonal", "rosters"], f"WITH {_BASE.strip()} SELECT player_id, season, position, {_TOTAL_RANKS} FROM base"
)
ORACLES["rank_ppg"] = with_tables(
    ["seasonal", "rosters"], f"WITH {_BASE.strip()} SELECT player_id, season, position, {_PPG_RANKS} FROM base"
)
ORACLES["rank_pivot"] = with_tables(["player_ranks"], _PIVOT)
ORACLES["season_summary"] = with_tables(_SUMMARY_TABLES, f"{_SUMMARY} SELECT * FROM summary")
ORACLES["summary_sample"] = with_tables(_SUMMARY_TABLES, f"""{_SUMMARY}
    SELECT {', '.join(ss.SAMPLE_COLUMNS)} FROM summary WHERE fantasy_points_std > 0
    ORDER BY fantasy_points_std DESC, player_id, season LIMIT 5""")

# -- quality ------------------------------------------------------------------------------------------------

_SIZES = {"teams": "teams", "schedules": "schedules", "weekly_stats": "weekly", "rosters": "rosters", "data_refresh_log": "refresh_log"}


def _width(cte: str) -> int:
    from tallyfield.registry import standins as s

    return len({
        "teams": s.TEAMS, "schedules": s.SCHEDULES, "weekly": s.WEEKLY, "rosters": s.ROSTERS, "refresh_log": s.REFRESH_LOG,
    }[cte])


ORACLES["dq_counts"] = with_tables(
    list(_SIZES.values()),
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count, CAST({_width(c)} AS BIGINT) AS column_count FROM {c}"
        for n, c in _SIZES.items()
    ),
)
_NUMERIC = [c for c in WEEKLY if c in STATS or c in ("season", "week")]


def _null_rows(cte: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, count(*) AS row_count, "
        f"coalesce((count(*) - count({c})) * 100e0 / nullif(count(*), 0), 0e0) AS null_percentage FROM {cte}"
        for c in columns
    )


ORACLES["dq_nulls"] = with_tables(["weekly"], _null_rows("weekly", _NUMERIC))
ORACLES["dq_high_nulls"] = with_tables(
    ["weekly"], f"SELECT * FROM ({_null_rows('weekly', _NUMERIC)}) WHERE null_percentage > 10"
)
ORACLES["dq_duplicates"] = with_tables(["schedules", "plays"], """
    WITH g AS (SELECT season, week, home_team, away_team, home_score FROM schedules)
    SELECT (SELECT count(*) FROM g) - (SELECT count(*) FROM (SELECT DISTINCT * FROM g)) AS duplicates, 'row' AS scope
    UNION ALL
    SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT game_id, play_id FROM plays)), 'key' FROM plays
    UNION ALL
    SELECT count(*) - count(DISTINCT season), 'first column' FROM g""")


def _season_counts(names) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, season, count(*) AS row_count FROM {_SIZES[n]} GROUP BY season" for n in names
    )


_SEASONED = ("weekly_stats", "schedules", "rosters")
ORACLES["dq_coverage"] = with_tables([_SIZES[n] for n in _SEASONED], _season_counts(_SEASONED))
ORACLES["dq_season_lists"] = with_tables(
    [_SIZES[n] for n in _SEASONED],
    f"SELECT table_name, string_agg(CAST(season AS VARCHAR), ',' ORDER BY season) AS seasons "
    f"FROM ({_season_counts(_SEASONED)}) GROUP BY table_name",
)
_LISTED = ALL_GIVEN
ORACLES["dq_schema"] = f"""
    SELECT table_name, CAST(ordinal_position AS INTEGER) AS position, column_name,
           CASE WHEN data_type IN ('BIGINT', 'DOUBLE') THEN lower(data_type) WHEN data_type = 'INTEGER' THEN 'int'
                WHEN data_type = 'VARCHAR' THEN 'string' WHEN data_type = 'FLOAT[]' THEN 'array<float>'
                ELSE 'timestamp' END AS column_type,
           CASE table_name {' '.join(f"WHEN '{n}' THEN (SELECT count(*) FROM {n})" for n in _LISTED)} END AS row_count
    FROM information_schema.columns WHERE table_name IN {_LISTED}"""
ORACLES["check_counts"] = with_tables(_SUMMARY_TABLES, f"""{_SUMMARY}
    SELECT a AS left_rows, b AS right_rows, a = b AS passed
    FROM (SELECT (SELECT count(*) FROM seasonal) AS a, (SELECT count(*) FROM summary) AS b)""")
ORACLES["check_unique"] = with_tables(_SUMMARY_TABLES, f"""{_SUMMARY}
    SELECT a AS total_rows, b AS distinct_keys, a = b AS passed
    FROM (SELECT count(*) AS a, count(DISTINCT player_id || '_' || season) AS b FROM summary)""")
ORACLES["check_ranks"] = with_tables(["seasonal", "rosters"], f"""WITH {_BASE.strip()},
    ranked AS (SELECT season, position, player_name, {_rank('fantasy_points_half_ppr')} AS rank,
                      max(fantasy_points_half_ppr) OVER (PARTITION BY season, position) AS best,
                      fantasy_points_half_ppr AS pts FROM base WHERE position IN ('QB', 'RB', 'WR', 'TE', 'K'))
    SELECT season, position, CAST(1 AS BIGINT) AS rank, count(*) AS found,
           count(*) = 1 AND min(pts) = min(best) AS passed
    FROM ranked WHERE rank = 1 GROUP BY season, position""")
ORACLES["ranking_top"] = with_tables(["seasonal", "rosters"], f"""WITH {_BASE.strip()},
    ranked AS (SELECT *, {_rank('fantasy_points_half_ppr')} AS halfppr_tot_rnk FROM base)
    SELECT player_id, player_name, halfppr_tot_rnk, fantasy_points_half_ppr, games FROM ranked
    WHERE season = {SEASON} AND position = 'WR' ORDER BY halfppr_tot_rnk NULLS LAST, player_id LIMIT 5""")


def _report_part(name: str, cte: str) -> str:
    from tallyfield.registry import standins as s

    def line(metric: str, item: str, value: str, tail: str) -> str:
        return (
            f"SELECT '{name}' AS table_name, '{metric}' AS metric, {item} AS item, CAST({value} AS DOUBLE) AS value {tail}"
        )

    none = "CAST(NULL AS VARCHAR)"
    parts = [line("rows", none, "count(*)", f"FROM {cte}")]
    if name in ("weekly_stats", "schedules"):
        parts.append(line("season_rows", "CAST(season AS VARCHAR)", "count(*)", f"FROM {cte} GROUP BY season"))
    if name == "data_refresh_log":
        return " UNION ALL ".join(parts)
    parts.append(line("columns", none, str(_width(cte)), ""))
    numeric = {
        "teams": [],
        "schedules": ["season", "week", "home_score", "away_score"],
        "weekly_stats": _NUMERIC,
        "rosters": ["season", "week", "years_exp", "draft_number", "weight", "rookie_year"],
    }[name]
    if numeric:
        parts.append(line(
            "null_percentage", "column_name", "null_percentage",
            f"FROM ({_null_rows(cte, numeric)}) WHERE null_percentage > 10",
        ))
    if name in ("teams", "schedules"):
        parts.append(line("duplicates", none, f"(SELECT count(*) FROM {cte}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {cte}))", ""))
    return " UNION ALL ".join(parts)


ORACLES["validate_report"] = with_tables(
    list(_SIZES.values()), " UNION ALL ".join(_report_part(n, c) for n, c in _SIZES.items())
)
_KEPT_COLUMNS = {"schedules": ("season", "week", "home_score", "bonus"), "weekly_stats": ("season", "week", "attempts", "passing_yards")}
_KEPT_TABLES = f"""
    WITH schedules_now AS (
      SELECT season, week, CASE WHEN season >= {SEASON} AND week % 3 = 0 THEN NULL ELSE home_score END AS home_score,
             CASE WHEN season >= {SEASON} THEN week END AS bonus FROM schedules),
    weekly_now AS (
      SELECT season, week, sum(passing_yards) AS passing_yards,
             CASE WHEN season >= {SEASON} AND week % 2 = 0 THEN NULL ELSE sum(attempts) END AS attempts
      FROM weekly GROUP BY player_id, season, week)"""


def _kept_part(name: str, cte: str) -> str:
    nulls = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, 'null_percentage' AS metric, '{c}' AS item, "
        f"coalesce(CAST(count(*) - count({c}) AS DOUBLE) * 100.0 / nullif(count(*), 0), 0) AS value FROM {cte}"
        for c in _KEPT_COLUMNS[name]
    )
    return f"""
    SELECT '{name}' AS table_name, 'rows' AS metric, CAST(NULL AS VARCHAR) AS item, CAST(count(*) AS DOUBLE) AS value FROM {cte}
    UNION ALL SELECT '{name}', 'season_rows', CAST(season AS VARCHAR), CAST(count(*) AS DOUBLE) FROM {cte} GROUP BY season
    UNION ALL {nulls}"""


ORACLES["validate_kept"] = with_tables(
    ["schedules", "weekly"],
    f"{_KEPT_TABLES} {_kept_part('schedules', 'schedules_now')} UNION ALL {_kept_part('weekly_stats', 'weekly_now')}",
)
ORACLES["summary_by_change"] = with_tables(_SUMMARY_TABLES, _SUMMARY.replace(
    f"scored AS ({_SEASONAL_SCORED})",
    f"scored AS (SELECT * REPLACE (CASE WHEN season = {SEASON} THEN 1000.0 - fantasy_points_std ELSE fantasy_points_std END "
    f"AS fantasy_points_std) FROM ({_SEASONAL_SCORED}))",
) + f"""
    SELECT player_id, season, position, games, fantasy_points_std, std_tot_rnk, halfppr_ppg_rnk, passing_yards_per_game,
           ecr_rank, season = {SEASON} AS rebuilt FROM summary""")
ORACLES["summary_checks"] = with_tables(_SUMMARY_TABLES, f"""{_SUMMARY}
    SELECT 'record_counts' AS "check", (SELECT count(*) FROM seasonal) = (SELECT count(*) FROM summary) AS passed
    UNION ALL
    SELECT 'no_duplicates', count(*) = count(DISTINCT player_id || '_' || season) FROM summary""")

# -- SQL -----------------------------------------------------------------------------------------------------

ORACLES["sql_params"] = with_tables(["weekly"], f"""
    SELECT team, position, count(*) AS games, sum(passing_yards) AS yards FROM weekly
    WHERE season = {SEASON} AND week <= 10 GROUP BY team, position HAVING count(*) >= 2""")
# The same lines written to files, one with a title line full of commas, and read back.
ORACLES["rankfile_read"] = ORACLES["rankfile_dialects"] = rank_clean(rank_files(rq.FILE_LINES))
ORACLES["rankfile_report"] = f"""
    SELECT file_name, count(*) AS row_count, 'processed' AS status FROM ({ORACLES['rankfile_read']}) GROUP BY file_name"""

# -- load jobs -----------------------------------------------------------------------------------------------

_LANDED = {
    "teams": "teams", "players": "players", "schedules": "schedules", "pbp_data": "plays", "weekly_stats": "weekly",
    "seasonal_stats": "seasonal", "rosters": "rosters", "injuries": "injuries",
}
_WHOLE = ("teams", "players")
ORACLES["load_parquet"] = with_tables(list(_LANDED.values()), " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, count(*) AS row_count, CAST(count(*) AS BIGINT) AS logged_rows, "
    f"CAST({1 if table in _WHOLE else 2} AS BIGINT) AS entries FROM {cte}"
    + ("" if table in _WHOLE else f" WHERE season IN ({SEASON}, {SEASON + 1})")
    for table, cte in _LANDED.items()
))
ORACLES["load_csv"] = ORACLES["load_json"] = ORACLES["load_parquet"]
ORACLES["reload_season"] = with_tables(["weekly"], f"""
    SELECT season, week, count(*) AS row_count, CAST(sum(attempts) AS BIGINT) AS attempts FROM weekly
    WHERE season IN ({SEASON}, {SEASON + 1}) GROUP BY season, week""")

# -- keys, lost cells ----------------------------------------------------------------------------------------

ORACLES["store_known_keys"] = with_tables(["plays"], f"""
    WITH stored AS (SELECT game_id, play_id, count(*) AS n FROM plays WHERE season IS DISTINCT FROM {SEASON} GROUP BY ALL),
    named AS (SELECT game_id, CASE WHEN yardline_100 % 8 = 1 THEN play_id || 'x' ELSE play_id END AS play_id FROM plays),
    batch AS (SELECT game_id, play_id, CAST(sum(CASE WHEN play_id = '3' THEN 2 ELSE 1 END) AS BIGINT) AS batch_rows
              FROM named GROUP BY ALL)
    SELECT b.game_id, b.play_id, batch_rows, coalesce(n, 0) AS stored_rows
    FROM batch b LEFT JOIN stored s ON b.game_id = s.game_id AND b.play_id = s.play_id
    WHERE batch_rows > 1 OR n IS NOT NULL""")

_DIRTY_GAMES = _texts(
    season=rq._TEXT_SEASON, gameday=rq._TEXT_DATE, overtime=rq._TEXT_FLAG, home_score=rq._TEXT_NUMBER,
    spread_line=rq._TEXT_NUMBER,
)


def _lost(column: str, value: str, reason: str) -> str:
    return f"""
    SELECT {_tag('G', 'event_id')} AS game_id, season AS season_text, '{column}' AS "column", {reason} AS reason, {column} AS text
    FROM games WHERE {column} IS NOT NULL AND lower(trim({column})) NOT IN ('', 'nan', 'none') AND ({value}) IS NULL"""


def _why(column: str) -> str:
    number = _dbl(column)
    return f"CASE WHEN ({number}) IS NULL THEN 'number' WHEN ({number}) <> floor({number}) THEN 'fraction' ELSE 'range' END"


# A blank cell of a CSV file is read as NULL, so blanks are no lost cells either way.
_LOST_CELLS = f"""
    WITH games AS (SELECT * FROM ({_DIRTY_GAMES}) WHERE ({_int('season')}) BETWEEN 1996 AND 2001
      OR ({_int('season')}) IS NULL AND season IS NOT NULL AND lower(trim(season)) NOT IN ('', 'nan', 'none')),
    lost AS ({' UNION ALL '.join((
        _lost('season', _int('season'), _why('season')),
        _lost('home_score', _int('home_score'), _why('home_score')),
        _lost('spread_line', _dbl('spread_line'), "'number'"),
        _lost('gameday', 'TRY_CAST(gameday AS DATE)', "'date'"),
        _lost('overtime', _flag('overtime'), "'flag'"),
    ))})"""
ORACLES["quarantine_rows"] = f"{_LOST_CELLS} SELECT * FROM lost"
ORACLES["load_rejects"] = f"""{_LOST_CELLS}
    SELECT 'schedules' AS table_name, "column", reason, count(*) AS cells, min(text) AS example FROM lost GROUP BY 2, 3
    UNION ALL
    SELECT 'schedules', 'loaded', NULL, count(*), NULL FROM games WHERE ({_int('season')}) BETWEEN 1996 AND 2001"""

# -- bands of time, as range joins ---------------------------------------------------------------------------

ORACLES["injury_days"] = f"""
    WITH games AS (
      SELECT {_tag('Player ', rq.HOT_SUPPLIER)} AS player_name, CAST(l_shipdate AS DATE) AS day,
             CASE WHEN l_linenumber < 6 THEN l_quantity END AS points FROM lineitem),
    reports AS (
      SELECT {_tag('Player ', rq.HOT_USER)} AS player_name, DATE '1995-01-01' + CAST({rq.REPORT_DAY} AS INTEGER) AS day,
             count(*) AS reports
      FROM events WHERE event_type IN ('error', 'signup') GROUP BY ALL),
    pairs AS (
      SELECT r.player_name, r.day, reports, g.points, g.day < r.day AS pre, g.day > r.day AS post
      FROM reports r JOIN games g ON g.player_name = r.player_name AND g.day BETWEEN r.day - 28 AND r.day + 28)
    SELECT player_name, strftime(day, '%Y-%m-%d') AS report_date, reports,
           count(*) FILTER (pre) AS pre_injury_games, {_avg2('CASE WHEN pre THEN points END')} AS pre_injury_avg,
           count(*) FILTER (post) AS post_injury_games, {_avg2('CASE WHEN post THEN points END')} AS post_injury_avg
    FROM pairs GROUP BY player_name, day, reports HAVING count(*) FILTER (pre) >= 3 AND count(*) FILTER (post) >= 3"""
ORACLES["event_windows"] = f"""
    WITH e AS (SELECT {rq.HOT_USER} AS "user", ts, event_type, CAST(round(value * 100) AS BIGINT) AS cents FROM events),
    errors AS (SELECT "user", ts, count(*) AS events FROM e WHERE event_type = 'error' AND "user" IS NOT NULL AND ts IS NOT NULL GROUP BY ALL)
    SELECT r."user", strftime(r.ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, events,
           count(*) FILTER (e.ts < r.ts) AS facts_before, {_big('CASE WHEN e.ts < r.ts THEN cents ELSE 0 END')} AS cents_before,
           count(*) FILTER (e.ts > r.ts) AS facts_after, {_big('CASE WHEN e.ts > r.ts THEN cents ELSE 0 END')} AS cents_after
    FROM errors r LEFT JOIN e ON e."user" = r."user"
      AND e.ts BETWEEN r.ts - INTERVAL 6 HOUR AND r.ts + INTERVAL 2 HOUR
    GROUP BY r."user", r.ts, events"""
