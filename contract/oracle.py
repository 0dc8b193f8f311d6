"""The queries again, in DuckDB SQL. Of models, what holds for any right one."""

from __future__ import annotations

from swishline.schemas import FEATURES

FLAGS = {
    "is_dunk": "contains(d, 'dunk')",
    "is_layup": "contains(d, 'layup')",
    "is_hook": "contains(d, 'hook')",
    "is_tip": "contains(d, 'tip')",
    "is_fadeaway": "contains(d, 'fadeaway') OR contains(d, 'fade away')",
    "is_bank": "contains(d, 'bank')",
    "is_alley_oop": "contains(d, 'alley oop')",
    "is_pullup": "contains(d, 'pull-up') OR contains(d, 'pullup') OR contains(d, 'pull up')",
}
FLAG_SQL = ",\n      ".join(f"CAST({rule} AS INTEGER) AS {name}" for name, rule in FLAGS.items())
FLAG_LIST = ", ".join(FLAGS)

PLAY_LIST = (
    "play_id, game_id, eventmsgtype, period, pctimestring, homedescription, "
    "visitordescription, player1_name"
)
TELEMETRY_LIST = (
    "shot_id, game_id, player_name, shot_distance, expected_points, shot_grade, created_at"
)
EVENT_LIST = (
    f"game_id, player, distance, period, seconds_remaining, is_three, {FLAG_LIST}, "
    'is_home, result, "timestamp"'
)


def features(rating: str, period: str, seconds: str) -> str:
    inputs = {
        "shot_distance": "shot_distance",
        "period": period,
        "seconds_remaining": seconds,
        "is_three": "is_three",
        **{name: name for name in FLAGS if name != "is_pullup"},
        "is_home": "is_home",
        "is_pullup": "is_pullup",
        "player_skill_rating": rating,
    }
    return ", ".join(f"CAST({rule} AS DOUBLE) AS {name}" for name, rule in inputs.items())


# The driver's events as plays, shots, events and telemetry. Queries use what
# they need; DuckDB skips the rest.
TABLES = f"""
WITH raw AS (
  SELECT event_id, user_id AS u, event_type, ts,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
), texts AS (
  SELECT *,
    CASE WHEN event_id % 13 = 0 THEN 'Player ' || u || ' Layup'
      ELSE 'Player ' || u || ' ' || (k % 35) || ''' ' ||
        (['Driving DUNK', 'Layup', 'Hook Shot', 'Tip Layup Shot', 'Fadeaway',
          'Jump Bank Shot', 'Alley Oop Dunk', 'Pull-Up Jump Shot',
          '3PT Jump Shot'])[event_id % 9 + 1]
    END AS text
  FROM raw
), plays AS (
  SELECT event_id AS play_id,
    lpad(CAST(u % 40 AS VARCHAR), 10, '0') AS game_id,
    CAST(CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 2
      WHEN 'signup' THEN 3 WHEN 'error' THEN 5 END AS INTEGER) AS eventmsgtype,
    CAST(CASE WHEN k % 17 <> 0 THEN k % 5 END AS INTEGER) AS period,
    CASE WHEN k % 33 = 0 THEN NULL WHEN k % 25 = 0 THEN 'n/a'
      WHEN k % 29 = 0 THEN '1:02:03'
      ELSE (k % 12) || ':' || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0')
    END AS pctimestring,
    CASE WHEN u % 2 = 0 THEN text WHEN event_id % 11 = 0 THEN 'Smith BLOCK (1 BLK)'
    END AS homedescription,
    CASE WHEN u % 2 = 1 THEN text END AS visitordescription,
    CASE WHEN u % 50 = 0 THEN NULL WHEN u % 50 = 1 THEN '' ELSE 'Player ' || u
    END AS player1_name,
    ts AS created_at
  FROM texts
), described AS (
  SELECT *,
    coalesce(homedescription, '') || coalesce(visitordescription, '') AS description,
    lower(coalesce(homedescription, '') || coalesce(visitordescription, '')) AS d,
    string_split(pctimestring, ':') AS clock
  FROM plays
), derived AS (
  SELECT *,
    TRY_CAST(nullif(regexp_extract(description, '([0-9]+)''', 1), '') AS INTEGER)
      AS shot_distance,
    CASE WHEN len(clock) = 2
        AND regexp_full_match(clock[1], '\\s*[+-]?[0-9]+\\s*')
        AND regexp_full_match(clock[2], '\\s*[+-]?[0-9]+\\s*')
      THEN CAST(clock[1] AS INTEGER) * 60 + CAST(clock[2] AS INTEGER)
      ELSE 360 END AS seconds_remaining,
    CASE WHEN homedescription <> '' THEN 1 ELSE 0 END AS is_home,
    CASE WHEN eventmsgtype = 1 THEN 'Made Shot' ELSE 'Missed Shot' END AS result,
    CASE WHEN eventmsgtype = 1 THEN 1 ELSE 0 END AS label,
    coalesce(nullif(player1_name, ''), 'Unknown') AS player,
    coalesce(nullif(period, 0), 1) AS served_period,
      {FLAG_SQL}
  FROM described
), all_shots AS (
  SELECT * FROM derived WHERE eventmsgtype IN (1, 2)
), shots AS (
  SELECT *,
    CASE WHEN shot_distance > 23 THEN 1 ELSE 0 END AS is_three,
    ((play_id * 37) % 100 + 0.5) / 100.0::DOUBLE AS p
  FROM all_shots WHERE shot_distance IS NOT NULL
), served_events AS (
  SELECT play_id, game_id, player, shot_distance AS distance, served_period AS period,
    seconds_remaining, is_three, {FLAG_LIST}, is_home, result,
    epoch_us(created_at) / 1e6::DOUBLE AS "timestamp"
  FROM shots
), totals AS (
  SELECT player1_name AS player, CAST(sum(label) AS BIGINT) AS made, count(*) AS total
  FROM all_shots WHERE player1_name <> '' GROUP BY 1
), league AS (
  SELECT coalesce(sum(made)::DOUBLE / sum(total)::DOUBLE, 0.45::DOUBLE) AS league_avg FROM totals
), ratings AS (
  SELECT player, made, total,
    round((made + 50 * (SELECT league_avg FROM league)) / (total + 50), 4) AS rating
  FROM totals
), scored AS (
  SELECT *, p * CASE WHEN shot_distance > 23 THEN 3 ELSE 2 END AS expected_points FROM shots
), graded AS (
  SELECT *, CASE WHEN expected_points > 1.1::DOUBLE THEN 'A'
      WHEN expected_points > 0.9::DOUBLE THEN 'B' ELSE 'C' END AS shot_grade
  FROM scored
), telemetry AS (
  SELECT CAST(play_id AS VARCHAR) AS shot_id, game_id, player AS player_name, shot_distance,
    expected_points, shot_grade, created_at AS event_time, created_at,
    CASE WHEN shot_distance <= 3 THEN 'Rim (0-3ft)'
      WHEN shot_distance <= 10 THEN 'Paint (4-10ft)'
      WHEN shot_distance <= 16 THEN 'Mid-Range (11-16ft)'
      WHEN shot_distance <= 23 THEN 'Long 2 (17-23ft)'
      ELSE '3-Pointer (24+ft)' END AS zone
  FROM graded
), sample AS (
  SELECT * FROM telemetry ORDER BY created_at DESC, shot_id DESC LIMIT 1000
), heuristic AS (
  SELECT game_id, player AS player_name, shot_distance, created_at,
    CASE WHEN shot_distance < 10 THEN 1.0::DOUBLE ELSE 0.8::DOUBLE END AS expected_points,
    CASE WHEN shot_distance < 10 THEN 'B' ELSE 'C' END AS shot_grade,
    CASE WHEN shot_distance <= 3 THEN 'Rim (0-3ft)'
      WHEN shot_distance <= 10 THEN 'Paint (4-10ft)'
      WHEN shot_distance <= 16 THEN 'Mid-Range (11-16ft)'
      WHEN shot_distance <= 23 THEN 'Long 2 (17-23ft)'
      ELSE '3-Pointer (24+ft)' END AS zone
  FROM shots
)
"""


def key_hash(key: str) -> str:
    return f"CAST('0x' || substr(md5('42:' || {key}), 1, 8) AS BIGINT)"


def share(condition: str, rows: str) -> str:
    return f"100.0::DOUBLE * (count(*) FILTER (WHERE {condition}))::DOUBLE / nullif({rows}, 0)"


def plain(value: str) -> str:
    return f"CASE WHEN round({value}, 6) = 0 THEN 0.0::DOUBLE ELSE round({value}, 6) END"


ANGLE = f"({key_hash('shot_id')} * pi() / 4294967296.0::DOUBLE)"
AVG_XP = "coalesce(round(avg(expected_points), 9), 0.0::DOUBLE) AS avg_xp"
GRADE_ROWS = """(VALUES ('A', 'Grade A (Premium)'), ('B', 'Grade B (Good)'),
      ('C', 'Grade C (Poor)')) AS g(grade, label)"""
SPLIT = f"CASE WHEN {key_hash('play_id')} % 100 < 20 THEN 'test' ELSE 'train' END"


def histogram(rows: str) -> str:
    return f"""
      SELECT CAST(low + (shot_distance - low) // width * width AS INTEGER) AS bin_start,
        width AS bin_width, count(*) AS shots
      FROM {rows}, (
        SELECT min(shot_distance) AS low,
          CAST(ceil((max(shot_distance) - min(shot_distance) + 1) / 25.0) AS INTEGER) AS width
        FROM {rows})
      GROUP BY 1, 2"""


def by_distance(rows: str) -> str:
    return f"""
      SELECT shot_distance, shot_grade, count(*) AS shots, {AVG_XP}
      FROM {rows} GROUP BY 1, 2"""


TYPE_LABEL = """CASE WHEN is_dunk = 1 THEN 'Dunk' WHEN is_layup = 1 THEN 'Layup'
      WHEN is_hook = 1 THEN 'Hook' WHEN is_tip = 1 THEN 'Tip'
      WHEN is_fadeaway = 1 THEN 'Fadeaway' WHEN is_bank = 1 THEN 'Bank'
      WHEN is_alley_oop = 1 THEN 'Alley Oop' WHEN is_three = 1 THEN '3PT Jump Shot'
      ELSE 'Jump Shot' END"""

SKILL_TRAIN = """CASE WHEN player1_name IS NOT NULL
      THEN coalesce(rating, (SELECT league_avg FROM league)) END"""

FEATURE_ROWS = f"(VALUES {', '.join(f"('{f}')" for f in FEATURES)}) AS f(feature)"

EVENTS_OUT = f"SELECT {EVENT_LIST} FROM served_events"

HEURISTIC_OUT = """
      SELECT game_id, player_name, shot_distance, expected_points, shot_grade,
        created_at AS event_time, created_at FROM heuristic"""

BODIES = {
    # sources and sinks
    "scan_plays": f"""
      SELECT * REPLACE (homedescription || ' "alley, oop" \\"' AS homedescription)
      FROM (SELECT {PLAY_LIST} FROM plays)""",
    "publish_events": EVENTS_OUT,
    "subscribe_events": f"""
      SELECT {EVENT_LIST}, CAST(NULL AS VARCHAR) AS rejected FROM served_events
      UNION ALL BY NAME
      SELECT description AS rejected FROM derived WHERE eventmsgtype NOT IN (1, 2)""",
    "replay_bounded": f"SELECT {EVENT_LIST}, CAST(8 AS BIGINT) AS batches FROM served_events",
    "append_telemetry": f"SELECT {TELEMETRY_LIST}, event_time FROM telemetry",
    "scan_telemetry": f"SELECT {TELEMETRY_LIST} FROM telemetry",
    "skill_artifact": "SELECT player, rating FROM ratings",
    "model_artifact": f"SELECT play_id AS shot_key, true AS same FROM shots WHERE {SPLIT} = 'test'",
    # models: what any right model has to fulfil, and everything that is exact about them
    "train_boosted": """
      SELECT CAST(range AS INTEGER) AS round, true AS as_walked FROM range(1, 101)""",
    "train_logistic": f"SELECT feature, true AS flat FROM {FEATURE_ROWS}",
    "score_shots": "SELECT play_id AS shot_key, true AS as_walked FROM shots",
    "feature_importance": f"SELECT feature, true AS share FROM {FEATURE_ROWS}",
    "what_if_scores": """
      SELECT scenario, true AS as_walked, true AS as_weighed FROM (VALUES
        ('3-ft home dunk, elite player'), ('3-ft away layup, average player'),
        ('25-ft home three, average player'), ('25-ft away pullup at the buzzer'))
        AS s(scenario)""",
    "retrain_job": f"""
      SELECT {SPLIT} AS split, count(*) AS n, CAST(sum(label) AS BIGINT) AS made,
        true AS metrics_right, true AS learnt
      FROM shots GROUP BY 1""",
    "stream_enrich_model": """
      SELECT created_at AS event_time, count(*) AS shots, true AS as_batch
      FROM heuristic GROUP BY 1""",
    "stream_hot_reload": """
      SELECT CASE WHEN late THEN 2 ELSE 1 END AS generation, count(*) AS shots,
        NOT late AS by_heuristic
      FROM (
        SELECT "timestamp" >= (SELECT (min("timestamp") + max("timestamp")) / 2.0::DOUBLE
          FROM served_events) AS late
        FROM served_events)
      GROUP BY late""",
    # filters and columns
    "filter_shots": f"SELECT {PLAY_LIST} FROM all_shots",
    "combine_description": "SELECT play_id, description FROM derived",
    "extract_distance": "SELECT play_id, shot_distance FROM all_shots",
    "require_distance": "SELECT play_id, shot_distance FROM shots",
    "result_label": "SELECT play_id, result FROM shots",
    "shot_type_flags": f"SELECT play_id, {FLAG_LIST} FROM shots",
    "seconds_remaining": "SELECT play_id, seconds_remaining FROM derived",
    "is_three": "SELECT play_id, is_three FROM shots",
    "is_home": "SELECT play_id, is_home FROM derived",
    "event_defaults": "SELECT play_id, game_id, player, served_period AS period FROM derived",
    "build_event": f"SELECT play_id, {EVENT_LIST} FROM served_events",
    "event_field_defaults": """
      SELECT play_id, game_id, coalesce(player1_name, 'Unknown') AS player,
        CAST(coalesce(shot_distance, 15) AS DOUBLE) AS distance,
        coalesce(period, 1) AS period, 360 AS seconds_remaining, 0 AS is_three, """
    + ", ".join(f"0 AS {name}" for name in FLAGS)
    + """, 0 AS is_home, 0.45::DOUBLE AS player_skill_rating FROM all_shots""",
    "feature_rows": f"""
      SELECT play_id, {features("coalesce(rating, 0.45)", "served_period", "seconds_remaining")},
        label
      FROM shots LEFT JOIN ratings ON shots.player = ratings.player""",
    "feature_rows_training": f"""
      SELECT play_id, {features(f"round({SKILL_TRAIN}, 9)", "period",
        "CASE WHEN pctimestring IS NOT NULL THEN seconds_remaining END")}, label
      FROM shots LEFT JOIN ratings ON player1_name = ratings.player""",
    "shot_type_label": f"SELECT play_id, {TYPE_LABEL} AS shot_type FROM shots",
    "expected_points": "SELECT play_id, round(expected_points, 9) AS expected_points FROM scored",
    "heuristic_xp": """
      SELECT play_id, CASE WHEN shot_distance < 10 THEN 1.0::DOUBLE ELSE 0.8::DOUBLE END
        AS expected_points FROM shots""",
    "shot_grade": "SELECT play_id, shot_grade FROM graded",
    "shot_zone": "SELECT shot_id, zone FROM telemetry",
    "shot_position": f"""
      SELECT shot_id, {plain(f"(shot_distance * 10 * cos({ANGLE}))")} AS x,
        {plain(f"(-250.0::DOUBLE + shot_distance * 10 * sin({ANGLE}))")} AS y FROM telemetry""",
    "recent_shots": """
      SELECT player_name AS "Player", shot_distance AS "Distance (ft)",
        round(expected_points, 3) AS "Expected Points", shot_grade AS "Grade",
        created_at AS "Time"
      FROM telemetry ORDER BY created_at DESC, shot_id DESC LIMIT 20""",
    # look-ups
    "skill_lookup_train": f"""
      SELECT play_id, player1_name AS player, round({SKILL_TRAIN}, 9) AS player_skill_rating
      FROM shots LEFT JOIN ratings ON player1_name = ratings.player""",
    "skill_lookup_serve": """
      SELECT play_id, shots.player AS player,
        coalesce(rating, 0.45::DOUBLE) AS player_skill_rating
      FROM shots LEFT JOIN ratings ON shots.player = ratings.player""",
    # reports
    "total_shots": "SELECT count(*) AS total_shots FROM telemetry",
    "avg_xp": f"SELECT {AVG_XP} FROM telemetry",
    "grade_distribution": f"""
      SELECT grade, label, count(shot_id) AS shots,
        coalesce(round(100.0::DOUBLE * (count(shot_id)::DOUBLE /
          nullif((SELECT count(*) FROM telemetry), 0)), 9), 0.0::DOUBLE) AS percent
      FROM {GRADE_ROWS} LEFT JOIN telemetry ON shot_grade = grade GROUP BY 1, 2""",
    "player_leaderboard": f"""
      SELECT player_name, count(*) AS shots, {AVG_XP} FROM telemetry
      GROUP BY 1 ORDER BY shots DESC, player_name LIMIT 10""",
    "zone_stats": f"SELECT zone, count(*) AS shots, {AVG_XP} FROM telemetry GROUP BY 1",
    "recent_activity": """
      SELECT count(*) AS recent_shots FROM telemetry
      WHERE created_at >= (SELECT max(created_at) FROM telemetry) - INTERVAL 5 MINUTE""",
    "shots_per_minute": """
      SELECT date_trunc('minute', created_at) AS minute, count(*) AS shots FROM telemetry
      WHERE created_at >= (SELECT max(created_at) FROM telemetry) - INTERVAL 60 MINUTE
      GROUP BY 1""",
    "premium_pct": f"""
      SELECT coalesce(round({share("shot_grade = 'A'", "count(*)")}, 9), 0.0::DOUBLE)
        AS premium_pct FROM telemetry""",
    "three_point_pct": f"""
      SELECT coalesce(round({share("shot_distance > 23", "count(*)")}, 9), 0.0::DOUBLE)
        AS three_point_pct FROM sample""",
    "distance_histogram": histogram("sample"),
    "distance_histogram_all": histogram("telemetry"),
    "xp_by_distance": by_distance("sample"),
    "xp_by_distance_all": by_distance("telemetry"),
    "dashboard_snapshot": f"""
      SELECT count(*) AS total_shots,
        count(*) FILTER (WHERE created_at >=
          (SELECT max(created_at) FROM telemetry) - INTERVAL 5 MINUTE) AS recent_shots,
        {AVG_XP},
        coalesce(round({share("shot_grade = 'A'", "count(*)")}, 9), 0.0::DOUBLE) AS premium_pct,
        (SELECT coalesce(round({share("shot_distance > 23", "count(*)")}, 9), 0.0::DOUBLE)
          FROM sample) AS three_point_pct
      FROM telemetry""",
    # ratings
    "player_totals": "SELECT player, made, total FROM totals",
    "league_avg": "SELECT round(league_avg, 9) AS league_avg FROM league",
    "player_skill": "SELECT player, made, total, rating FROM ratings",
    "class_balance": f"""
      SELECT {SPLIT} AS split, count(*) AS n,
        round(sum(label)::DOUBLE / count(*), 9) AS made_rate,
        round(1.0::DOUBLE - sum(label)::DOUBLE / count(*), 9) AS missed_rate,
        round((count(*) - sum(label))::DOUBLE / sum(label)::DOUBLE, 9) AS scale_pos_weight
      FROM shots GROUP BY 1""",
    # rows and samples
    "latest_n": f"SELECT {TELEMETRY_LIST} FROM sample",
    "sample_n": f"""
      SELECT {TELEMETRY_LIST} FROM telemetry
      ORDER BY {key_hash("shot_id")}, shot_id LIMIT 200""",
    # evaluation
    "train_test_split": f"SELECT play_id, {SPLIT} AS split FROM shots",
    "predict_label": "SELECT play_id, CAST(p > 0.5 AS INTEGER) AS prediction FROM shots",
    "eval_accuracy": """
      SELECT round(avg(CASE WHEN CAST(p > 0.5 AS INTEGER) = label THEN 1.0::DOUBLE
        ELSE 0.0::DOUBLE END), 9) AS accuracy FROM shots""",
    "eval_logloss": """
      SELECT round(avg(-CASE WHEN label = 1 THEN ln(p) ELSE ln(1 - p) END), 9) AS logloss
      FROM shots""",
    "eval_brier": "SELECT round(avg((p - label) * (p - label)), 9) AS brier FROM shots",
    "eval_auc": """
      SELECT round(sum(pos * (below + neg / 2.0::DOUBLE)) / (sum(pos) * sum(neg)), 9) AS auc
      FROM (
        SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY p
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM (
          SELECT p, sum(label)::DOUBLE AS pos, sum(1 - label)::DOUBLE AS neg
          FROM shots GROUP BY p))""",
    # streaming
    "stream_enrich": HEURISTIC_OUT,
    "stream_fallback": """
      SELECT game_id, player_name, shot_distance, expected_points, shot_grade FROM heuristic""",
    "stream_start_position": """
      SELECT start_position, shot_grade, count(*) AS shots
      FROM heuristic JOIN (VALUES ('earliest'), ('latest')) AS s(start_position)
        ON start_position = 'earliest' OR epoch_us(created_at) / 1e6::DOUBLE >=
          (SELECT (min("timestamp") + max("timestamp")) / 2.0::DOUBLE FROM served_events)
      GROUP BY 1, 2""",
    "stream_shots_per_minute": """
      SELECT date_trunc('minute', created_at) AS minute, count(*) AS shots
      FROM shots GROUP BY 1""",
    "stream_running_totals": f"""
      SELECT 'all' AS report, 'all' AS item, count(*) AS shots, {AVG_XP} FROM heuristic
      UNION ALL
      SELECT 'grade', grade, count(shot_grade), CAST(NULL AS DOUBLE)
      FROM {GRADE_ROWS} LEFT JOIN heuristic ON shot_grade = grade GROUP BY grade
      UNION ALL
      SELECT 'zone', zone, count(*), {AVG_XP} FROM heuristic GROUP BY zone""",
}

ORACLE_SQL = {name: f"{TABLES}{body}" for name, body in BODIES.items()}
