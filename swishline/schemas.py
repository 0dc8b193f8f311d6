"""Table schemas and the fixed values every module shares."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
# Values that must stay equal for results to match; nothing here is tuned.

# eventmsgtype codes of a made and a missed shot
MADE, MISSED = 1, 2

# shots from beyond this many feet are worth three points
THREE_POINT_LINE = 23

# defaults for fields a raw play or an event may lack
DEFAULT_PLAYER = "Unknown"
DEFAULT_PERIOD = 1
DEFAULT_SECONDS = 360
DEFAULT_DISTANCE = 15
LEAGUE_RATING = 0.45

# weight, in shots, of the league average inside a player's rating
PRIOR_SHOTS = 50

# the name of the event stream and the reload interval of its scorer
EVENT_TOPIC = "raw-shot-events"
RELOAD_SECONDS = 60

# the eight shot-type flags and the lower-case texts that raise each of them
SHOT_TYPES = {
    "is_dunk": ("dunk",),
    "is_layup": ("layup",),
    "is_hook": ("hook",),
    "is_tip": ("tip",),
    "is_fadeaway": ("fadeaway", "fade away"),
    "is_bank": ("bank",),
    "is_alley_oop": ("alley oop",),
    "is_pullup": ("pull-up", "pullup", "pull up"),
}

# model inputs, in model order
FEATURES = [
    "shot_distance",
    "period",
    "seconds_remaining",
    "is_three",
    "is_dunk",
    "is_layup",
    "is_hook",
    "is_tip",
    "is_fadeaway",
    "is_bank",
    "is_alley_oop",
    "is_home",
    "is_pullup",
    "player_skill_rating",
]

# grades: lower bound (exclusive) of expected points, best first; the rest is C
GRADE_FLOORS = {"A": 1.1, "B": 0.9}
GRADE_LABELS = {
    "A": "Grade A (Premium)",
    "B": "Grade B (Good)",
    "C": "Grade C (Poor)",
}

# court zones: largest distance in feet (inclusive), nearest first
ZONE_LIMITS = {
    "Rim (0-3ft)": 3,
    "Paint (4-10ft)": 10,
    "Mid-Range (11-16ft)": 16,
    "Long 2 (17-23ft)": 23,
}
FAR_ZONE = "3-Pointer (24+ft)"

# -------------------------------------------------------------------- schemas

# raw play-by-play rows; game_id stays text so that leading zeros survive
PLAYS = T.StructType(
    [
        T.StructField("game_id", T.StringType()),
        T.StructField("eventmsgtype", T.IntegerType()),
        T.StructField("period", T.IntegerType()),
        T.StructField("pctimestring", T.StringType()),
        T.StructField("homedescription", T.StringType()),
        T.StructField("visitordescription", T.StringType()),
        T.StructField("player1_name", T.StringType()),
    ]
)

EVENT_FIELDS = [
    "game_id",
    "player",
    "distance",
    "period",
    "seconds_remaining",
    "is_three",
    *SHOT_TYPES,
    "is_home",
    "result",
    "timestamp",
]

# Numbers arrive as JSON numbers of either shape ("24" or "24.0"): an int field
# would turn the second into null, so all of them are read as double.
CORRUPT = "_corrupt_record"
EVENT_JSON = T.StructType(
    [
        T.StructField(
            name,
            T.StringType() if name in ("game_id", "player", "result") else T.DoubleType(),
        )
        for name in EVENT_FIELDS
    ]
    + [T.StructField(CORRUPT, T.StringType())]
)

TELEMETRY_COLUMNS = [
    "shot_id",
    "game_id",
    "player_name",
    "shot_distance",
    "expected_points",
    "shot_grade",
    "created_at",
]

# what the scorer stores: the reported columns plus the event's own time
TELEMETRY = T.StructType(
    [
        T.StructField("shot_id", T.StringType()),
        T.StructField("game_id", T.StringType()),
        T.StructField("player_name", T.StringType()),
        T.StructField("shot_distance", T.IntegerType()),
        T.StructField("expected_points", T.DoubleType()),
        T.StructField("shot_grade", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

RATINGS = T.StructType(
    [
        T.StructField("player", T.StringType()),
        T.StructField("rating", T.DoubleType()),
    ]
)
