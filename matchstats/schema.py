"""Column names and types of every table (facts are long: one row per metric)."""

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "bool": T.BooleanType(),
    "timestamp": T.TimestampNTZType(),
}


def _table(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in columns.items()])


TOURNAMENTS = _table(
    unique_tournament_id="long",
    name="string",
    slug="string",
    category_name="string",
    season_id="long",
    season_name="string",
    season_year="string",
)

CLUBS = _table(
    team_id="long",
    name="string",
    short_name="string",
    slug="string",
    gender="string",
    name_code="string",
    disabled="bool",
    national="bool",
    type="int",
    primary_color="string",
    secondary_color="string",
)

MATCHES = _table(
    match_id="long",
    tournament_id="long",
    season_id="long",
    round_id="int",
    home_team_id="long",
    away_team_id="long",
    home_team_name="string",
    away_team_name="string",
    match_date="timestamp",
    status_code="int",
    home_score="int",
    away_score="int",
    round_name="string",
    round_slug="string",
)

PLAYERS = _table(
    player_id="long",
    name="string",
    slug="string",
    short_name="string",
    team_id="long",
    position="string",
    jersey_number="string",
    height="int",
    country_alpha3="string",
    date_of_birth_timestamp="long",
    market_value="double",
    last_updated_match_id="long",
)

# Facts are partitioned by their match's season; a match without one is kept under this value, as
# a join on the partition column would lose NULL.
NO_SEASON = -1

MATCH_STATS = _table(
    match_id="long",
    period="string",
    metric_key="string",
    metric_name="string",
    home_value="double",
    away_value="double",
    season_id="long",
)

PLAYER_STATS = _table(
    match_id="long",
    player_id="long",
    team_id="long",
    position="string",
    metric_key="string",
    metric_name="string",
    value="double",
    season_id="long",
)

MATCH_SHOTS = _table(
    id="long",
    match_id="long",
    player_id="long",
    player_name="string",
    is_home_team="bool",
    shot_type="string",
    situation="string",
    body_part="string",
    goal_mouth_location="string",
    x_coord="double",
    y_coord="double",
    goal_mouth_x="double",
    goal_mouth_y="double",
    goal_mouth_z="double",
    time_min="int",
)

MATCH_SPATIAL_ACTIONS = _table(
    id="long",
    match_id="long",
    player_id="long",
    action_type="string",
    x_start="double",
    y_start="double",
    x_end="double",
    y_end="double",
    outcome="bool",
    keypass="bool",
    is_assist="bool",
    time_min="int",
)

MATCH_AVERAGE_POSITIONS = _table(
    id="long",
    match_id="long",
    player_id="long",
    avg_x="double",
    avg_y="double",
    points_count="int",
)

TABLES = {
    "tournaments": TOURNAMENTS,
    "clubs": CLUBS,
    "matches": MATCHES,
    "players": PLAYERS,
    "match_stats_log": MATCH_STATS,
    "player_stats_log": PLAYER_STATS,
    "match_shots": MATCH_SHOTS,
    "match_spatial_actions": MATCH_SPATIAL_ACTIONS,
    "match_average_positions": MATCH_AVERAGE_POSITIONS,
}

# Unique keys of the dimension tables.
KEYS = {
    "tournaments": ["unique_tournament_id", "season_id"],
    "clubs": ["team_id"],
    "matches": ["match_id"],
    "players": ["player_id", "team_id"],
}

FACTS = ("match_stats_log", "player_stats_log")

FINISHED_STATUS = (100, 110, 120)
PERIODS = ("ALL", "1ST", "2ND")
MINUTES = "minutesPlayed"
