"""One match, player and club hold a third of all rows; joins must not rely on broadcasts."""

import pytest
from pyspark.sql import functions as F

from matchstats.operators.games import last_games, match_records
from matchstats.operators.leaderboards import club_leaderboard, player_leaderboard
from matchstats.operators.streaks import streaks
from matchstats.schema import MATCHES
from matchstats.sources.sinks import as_table
from matchstats.sources.tables import StatsTables

HOT = 7
ROWS = 200_000
STRICT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64kb",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64kb",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A hot match with very many players, a hot player and a hot club in very many matches."""
    n = F.col("id")
    kind = n % 3
    match = F.when(kind == 0, HOT).otherwise(F.pmod(F.xxhash64(n), F.lit(5000)))
    facts = spark.range(ROWS).select(
        match.alias("match_id"),
        F.when(kind == 1, HOT).otherwise(F.pmod(F.xxhash64(n, F.lit(1)), F.lit(20000))).alias("player_id"),
        F.when(n % 5 == 0, 2 + match % 3).otherwise(1).cast("long").alias("team_id"),
        F.when(n % 2 == 0, "minutesPlayed").otherwise("goals").alias("metric_key"),
        (n % 4).cast("double").alias("value"),
    )
    matches = spark.range(5000).select(
        F.col("id").alias("match_id"),
        F.lit(1).alias("tournament_id"),
        F.lit(1).alias("season_id"),
        F.lit(1).alias("home_team_id"),
        (2 + F.col("id") % 3).alias("away_team_id"),
        F.lit("Hot").alias("home_team_name"),
        F.lit("Cold").alias("away_team_name"),
        F.timestamp_add("HOUR", F.col("id") * 5, F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")).alias("match_date"),
        F.lit(100).alias("status_code"),
    )
    root = str(tmp_path_factory.mktemp("skewed"))
    facts.repartition(16).write.parquet(f"{root}/facts")
    as_table(matches, "matches").repartition(4).write.parquet(f"{root}/matches")
    stored = spark.read.parquet(f"{root}/facts")
    players = stored.select("player_id", "team_id").distinct().select(
        "*", F.concat(F.lit("P"), F.col("player_id").cast("string")).alias("name"), F.lit("F").alias("position")
    )
    players.write.parquet(f"{root}/players")
    return StatsTables(
        tournaments=spark.createDataFrame([(1, 1, "A", "2020")], "unique_tournament_id long, season_id long, name string, season_year string"),
        clubs=spark.createDataFrame([(1, "Hot"), (2, "Cold")], "team_id long, name string"),
        matches=spark.read.schema(MATCHES).parquet(f"{root}/matches"),
        players=spark.read.parquet(f"{root}/players"),
        match_stats=stored.select("match_id", F.lit("ALL").alias("period"), "metric_key", F.col("value").alias("home_value"), F.col("value").alias("away_value")),
        player_stats=stored,
    )


QUERIES = {
    "player board": lambda t: player_leaderboard(t, t.matches, "finishing"),
    "player board by season": lambda t: player_leaderboard(t, t.matches, "finishing", "by_competition_season", venue="home"),
    "club board against": lambda t: club_leaderboard(t, t.matches, "finishing", perspective="against"),
    "records": lambda t: match_records("player", t, t.matches, "finishing", "goals"),
    "last games": lambda t: last_games("player", t, t.matches, "finishing", 3),
    "player streaks": lambda t: streaks("player", t, t.matches, "finishing", "goals", limit=None),
    "club streaks": lambda t: streaks("club", t, t.matches, "finishing", "goals", limit=None),
}


@pytest.mark.parametrize("name", QUERIES)
def test_skew_is_split_and_results_stay(spark, skewed, name):
    want = sorted(map(repr, QUERIES[name](skewed).collect()))
    before = {key: spark.conf.get(key, None) for key in STRICT}
    for key, value in STRICT.items():
        spark.conf.set(key, value)
    try:
        df = QUERIES[name](skewed)
        got = sorted(map(repr, df.collect()))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
    assert got == want and got
    final = plan.split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" not in final
    assert "skew=true" in final
