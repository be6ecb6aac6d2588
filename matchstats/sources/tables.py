"""Typed scans of the stored tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchstats.schema import FACTS, KEYS, TABLES
from matchstats.sources import storage


@dataclass(frozen=True)
class StatsTables:
    """Four dimensions with unique keys and two long facts."""

    tournaments: DataFrame
    clubs: DataFrame
    matches: DataFrame
    players: DataFrame
    match_stats: DataFrame
    player_stats: DataFrame


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in a stated order.

    Spark pushes the rank limit below the shuffle, so a hot key sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(window)).filter("_row = 1").drop("_row")


def unique_dimension(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop repeated keys, keeping the first row in the order of the other columns."""
    return keep_first(df, keys, [c for c in df.columns if c not in keys] or list(keys))


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table with its declared types; an empty one if nothing has been written yet."""
    if name in FACTS:
        stored = storage.read_parts(spark, root, name, storage.current_parts(spark, root, name))
    else:
        path = storage.table_path(spark, root, name)
        stored = spark.read.schema(TABLES[name]).parquet(path) if path else None
    return spark.createDataFrame([], TABLES[name]) if stored is None else stored


def open_tables(spark: SparkSession, root: str) -> StatsTables:
    """All tables under a folder.  Dimension keys are unique because the sinks keep them so."""
    return StatsTables(
        tournaments=read_table(spark, root, "tournaments"),
        clubs=read_table(spark, root, "clubs"),
        matches=read_table(spark, root, "matches"),
        players=read_table(spark, root, "players"),
        match_stats=read_table(spark, root, "match_stats_log"),
        player_stats=read_table(spark, root, "player_stats_log"),
    )


def dimension_columns(tables: StatsTables) -> dict[str, DataFrame]:
    """The pruned dimension scans an analysis starts from, deduplicated by key."""
    wanted = {
        "tournaments": tables.tournaments,
        "matches": tables.matches.select(
            "match_id", "tournament_id", "season_id", "round_id", "match_date", "home_team_id",
            "away_team_id", "home_team_name", "away_team_name", "round_name", "status_code",
        ),
        "clubs": tables.clubs.select("team_id", "name"),
        "players": tables.players.select("player_id", "team_id", "name", "position"),
    }
    return {name: unique_dimension(df, KEYS[name]) for name, df in wanted.items()}
