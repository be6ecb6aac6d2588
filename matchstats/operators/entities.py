"""Which players appeared for which clubs, by competition and season."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstats.operators.context import competitions_of, keep_ids
from matchstats.operators.facts import player_rows
from matchstats.operators.leaderboards import club_names
from matchstats.schema import MINUTES
from matchstats.sources.tables import StatsTables


def context_entities(tables: StatsTables, ctx: DataFrame) -> DataFrame:
    """Appearances are made unique by id before any name is joined."""
    appearances = (
        player_rows(tables, ctx, [MINUTES], carry=["tournament_id", "season_id"])
        .select("team_id", "player_id", "tournament_id", "season_id")
        .distinct()
    )
    names = tables.players.groupBy("player_id").agg(F.max("name").alias("player"))
    return (
        appearances.join(competitions_of(tables.tournaments), ["tournament_id", "season_id"])
        .join(names, "player_id")
        .join(club_names(tables.clubs), "team_id")
        .groupBy("team_id", "player_id", "competition", "season")
        .agg(F.max("player").alias("player"), F.max("club").alias("club"))
    )


def players_to_choose(
    entities: DataFrame,
    competitions: Sequence[str] | None = None,
    seasons: Sequence[str] | None = None,
    teams: Iterable[int] | None = None,
) -> DataFrame:
    """Players with the clubs they appeared for, within a selection, by name."""
    chosen = keep_ids(keep_ids(entities, "competition", competitions), "season", seasons)
    return (
        keep_ids(chosen, "team_id", teams)
        .select("player_id", "player", "team_id", "club")
        .distinct()
        .orderBy("player", "player_id", "team_id")
    )
