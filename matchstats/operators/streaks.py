"""Streaks and consistency.

Streak lengths are combined from pieces: each entity's games of one day are summarised first, and
only those summaries are put in order per entity.  An entity with a third of all games is thereby
spread over its days, and what is ordered per entity is bounded by the number of calendar days.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchstats.functions.metrics import condition
from matchstats.operators.context import describable, finished
from matchstats.operators.games import game_columns, game_table
from matchstats.operators.leaderboards import UNKNOWN_CLUB, club_names
from matchstats.sources.tables import StatsTables


def _day_summaries(games: DataFrame, entity: str) -> DataFrame:
    """Per entity and day: the run before the first miss, after the last miss, and the longest."""
    in_order = Window.partitionBy(entity, "day").orderBy(
        F.asc_nulls_last("match_date"), "match_id", "team_id"
    )
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = (
        games.withColumn("day", F.to_date("match_date"))
        .withColumn("misses", F.sum(F.col("played") - F.col("hit")).over(so_far))
        .withColumn("place", F.row_number().over(in_order))
        .groupBy(entity, "day", "misses")
        .agg(
            F.sum("hit").alias("run"),
            F.sum("played").alias("games"),
            F.max("recorded").alias("recorded"),
            F.max_by("team_id", "place").alias("latest_team_id"),
        )
    )
    return runs.groupBy(entity, "day").agg(
        F.sum("games").alias("games"),
        F.sum("run").alias("hits"),
        F.max("misses").alias("misses"),
        F.max("run").alias("longest"),
        F.coalesce(F.max(F.when(F.col("misses") == 0, F.col("run"))), F.lit(0)).alias("head"),
        F.max_by("run", "misses").alias("tail"),
        F.max("recorded").alias("recorded"),
        F.max_by("latest_team_id", "misses").alias("latest_team_id"),
    )


def streak_summary(games: DataFrame, entity: str) -> DataFrame:
    """Games, hits, success rate, active and best streak per entity.

    ``games`` has one row per game in chronological order by (match_date, match_id, team_id) with
    ``played`` and ``hit`` as 0 or 1; a row with ``played`` = 0 counts for nothing but ``recorded``.
    """
    days = _day_summaries(games, entity)
    in_order = Window.partitionBy(entity).orderBy(F.asc_nulls_last("day"))
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run_id = F.sum(F.when(F.col("misses") > 0, 1).otherwise(0)).over(so_far)

    # A day with a miss closes the run before it with its head and opens the next with its tail.
    closing = F.struct((F.col("run_id") - 1).alias("run_id"), F.col("head").alias("length"))
    opening = F.struct(F.col("run_id").alias("run_id"), F.col("tail").alias("length"))
    pieces = F.when(F.col("misses") > 0, F.array(closing, opening)).otherwise(F.array(opening))
    runs = (
        days.withColumn("run_id", run_id)
        .select("*", F.posexplode(pieces).alias("piece_no", "piece"))
        .groupBy(entity, F.col("piece.run_id").alias("run_id"))
        .agg(
            F.sum("piece.length").alias("length"),
            F.sum(F.when(F.col("piece_no") == 0, F.col("games"))).alias("games"),
            F.sum(F.when(F.col("piece_no") == 0, F.col("hits"))).alias("hits"),
            F.max("longest").alias("longest"),
            F.max("recorded").alias("recorded"),
            F.max_by("latest_team_id", "day").alias("latest_team_id"),
        )
    )
    totals = runs.groupBy(entity).agg(
        F.sum("games").alias("games"),
        F.sum("hits").alias("hits"),
        F.max_by("length", "run_id").alias("active_streak"),
        F.greatest(F.max("length"), F.max("longest")).alias("best_streak"),
        F.max("recorded").alias("recorded"),
        F.max_by("latest_team_id", "run_id").alias("latest_team_id"),
    )
    return totals.filter("games > 0 and recorded = 1").select(
        entity,
        "games",
        "hits",
        (F.col("hits") * 100.0 / F.col("games")).alias("success_pct"),
        "active_streak",
        "best_streak",
        "latest_team_id",
    )


def player_hits(games: DataFrame, hit) -> DataFrame:
    """Every game of a player counts."""
    return games.select(
        "player_id",
        "team_id",
        "match_date",
        "match_id",
        F.lit(1).alias("played"),
        hit.cast("int").alias("hit"),
        F.lit(1).alias("recorded"),
    )


def club_hits(games: DataFrame, hit) -> DataFrame:
    """The club's finished matches; one without a statistic is a miss, whatever the condition."""
    is_hit = hit & (F.col("played") == 1) & (F.col("recorded") == 1)
    return games.filter(F.col("team_id").isNotNull()).select(
        "team_id", "match_date", "match_id", "played", is_hit.cast("int").alias("hit"), "recorded"
    )


def streaks(
    target: str,
    tables: StatsTables,
    ctx: DataFrame,
    category: str,
    metric: str,
    operator: str = ">=",
    threshold: float = 1.0,
    teams: Iterable[int] | None = None,
    limit: int | None = 100,
) -> DataFrame:
    """Players or clubs by active streak of games that meet a condition."""
    if metric not in game_columns(target, category):
        raise ValueError(f"{target} tables of {category!r} have no metric {metric!r}")
    hit = condition(F.round(metric, 6), operator, threshold)
    described_games = describable(ctx, tables.tournaments)
    clubs = club_names(tables.clubs)
    if target == "player":
        games = game_table(target, tables, described_games, category, teams=teams)
        summary = streak_summary(player_hits(games, hit), "player_id")
        entity, labels = "player_id", ["player", "current_club"]
    else:
        games = game_table(
            target, tables, described_games, category, teams=teams, calendar=finished(ctx)
        )
        summary = streak_summary(club_hits(games, hit), "team_id")
        entity, labels = "team_id", ["club"]
    ranking = [F.desc("active_streak"), F.desc(F.round("success_pct", 6)), F.asc(entity)]
    if limit is not None:
        summary = summary.orderBy(*ranking).limit(limit)
    if target == "player":
        names = tables.players.select(
            "player_id", F.col("team_id").alias("latest_team_id"), F.col("name").alias("player")
        )
        current = clubs.select(
            F.col("team_id").alias("latest_team_id"), F.col("club").alias("current_club")
        )
        named = (
            summary.join(names, ["player_id", "latest_team_id"])
            .join(current, "latest_team_id", "left")
            .withColumn("current_club", F.coalesce("current_club", F.lit(UNKNOWN_CLUB)))
        )
    else:
        named = summary.join(clubs, "team_id", "left").withColumn(
            "club", F.coalesce("club", F.lit(UNKNOWN_CLUB))
        )
    board = named.select(
        entity, *labels, "games", "hits", "success_pct", "active_streak", "best_streak"
    ).orderBy(*ranking)
    # The second limit drops nothing: with it the few rows are merged in order, not range-sorted.
    return board if limit is None else board.limit(limit)
