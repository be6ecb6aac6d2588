"""Head-to-head comparison and the impact of one player on the club."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchstats.functions.metrics import best_flags, calc_value, ratio
from matchstats.operators.context import competitions_of, with_club
from matchstats.operators.facts import club_rows, player_rows
from matchstats.operators.leaderboards import (
    club_row_totals,
    club_totals,
    player_names,
    player_totals,
)
from matchstats.registry import CATEGORIES, RATIOS, club_sources, columns_for, player_sources
from matchstats.schema import MINUTES
from matchstats.sources.tables import StatsTables


def _side_by_side(
    totals: DataFrame,
    sides: dict[str, Column],
    metrics: Sequence[str],
    shown: Sequence[str],
    calc_mode: str,
) -> DataFrame:
    """Sum each side's rows and list the metrics one below the other with better-of-two flags.

    The lines come from one row, so they are in display order without a sort.
    """
    first, second = sides
    summed = [*metrics, "games", "minutes"]
    one_row = totals.agg(
        F.count(F.when(reduce(lambda a, b: a | b, sides.values()), 1)).alias("rows"),
        *[
            F.coalesce(F.sum(F.when(chosen, F.col(c))), F.lit(0)).cast("double").alias(f"{side}.{c}")
            for side, chosen in sides.items()
            for c in summed
        ],
    ).filter("rows > 0")

    def total(side: str, name: str) -> Column:
        return F.col(f"`{side}.{name}`")

    def shown_value(side: str, name: str) -> Column:
        if name in RATIOS:
            numerator, terms = RATIOS[name]
            if not {numerator, *terms} <= set(metrics):
                return F.lit(0.0)
            return ratio(total(side, numerator), reduce(add, [total(side, t) for t in terms]))
        if name not in metrics:
            return F.lit(0.0)
        return calc_value(total(side, name), total(side, "games"), total(side, "minutes"), calc_mode)

    lines = [
        F.struct(
            F.lit(name).alias("metric"),
            shown_value(first, name).alias(first),
            shown_value(second, name).alias(second),
        )
        for name in shown
    ]
    flags = best_flags(F.col(first), F.col(second), F.col("metric"))
    listed = one_row.select(
        F.inline(F.array(*lines)),
        *[
            total(side, c).cast("long").alias(f"{c}_{side.removeprefix('value_')}")
            for side in sides
            for c in ("games", "minutes")
        ],
    )
    return listed.withColumns(
        {
            f"{side.removeprefix('value_')}_best": flag
            for side, flag in zip(sides, flags, strict=True)
        }
    )


def _within(competitions: Sequence[str] | None, seasons: Sequence[str] | None) -> Column:
    chosen = F.lit(True)
    if competitions:
        chosen = chosen & F.col("competition").isin(list(competitions))
    if seasons:
        chosen = chosen & F.col("season").isin(list(seasons))
    return chosen


def compare(
    target: str,
    tables: StatsTables,
    ctx: DataFrame,
    a: int,
    b: int,
    category: str,
    calc_mode: str = "total",
    perspective: str = "for",
    a_competitions: Sequence[str] | None = None,
    a_seasons: Sequence[str] | None = None,
    b_competitions: Sequence[str] | None = None,
    b_seasons: Sequence[str] | None = None,
) -> DataFrame:
    """Two players or clubs, each within its own competitions and seasons.

    What players concede is not known, so ``against`` applies to clubs only.
    """
    by = ["competition", "season"]
    if target == "player":
        entity, sources = "player_id", player_sources(category)
        totals = player_totals(tables, ctx, sources, by, players=[a, b])
        totals = totals.join(player_names(tables.players), "player_id", "left_semi")
    elif target == "club":
        entity, sources = "team_id", club_sources(category, prefer_match=True)
        totals = club_totals(tables, ctx, sources, by, perspective, teams=[a, b])
    else:
        raise ValueError(f"unknown target {target!r}")
    sides = {
        "value_a": (F.col(entity) == a) & _within(a_competitions, a_seasons),
        "value_b": (F.col(entity) == b) & _within(b_competitions, b_seasons),
    }
    metrics = [s.metric for s in sources]
    return _side_by_side(totals, sides, metrics, CATEGORIES[category], calc_mode)


def _club_matches(
    tables: StatsTables,
    ctx: DataFrame,
    team: int,
    competitions: Sequence[str] | None,
    seasons: Sequence[str] | None,
) -> DataFrame:
    matches = with_club(ctx, [team])
    if not competitions and not seasons:
        return matches
    named = competitions_of(tables.tournaments).filter(_within(competitions, seasons))
    return matches.join(named, ["tournament_id", "season_id"], "left_semi")


def _with_played(
    rows: DataFrame, tables: StatsTables, matches: DataFrame, player: int
) -> DataFrame:
    """Flag rows of matches in which the player got minutes, for whichever side."""
    appearances = (
        player_rows(tables, matches, [MINUTES], players=[player])
        .filter(F.col("value") > 0)
        .select("match_id", F.lit(True).alias("played"))
        .distinct()
    )
    flagged = rows.join(appearances, "match_id", "left")
    return flagged.withColumn("played", F.coalesce("played", F.lit(False)))


def with_without_split(
    tables: StatsTables,
    ctx: DataFrame,
    player: int,
    team: int,
    competitions: Sequence[str] | None = None,
    seasons: Sequence[str] | None = None,
) -> DataFrame:
    """The club's matches with a flag: did the player play."""
    matches = _club_matches(tables, ctx, team, competitions, seasons)
    return _with_played(matches, tables, matches, player)


def with_without(
    tables: StatsTables,
    ctx: DataFrame,
    player: int,
    team: int,
    category: str,
    calc_mode: str = "total",
    perspective: str = "for",
    competitions: Sequence[str] | None = None,
    seasons: Sequence[str] | None = None,
) -> DataFrame:
    """The club's numbers in matches with and without the player, from one pass over the facts."""
    matches = _club_matches(tables, ctx, team, competitions, seasons)
    sources = club_sources(category, prefer_match=True)
    rows = club_rows(tables, matches, sources, perspective, teams=[team], with_minutes=True)
    rows = _with_played(rows, tables, matches, player)
    totals = club_row_totals(rows, tables, sources, ["played"])
    metrics = [s.metric for s in sources]
    sides = {"value_with": F.col("played"), "value_without": ~F.col("played")}
    return _side_by_side(totals, sides, metrics, columns_for(category, metrics), calc_mode)
