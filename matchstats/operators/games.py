"""Single-game tables: records and last games."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchstats.functions.metrics import with_ratios
from matchstats.functions.values import day_text, match_title
from matchstats.operators.context import competitions_of, describable
from matchstats.operators.facts import club_rows, metric_sum, player_rows
from matchstats.operators.leaderboards import UNKNOWN_CLUB, club_names
from matchstats.registry import MetricSource, club_sources, columns_for, player_sources
from matchstats.schema import MINUTES
from matchstats.sources.tables import StatsTables

TARGETS = ("player", "club")
_IDENTITY = {"player": ["player_id", "team_id"], "club": ["team_id"]}


def game_sources(target: str, category: str, prefer_match: bool = False) -> list[MetricSource]:
    """Metrics of a single-game table; player tables also list the minutes played."""
    if target not in TARGETS:
        raise ValueError(f"unknown target {target!r}; use one of {TARGETS}")
    if target == "player":
        return [*player_sources(category), MetricSource(MINUTES, MINUTES, "player")]
    return club_sources(category, prefer_match)


def player_games(
    tables: StatsTables,
    games: DataFrame,
    sources: Sequence[MetricSource],
    venue: str = "both",
    teams: Iterable[int] | None = None,
) -> DataFrame:
    """One row per player, club and match; only players listed for that club.

    They are matched by an inner join on their unique key because a semi join would be moved
    below the aggregation, onto the raw facts.  The season is a key as well, so that the rows stay
    where the join of facts and matches, which prunes by season, has put them.
    """
    carry = ["match_date", "season_id"]
    rows = player_rows(tables, games, [s.key for s in sources], carry, teams=teams, venue=venue)
    listed = tables.players.filter(F.col("name").isNotNull()).select("player_id", "team_id")
    return (
        rows.groupBy("player_id", "team_id", "match_id", *carry)
        .agg(*[metric_sum(s) for s in sources])
        .drop("season_id")
        .join(listed, ["player_id", "team_id"])
    )


def club_games(
    tables: StatsTables,
    games: DataFrame,
    sources: Sequence[MetricSource],
    perspective: str = "for",
    venue: str = "both",
    teams: Iterable[int] | None = None,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """One row per club and match.

    With a ``calendar`` of matches, its fixtures go through the same aggregation: ``played`` tells
    whether the match is in the calendar and ``recorded`` whether there is any statistic.
    """
    rows = club_rows(
        tables, games, sources, perspective, carry=["match_date"], teams=teams, venue=venue
    )
    sums = [metric_sum(s, tagged=True) for s in sources]
    if calendar is not None:
        fixtures = calendar.select(
            F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"),
            "match_id",
            "match_date",
            F.lit("calendar").alias("source"),
        )
        rows = rows.unionByName(fixtures, allowMissingColumns=True)
        in_calendar = (F.col("source") == "calendar").cast("int")
        sums += [F.max(in_calendar).alias("played"), F.max(1 - in_calendar).alias("recorded")]
    return rows.groupBy("team_id", "match_id", "match_date").agg(*sums)


def game_table(
    target: str,
    tables: StatsTables,
    games: DataFrame,
    category: str,
    venue: str = "both",
    perspective: str = "for",
    teams: Iterable[int] | None = None,
    prefer_match: bool = False,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Per-game wide table with narrow identity columns and the category's metrics and ratios."""
    sources = game_sources(target, category, prefer_match)
    if target == "player":
        wide = player_games(tables, games, sources, venue, teams)
    else:
        wide = club_games(tables, games, sources, perspective, venue, teams, calendar)
    return with_ratios(wide, category, [s.metric for s in sources])


def described(target: str, tables: StatsTables, games: DataFrame, rows: DataFrame) -> DataFrame:
    """Attach names, competition, title and day to rows that have already been cut down."""
    identity = _IDENTITY[target]
    metrics = [c for c in rows.columns if c not in (*identity, "match_id", "match_date")]
    title = match_title(F.col("home_team_name"), F.col("away_team_name")).alias("title")
    named = (
        rows.join(games.select("match_id", "tournament_id", "season_id", title), "match_id")
        .join(competitions_of(tables.tournaments), ["tournament_id", "season_id"])
        .join(club_names(tables.clubs), "team_id", "left")
        .withColumn("club", F.coalesce("club", F.lit(UNKNOWN_CLUB)))
    )
    if target == "player":
        names = tables.players.select("player_id", "team_id", F.col("name").alias("player"))
        named = named.join(names, identity)
    labels = ["player", "club"] if target == "player" else ["club"]
    return named.select(
        *identity, *labels, "competition", "season", "title", "match_date",
        day_text(F.col("match_date")).alias("day"), "match_id", *metrics,
    )


def match_records(
    target: str,
    tables: StatsTables,
    ctx: DataFrame,
    category: str,
    metric: str,
    venue: str = "both",
    order: str = "highest",
    perspective: str = "for",
    teams: Iterable[int] | None = None,
    limit: int | None = 100,
) -> DataFrame:
    """The best (or lowest) single games of a metric; all games, unsorted, only with ``limit=None``."""
    if order not in ("highest", "lowest"):
        raise ValueError(f"unknown order {order!r}")
    if metric not in game_columns(target, category):
        raise ValueError(f"{target} tables of {category!r} have no metric {metric!r}")
    games = describable(ctx, tables.tournaments)
    rows = game_table(target, tables, games, category, venue, perspective, teams)
    if limit is None:
        return described(target, tables, games, rows)
    rank_by = F.round(metric, 6)
    ranking = [rank_by.asc() if order == "lowest" else rank_by.desc(), "match_id", *_IDENTITY[target]]
    top = rows.orderBy(*ranking).limit(limit)
    # The second limit drops nothing: with it the few rows are merged in order, not range-sorted.
    return described(target, tables, games, top).orderBy(*ranking).limit(limit)


def last_games(
    target: str,
    tables: StatsTables,
    ctx: DataFrame,
    category: str,
    n: int = 10,
    venue: str = "both",
    perspective: str = "for",
    teams: Iterable[int] | None = None,
) -> DataFrame:
    """The latest ``n`` games of every player or club, latest first; 0 keeps all games.

    The rank limit runs before the shuffle as well, so an entity with very many games sends
    only ``n`` rows per task.
    """
    games = describable(ctx, tables.tournaments)
    rows = game_table(target, tables, games, category, venue, perspective, teams, prefer_match=True)
    latest = [F.desc("match_date"), F.desc("match_id"), F.desc("team_id")]
    if n > 0:
        window = Window.partitionBy(_IDENTITY[target][0]).orderBy(*latest)
        rows = rows.withColumn("_rank", F.row_number().over(window)).filter(f"_rank <= {int(n)}")
        rows = rows.drop("_rank")
    return described(target, tables, games, rows).orderBy(*latest, _IDENTITY[target][0])


def game_columns(target: str, category: str, prefer_match: bool = False) -> list[str]:
    """Metric columns of a single-game table in display order."""
    return columns_for(category, [s.metric for s in game_sources(target, category, prefer_match)])
