"""Player and club leaderboards."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstats.functions.metrics import apply_calc_mode, with_ratios
from matchstats.operators.context import GROUP_MODES, competitions_of, keep_ids
from matchstats.operators.facts import club_rows, player_rows
from matchstats.registry import CATEGORIES, MetricSource, club_sources, player_sources
from matchstats.schema import MINUTES
from matchstats.sources.tables import StatsTables

UNKNOWN_CLUB = "Unknown"
COMPETITION_IDS = ["tournament_id", "season_id"]


def _carried(by: Sequence[str]) -> list[str]:
    """Match columns to group facts by: the competition's ids stand for its names."""
    named = [c for c in by if c in ("competition", "season")]
    return [*(COMPETITION_IDS if named else []), *[c for c in by if c not in named]]


def entity_totals(
    rows: DataFrame,
    tournaments: DataFrame,
    entity: str,
    sources: Sequence[MetricSource],
    by: Sequence[str],
) -> DataFrame:
    """Games, minutes and metric sums of long rows, one column per metric.

    First one narrow row per entity and metric, for minutes per match as well: that makes the
    matches distinct, and what is shuffled is as wide for one metric as for twenty.  A very common
    entity is spread over its matches there.  Only then do metrics become columns.  Competition
    ids are rolled up to names last (a match belongs to one competition season, so games add up);
    groups without a name drop out, as do those without a minutes row or without a metric row.
    """
    carried = _carried(by)
    # SQL texts, as in metric_sum: a call for each of their parts would take longer than the plan
    is_minutes = f"metric_key = '{MINUTES}'"
    cases = [f"WHEN {is_minutes} THEN 0"]
    for number, source in enumerate(sources, start=1):
        of_source = f" AND source = '{source.source}'" if "source" in rows.columns else ""
        cases.append(f"WHEN metric_key = '{source.key}'{of_source} THEN {number}")
    sums = (
        rows.selectExpr("*", f"CASE {' '.join(cases)} END AS place", f"CASE WHEN {is_minutes} THEN match_id END AS minutes_match")
        .groupBy(entity, *carried, "place", "minutes_match")
        .agg(F.sum("value").alias("value"))
    )
    wide = [f"coalesce(sum(CASE WHEN place = {n} THEN value END), 0D) AS `{s.metric}`" for n, s in enumerate(sources, start=1)]
    totals = sums.groupBy(entity, *carried).agg(
        F.count("minutes_match").alias("games"),
        F.expr("sum(CASE WHEN place = 0 THEN value END) AS minutes"),
        F.max("place").alias("_last_place"),
        *map(F.expr, wide),
    )
    if COMPETITION_IDS[0] in carried:
        metrics = [s.metric for s in sources]
        totals = (
            totals.join(competitions_of(tournaments), COMPETITION_IDS)
            .dropna(subset=list(by))
            .groupBy(entity, *by)
            .agg(
                *[F.sum(c).alias(c) for c in ("games", "minutes", *metrics)],
                F.max("_last_place").alias("_last_place"),
            )
        )
    return totals.filter("games > 0 and _last_place > 0").drop("_last_place")


def player_totals(
    tables: StatsTables,
    ctx: DataFrame,
    sources: Sequence[MetricSource],
    by: Sequence[str] = (),
    venue: str = "both",
    teams: Iterable[int] | None = None,
    players: Iterable[int] | None = None,
) -> DataFrame:
    """Games, minutes and metric sums per player (and group) in one pass over the facts."""
    keys = [s.key for s in sources] + [MINUTES]
    rows = player_rows(tables, ctx, keys, _carried(by), teams, players, venue)
    totals = entity_totals(rows, tables.tournaments, "player_id", sources, by)
    return totals.filter(F.col("minutes").isNotNull())


def player_names(players: DataFrame, positions: Sequence[str] | None = None) -> DataFrame:
    """One row per player; the shown position is among the wanted ones."""
    return (
        keep_ids(players, "position", positions)
        .groupBy("player_id")
        .agg(F.max("name").alias("player"), F.max("position").alias("position"))
        .dropna(subset=["player", "position"])
    )


def club_lists(
    tables: StatsTables,
    ctx: DataFrame,
    teams: Iterable[int] | None = None,
    players: Iterable[int] | None = None,
) -> DataFrame:
    """Names of all clubs a player has minutes for, whatever the venue.

    Pairs are made unique before the names are gathered, so what is gathered per player is
    bounded by the number of clubs.
    """
    pairs = (
        player_rows(tables, ctx, [MINUTES], teams=teams, players=players)
        .select("player_id", "team_id")
        .distinct()
    )
    return (
        pairs.join(club_names(tables.clubs), "team_id", "left")
        .groupBy("player_id")
        .agg(F.collect_set(F.coalesce("club", F.lit(UNKNOWN_CLUB))).alias("clubs"))
        .select("player_id", F.array_join(F.array_sort("clubs"), ",").alias("club"))
    )


def club_names(clubs: DataFrame) -> DataFrame:
    return clubs.select("team_id", F.col("name").alias("club"))


def player_leaderboard(
    tables: StatsTables,
    ctx: DataFrame,
    category: str,
    group_mode: str = "cumulative",
    venue: str = "both",
    teams: Iterable[int] | None = None,
    players: Iterable[int] | None = None,
    positions: Sequence[str] | None = None,
    calc_mode: str = "total",
    min_games: int = 1,
    min_minutes: float = 0,
) -> DataFrame:
    """Players ranked by the category's first metric."""
    by = GROUP_MODES[group_mode]
    sources = player_sources(category)
    metrics = [s.metric for s in sources]
    # the clubs take a pass of their own over the minutes: the one that sums up reads no clubs
    board = (
        player_totals(tables, ctx, sources, by, venue, teams, players)
        .filter((F.col("games") >= min_games) & (F.col("minutes") >= min_minutes))
        .join(player_names(tables.players, positions), "player_id")
        .join(club_lists(tables, ctx, teams, players), "player_id", "left")
        .withColumn("club", F.coalesce("club", F.lit(UNKNOWN_CLUB)))
    )
    identity = ["player_id", "player", "club", "position", *by]
    return _finish(board, category, identity, metrics, calc_mode)


def club_totals(
    tables: StatsTables,
    ctx: DataFrame,
    sources: Sequence[MetricSource],
    by: Sequence[str] = (),
    perspective: str = "for",
    period: str = "ALL",
    venue: str = "both",
    teams: Iterable[int] | None = None,
) -> DataFrame:
    """Games and metric sums per club (and group).

    Appearances, player metrics and match metrics go through one aggregation, which takes the
    place of joining three separately grouped tables.  Without metrics the result is empty.
    """
    rows = club_rows(
        tables, ctx, sources, perspective, period, _carried(by), teams, venue,
        with_minutes=bool(sources),
    )
    return club_row_totals(rows, tables, sources, by)


def club_row_totals(
    rows: DataFrame, tables: StatsTables, sources: Sequence[MetricSource], by: Sequence[str] = ()
) -> DataFrame:
    """Totals of club rows; a club's minutes are its games times 90."""
    known = rows.filter(F.col("team_id").isNotNull())
    totals = entity_totals(known, tables.tournaments, "team_id", sources, by)
    return totals.withColumn("minutes", F.col("games") * 90)


def club_leaderboard(
    tables: StatsTables,
    ctx: DataFrame,
    category: str,
    group_mode: str = "cumulative",
    perspective: str = "for",
    period: str = "ALL",
    venue: str = "both",
    teams: Iterable[int] | None = None,
    calc_mode: str = "total",
    min_games: int = 1,
    min_minutes: float = 0,
) -> DataFrame:
    """Clubs ranked by the category's first metric, by what they did or conceded."""
    by = GROUP_MODES[group_mode]
    sources = club_sources(category, prefer_match=True, period=period)
    board = (
        club_totals(tables, ctx, sources, by, perspective, period, venue, teams)
        .filter((F.col("games") >= min_games) & (F.col("minutes") >= min_minutes))
        .join(club_names(tables.clubs), "team_id", "left")
        .withColumn("club", F.coalesce("club", F.lit(UNKNOWN_CLUB)))
    )
    return _finish(board, category, ["team_id", "club", *by], [s.metric for s in sources], calc_mode)


def _finish(
    board: DataFrame, category: str, identity: list[str], metrics: list[str], calc_mode: str
) -> DataFrame:
    """Ratios from totals, then the calculation mode, then display order and sort."""
    wide = with_ratios(board.select(*identity, "games", "minutes", *metrics), category, metrics)
    scaled = apply_calc_mode(wide, metrics, calc_mode)
    scaled = scaled.withColumns({c: F.col(c).cast("long") for c in ("games", "minutes")})
    first = CATEGORIES[category][0]
    sort_by = F.round(first, 6) if first in metrics else F.col("minutes")
    ties = [c for c in identity if c not in ("player", "club", "position")]
    return scaled.orderBy(sort_by.desc(), *ties)
