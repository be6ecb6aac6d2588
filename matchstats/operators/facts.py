"""Fact rows of a context, attributed to players or clubs.

Facts and matches meet in an ordinary equi-join: Spark broadcasts the match side only when its
size is under the broadcast threshold, otherwise it prunes the facts with a bloom filter and
splits skewed matches at run time.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchstats.operators.context import keep_ids
from matchstats.registry import MetricSource
from matchstats.schema import MINUTES, NO_SEASON
from matchstats.sources.tables import StatsTables

_SIDES = {"home": "home_team_id", "away": "away_team_id"}
VENUES = ("both", *_SIDES)
PERSPECTIVES = ("for", "against")


def _check(value: str, allowed: Sequence[str]) -> None:
    if value not in allowed:
        raise ValueError(f"unknown value {value!r}; use one of {tuple(allowed)}")


def _with_matches(facts: DataFrame, ctx: DataFrame, columns: dict[str, Column], how: str) -> DataFrame:
    """Join facts to the match columns wanted, by match and any further column of the same name.

    Where the facts have the season, it is a join column as well, so that partitions are pruned.
    """
    wanted = {"match_id": F.col("match_id"), **columns}
    if "season_id" in facts.columns and "season_id" in ctx.columns:
        wanted["season_id"] = F.coalesce("season_id", F.lit(NO_SEASON))
    matches = ctx.select(*[column.alias(name) for name, column in wanted.items()])
    return facts.join(matches, [c for c in wanted if c in facts.columns], how)


def at_venue(df: DataFrame, venue: str) -> DataFrame:
    """Rows whose team plays on the wanted side; needs the match's team columns."""
    _check(venue, VENUES)
    return df if venue == "both" else df.filter(F.col("team_id") == F.col(_SIDES[venue]))


def player_rows(
    tables: StatsTables,
    ctx: DataFrame,
    keys: Sequence[str],
    carry: Sequence[str] = (),
    teams: Iterable[int] | None = None,
    players: Iterable[int] | None = None,
    venue: str = "both",
) -> DataFrame:
    """Player facts of a context with the match columns in ``carry``."""
    _check(venue, VENUES)
    facts = tables.player_stats.filter(F.col("metric_key").isin(list(keys)))
    facts = keep_ids(keep_ids(facts, "team_id", teams), "player_id", players)
    columns = {c: F.col(c) for c in carry}
    if venue != "both":
        columns["team_id"] = F.col(_SIDES[venue])
    joined = _with_matches(facts, ctx, columns, "inner" if carry else "left_semi")
    return joined.select("match_id", "player_id", "team_id", "metric_key", "value", *carry)


def club_player_rows(
    tables: StatsTables,
    ctx: DataFrame,
    keys: Sequence[str],
    perspective: str = "for",
    carry: Sequence[str] = (),
    teams: Iterable[int] | None = None,
    venue: str = "both",
) -> DataFrame:
    """Player facts credited to clubs: to the player's own, or to the other side as conceded.

    Minutes always stay with the player's own club, as they count its games.
    """
    _check(perspective, PERSPECTIVES)
    facts = tables.player_stats.filter(F.col("metric_key").isin(list(keys)))
    if perspective == "for":
        facts = keep_ids(facts, "team_id", teams)
    columns = {c: F.col(c) for c in (*_SIDES.values(), *carry)}
    rows = _with_matches(facts, ctx, columns, "inner")
    if perspective == "against":
        others = F.filter(
            F.array("home_team_id", "away_team_id"), lambda team: team != F.col("team_id")
        )
        credited = F.when(F.col("metric_key") == MINUTES, F.array("team_id")).otherwise(others)
        rows = keep_ids(rows.withColumn("team_id", F.explode(credited)), "team_id", teams)
    return at_venue(rows, venue).select(
        "team_id", "match_id", "metric_key", "value", *carry, F.lit("player").alias("source")
    )


def club_match_rows(
    tables: StatsTables,
    ctx: DataFrame,
    keys: Sequence[str],
    perspective: str = "for",
    period: str = "ALL",
    carry: Sequence[str] = (),
    teams: Iterable[int] | None = None,
    venue: str = "both",
) -> DataFrame:
    """Match facts fanned out to both clubs; each gets its own value or the opponent's."""
    _check(perspective, PERSPECTIVES)
    facts = tables.match_stats.filter(
        (F.col("period") == period) & F.col("metric_key").isin(list(keys))
    )
    columns = {c: F.col(c) for c in (*_SIDES.values(), *carry)}
    sides = F.explode(F.array("home_team_id", "away_team_id"))
    rows = _with_matches(facts, ctx, columns, "inner").withColumn("team_id", sides)
    own, other = ("home_value", "away_value") if perspective == "for" else ("away_value", "home_value")
    value = F.when(F.col("home_team_id") == F.col("team_id"), F.col(own)).otherwise(F.col(other))
    return at_venue(keep_ids(rows, "team_id", teams), venue).select(
        "team_id", "match_id", "metric_key", value.alias("value"), *carry, F.lit("match").alias("source")
    )


def club_rows(
    tables: StatsTables,
    ctx: DataFrame,
    sources: Sequence[MetricSource],
    perspective: str = "for",
    period: str = "ALL",
    carry: Sequence[str] = (),
    teams: Iterable[int] | None = None,
    venue: str = "both",
    with_minutes: bool = False,
) -> DataFrame:
    """Both kinds of club rows in one long table; a fact without wanted keys is not read."""
    player_keys = [s.key for s in sources if s.source == "player"]
    match_keys = [s.key for s in sources if s.source == "match"]
    if with_minutes:
        player_keys.append(MINUTES)
    parts = []
    if player_keys:
        parts.append(club_player_rows(tables, ctx, player_keys, perspective, carry, teams, venue))
    if match_keys:
        parts.append(club_match_rows(tables, ctx, match_keys, perspective, period, carry, teams, venue))
    if not parts:
        return club_player_rows(tables, ctx, [MINUTES], carry=carry).filter(F.lit(False))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def metric_sum(source: MetricSource, tagged: bool = False) -> Column:
    """Sum of one metric over long rows, 0 where it never occurs.

    One SQL text: put together from columns, an expression takes a call to the JVM for each part, and a
    table has a score of them.
    """
    wanted = f"metric_key = '{source.key}'" + (f" AND source = '{source.source}'" if tagged else "")
    return F.expr(f"coalesce(sum(CASE WHEN {wanted} THEN value END), 0D) AS `{source.metric}`")
