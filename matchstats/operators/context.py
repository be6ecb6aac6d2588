"""The analysis context: which matches, clubs and players a question is about."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchstats.schema import FINISHED_STATUS
from matchstats.sources.tables import StatsTables

GROUP_MODES = {
    "cumulative": [],
    "by_competition_season": ["competition", "season"],
    "by_season": ["season"],
    "by_competition": ["competition"],
}


def keep_ids(df: DataFrame, column: str, ids: Iterable | DataFrame | None) -> DataFrame:
    """Filter by a selection: a short list picked by a user or a DataFrame of ids.  None keeps all."""
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        return df.join(ids.select(F.col(ids.columns[0]).alias(column)), column, "left_semi")
    ids = list(ids)
    return df.filter(F.col(column).isin(ids)) if ids else df


def in_competition_season(
    matches: DataFrame,
    tournaments: DataFrame,
    competitions: Sequence[str] | None = None,
    seasons: Sequence[str] | None = None,
) -> DataFrame:
    """Matches of the chosen competitions and seasons; a selection that is empty or left out does not
    filter.  With both, the two id lists of the competition seasons chosen apply independently."""
    chosen = tournaments
    if competitions:
        chosen = chosen.filter(F.col("name").isin(list(competitions)))
    if seasons:
        chosen = chosen.filter(F.col("season_year").isin(list(seasons)))
    if competitions:
        ids = chosen.select(F.col("unique_tournament_id").alias("tournament_id"))
        matches = matches.join(ids, "tournament_id", "left_semi")
    if seasons:
        matches = matches.join(chosen.select("season_id"), "season_id", "left_semi")
    return matches


def available_seasons(tournaments: DataFrame, competitions: Sequence[str]) -> DataFrame:
    return (
        tournaments.filter(F.col("name").isin(list(competitions)))
        .select("season_year")
        .distinct()
        .orderBy(F.desc("season_year"))
    )


def default_season(
    tournaments: DataFrame, competitions: Sequence[str], preferred: Sequence[str] = ("2026", "25/26")
) -> DataFrame:
    """The first preferred season that exists, else the latest by name."""
    year = F.col("season_year")
    picks = [F.max(F.when(year == p, year)) for p in preferred]
    return tournaments.filter(F.col("name").isin(list(competitions))).agg(
        F.coalesce(*picks, F.max(year)).alias("season_year")
    )


def bounds(ctx: DataFrame) -> DataFrame:
    """Date and round limits of a context, with fallbacks for an empty one."""
    first, last = F.min("match_date"), F.max("match_date")
    dated = last.isNotNull()
    return ctx.agg(
        F.coalesce(F.to_date(first), F.lit(date(2020, 1, 1))).alias("min_date"),
        F.coalesce(F.to_date(last), F.current_date()).alias("max_date"),
        F.coalesce(F.when(dated, F.min("round_id")), F.lit(1)).alias("min_round"),
        F.coalesce(F.when(dated, F.max("round_id")), F.lit(38)).alias("max_round"),
    )


def in_date_range(matches: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Both days included; without an end, until today; without a start, from the first match on.
    Matches without a date are left out."""
    after_end = (end or date.today()) + timedelta(days=1)
    day = F.col("match_date")
    within = day < F.lit(after_end).cast("timestamp_ntz")
    if start is not None:
        within = (day >= F.lit(start).cast("timestamp_ntz")) & within
    return matches.filter(within)


def round_phases(ctx: DataFrame) -> DataFrame:
    """Each round and whether it belongs to the unbroken run 1, 2, 3, ... (a run of one does not).

    The run ends at the first round whose successor is missing, so no ordering over all rounds
    is needed: only two scalars are.
    """
    rounds = ctx.select("round_id").filter(F.col("round_id").isNotNull()).distinct()
    predecessors = rounds.select((F.col("round_id") - 1).alias("round_id"))
    run_end = (
        rounds.join(predecessors, "round_id", "left_anti").filter("round_id >= 1").agg(F.min("round_id"))
    )
    first, end = rounds.agg(F.min("round_id")).scalar(), run_end.scalar()
    return rounds.withColumn(
        "is_continuous", (first == 1) & (end > 1) & (F.col("round_id") <= end)
    )


def round_names(ctx: DataFrame) -> DataFrame:
    """Display name of every round outside the unbroken run."""
    names = (
        ctx.filter(F.col("round_id").isNotNull())
        .groupBy("round_id")
        .agg(F.min("round_name").alias("round_name"))
    )
    extra = round_phases(ctx).filter(~F.col("is_continuous"))
    return names.join(extra, "round_id", "left_semi").select(
        "round_id",
        F.coalesce("round_name", F.concat(F.lit("Phase "), F.col("round_id").cast("string"))).alias(
            "display_name"
        ),
    )


def round_condition(span: tuple[int, int] | None, extra: Sequence[int] = ()) -> Column:
    """A round range, extra rounds, either of both, or nothing at all."""
    in_span = F.col("round_id").between(*span) if span else F.lit(False)
    in_extra = F.col("round_id").isin(list(extra)) if extra else F.lit(False)
    return in_span | in_extra


def in_rounds(
    matches: DataFrame, span: tuple[int, int] | None, extra: Sequence[int] = ()
) -> DataFrame:
    return matches.filter(round_condition(span, extra))


def with_club(matches: DataFrame, team_ids: Iterable[int]) -> DataFrame:
    """Matches in which one of the clubs plays, on either side; no clubs keep all."""
    ids = list(team_ids)
    return matches.filter(F.col("home_team_id").isin(ids) | F.col("away_team_id").isin(ids)) if ids else matches


def clubs_in(ctx: DataFrame, clubs: DataFrame) -> DataFrame:
    ids = (
        ctx.select(F.col("home_team_id").alias("team_id"))
        .union(ctx.select("away_team_id"))
        .distinct()
    )
    return clubs.join(ids, "team_id", "left_semi").orderBy("name", "team_id")


def players_of(players: DataFrame, team_ids: Iterable[int] | DataFrame) -> DataFrame:
    return keep_ids(players, "team_id", team_ids).orderBy("name", "player_id", "team_id")


def player_ids_named(players: DataFrame, names: Sequence[str]) -> DataFrame:
    return players.filter(F.col("name").isin(list(names))).select("player_id").distinct()


def finished(matches: DataFrame) -> DataFrame:
    return matches.filter(F.col("status_code").isin(list(FINISHED_STATUS)))


def competitions_of(tournaments: DataFrame) -> DataFrame:
    """Tournament key with the names results are grouped by."""
    return tournaments.select(
        F.col("unique_tournament_id").alias("tournament_id"),
        "season_id",
        F.col("name").alias("competition"),
        F.col("season_year").alias("season"),
    )


def competitions_in(ctx: DataFrame, tournaments: DataFrame) -> DataFrame:
    """Competitions and seasons a context has matches of, in order."""
    keys = ctx.select("tournament_id", "season_id").distinct()
    named = keys.join(competitions_of(tournaments), ["tournament_id", "season_id"])
    return (
        named.select("competition", "season")
        .dropna()
        .distinct()
        .orderBy("competition", "season")
    )


def with_competition(matches: DataFrame, tournaments: DataFrame, how: str = "left") -> DataFrame:
    return matches.join(competitions_of(tournaments), ["tournament_id", "season_id"], how)


def describable(ctx: DataFrame, tournaments: DataFrame) -> DataFrame:
    """Matches a single-game table can list: known competition, season, title and date.

    A semi join, so that neither names nor their size estimate travel with the facts.
    """
    named = competitions_of(tournaments).dropna(subset=["competition", "season"])
    titled = ctx.dropna(subset=["home_team_name", "away_team_name", "match_date"])
    return titled.join(named, ["tournament_id", "season_id"], "left_semi")


def select_matches(
    tables: StatsTables,
    competitions: Sequence[str] | None = None,
    seasons: Sequence[str] | None = None,
    start: date | None = None,
    end: date | None = None,
    rounds: Column | None = None,
    teams: Iterable[int] | None = None,
) -> DataFrame:
    """All context filters together.  Each applies by itself; one that is left out or empty does not
    filter."""
    ctx = in_competition_season(tables.matches, tables.tournaments, competitions, seasons)
    if start is not None or end is not None:
        ctx = in_date_range(ctx, start, end)
    if rounds is not None:
        ctx = ctx.filter(rounds)
    return ctx if teams is None else with_club(ctx, teams)
