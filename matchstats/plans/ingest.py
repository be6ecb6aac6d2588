"""Loading landed payloads into the tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.operators.context import finished
from matchstats.schema import FACTS
from matchstats.sources import landed, storage
from matchstats.sources import landing as L
from matchstats.sources.sinks import (
    loaded_near,
    move_facts,
    not_loaded,
    replace_facts,
    write_dimension,
)
from matchstats.sources.tables import read_table

def load_events(events: DataFrame, warehouse: str) -> None:
    """Tournaments, clubs and matches of delivered events.

    Facts of a match that has moved to another season move first: they are read by season.
    """
    matches = L.event_matches(events)
    known = read_table(events.sparkSession, warehouse, "matches").select(
        "match_id", F.col("season_id").alias("old_season_id")
    )
    changed = ~F.col("season_id").eqNullSafe(F.col("old_season_id"))
    moved = matches.select("match_id", "season_id").join(storage.dealt(known), "match_id").filter(changed)
    moved = storage.held(moved, warehouse, "moved")
    if not moved.isEmpty():
        for name in FACTS:
            move_facts(moved, warehouse, name)
    storage.let_go(events.sparkSession, warehouse, "moved")
    write_dimension(L.event_tournaments(events), warehouse, "tournaments")
    write_dimension(L.event_clubs(events), warehouse, "clubs")
    write_dimension(matches, warehouse, "matches")


def load_players(lineups: DataFrame, warehouse: str) -> None:
    """Players of matches from their latest lineups, which carry the columns of their match.

    The lineups are read for each table, without the statistics for the players: held flat for both they
    would take many times their stored size.
    """
    write_dimension(L.lineup_players(L.listed_players(lineups)), warehouse, "players")


def load_lineups(lineups: DataFrame, fetched: DataFrame, warehouse: str, fresh: int = storage.BUCKETS) -> None:
    """Player facts of the fetched matches (``match_id, season_id``) from their latest lineups."""
    replace_facts(L.lineup_stats(L.flatten_lineups(lineups)), fetched, warehouse, "player_stats_log", fresh)


def load_statistics(statistics: DataFrame, fetched: DataFrame, warehouse: str, fresh: int = storage.BUCKETS) -> None:
    """Match facts of the fetched matches from their latest statistics."""
    replace_facts(L.flatten_match_stats(statistics), fetched, warehouse, "match_stats_log", fresh)


def _pieces(chosen: DataFrame, warehouse: str, fresh: int) -> Iterator[DataFrame]:
    """Deliveries by groups of buckets of the player facts, so that no part is rewritten twice.

    As few as ``DELIVERIES_EACH`` go to their payloads and facts, which so are not shuffled for it.
    """
    spark = chosen.sparkSession
    count = storage.buckets(spark, storage.current_parts(spark, warehouse, "player_stats_log"), fresh)
    bucket = storage.bucket_of("match_id", count)
    groups = storage.bucket_groups(chosen, bucket, landed.DELIVERIES_EACH)
    for group, rows in groups:
        piece = chosen.filter(bucket.isin(group)) if len(groups) > 1 else chosen
        yield F.broadcast(piece) if rows <= landed.DELIVERIES_EACH else storage.dealt(piece)


def _load_delivered(
    spark: SparkSession, warehouse: str, held: DataFrame, wanted: DataFrame, kinds: Iterable[str], fresh: int
) -> None:
    """Load the latest deliveries that there are of the wanted matches, lineups first.

    Players come from all of them at once, as a player's latest lineups count; facts go piece by piece.
    """
    of_match = wanted.select("match_id", "season_id", "home_team_id", "away_team_id")
    held = held.filter(F.col("kind").isin(list(kinds)))
    chosen = storage.held(held.join(storage.dealt(of_match), "match_id"), warehouse, "chosen")
    if chosen.isEmpty():
        storage.let_go(spark, warehouse, "chosen")
        return
    with_lineups = chosen.filter("kind = 'lineups'")
    if "lineups" in kinds and not with_lineups.isEmpty():
        load_players(landed.delivered_payloads(spark, warehouse, "lineups", with_lineups), warehouse)
    for piece in _pieces(chosen, warehouse, fresh):
        for kind, load in (("lineups", load_lineups), ("statistics", load_statistics)):
            if kind in kinds:
                own = landed.delivered_payloads(spark, warehouse, kind, piece)
                load(own, piece.filter(F.col("kind") == kind), warehouse, fresh)
    # the chosen ones stay until the next load, as what was made of them may still be read


def ingest(
    spark: SparkSession, landing: str, warehouse: str, force: bool = False, on_broken: str = "quarantine"
) -> dict[str, int]:
    """Load what has landed since the last load: dimensions always, facts of finished matches that are
    not loaded yet; with ``force``, of all finished matches ever landed.

    A match is looked at when an event, lineups or statistics of it have newly landed.  One with
    lineups but no statistics counts as not loaded and is read again then; replacing its rows
    instead of appending them keeps its sums right.  Of a match that was delivered more than once
    the latest delivery counts, as a whole.  Statistics are written last, so a match counts as
    loaded only after its lineups are in.

    Of what earlier loads have landed, only deliveries that still wait for their match are looked at,
    and of the log only the folders that hold those of the wanted matches.

    Returns how many lines of each kind have been no payload so far (``landed.quarantine`` has them).
    With ``on_broken="fail"`` such lines of new files raise before any table is written, and the files
    stay new: once they have been put right or removed, the next load goes on.
    """
    now = landed.absorb(spark, landing, warehouse, on_broken)
    broken: dict[str, int] = {}
    for (_, kind), lines in sorted(now.broken.items()):
        broken[kind] = broken.get(kind, 0) + lines
    new = now.loads if force else now.new
    if not new:
        return broken
    events = L.flatten_events(landed.payloads(spark, warehouse, "events", new))
    if not events.isEmpty():
        load_events(events, warehouse)

    fresh = landed.deliveries(spark, warehouse, new)
    held = storage.held(landed.latest(fresh if force else now.waiting.union(fresh)), warehouse, "deliveries")
    touched = events.select(F.col("event.id").alias("match_id")).union(fresh.select("match_id"))
    known = finished(read_table(spark, warehouse, "matches"))
    known = known.select("match_id", "season_id", "home_team_id", "away_team_id")
    wanted = storage.held(known.join(storage.dealt(touched), "match_id", "left_semi"), warehouse, "wanted")
    missing = wanted if force else not_loaded(wanted, storage.dealt(loaded_near(wanted, warehouse)))
    _load_delivered(spark, warehouse, held, missing, landed.BY_MATCH, now.buckets // landed.BUCKETS_EACH)
    # what is loaded now waits no longer
    loaded = loaded_near(known.join(storage.dealt(held), "match_id", "left_semi"), warehouse)
    waiting = held.join(storage.dealt(loaded), "match_id", "left_anti")
    landed.commit(spark, warehouse, now._replace(done=sorted(now.loads), new=[], waiting=waiting))
    storage.let_go(spark, warehouse, "deliveries", "wanted")
    return broken


#: Which buckets a reprocessing that was broken off has behind it.
_REPROCESSED = "_reprocess"


def reprocess(spark: SparkSession, landing: str, warehouse: str) -> list[int]:
    """Rebuild the player facts of all finished matches with the club of the player's side.

    It goes from bucket to bucket of the facts, each with the folders of the log and the parts of the
    facts that belong to it, and notes which are behind it; one that broke off goes on with the rest.
    Returns the buckets that this run has rebuilt.
    """
    now = landed.absorb(spark, landing, warehouse)
    matches = finished(read_table(spark, warehouse, "matches"))
    held = storage.held(landed.latest(landed.deliveries(spark, warehouse, now.loads)), warehouse, "deliveries")
    fresh = now.buckets // landed.BUCKETS_EACH
    count = storage.buckets(spark, storage.current_parts(spark, warehouse, "player_stats_log"), fresh)
    folder = f"{warehouse}/{_REPROCESSED}"
    noted = storage.version_path(spark, folder)
    behind = {(r.bucket, r.buckets, r.loads) for r in spark.read.parquet(noted).collect()} if noted else set()
    # of another set of loads or buckets nothing is behind
    loads = ",".join(map(str, sorted(now.loads)))
    rest = [b for b in range(count) if (b, count, loads) not in behind]
    behind = {note for note in behind if note[1:] == (count, loads)}
    for bucket in rest:
        here = storage.bucket_of("match_id", count) == bucket
        _load_delivered(spark, warehouse, held.filter(here), matches.filter(here), ["lineups"], fresh)
        behind.add((bucket, count, loads))
        rows = spark.createDataFrame(sorted(behind), "bucket int, buckets int, loads string")
        storage.write_version(rows.coalesce(1), folder)
    storage.let_go(spark, warehouse, "deliveries")
    storage.remove(spark, folder)
    return rest
