"""Landed JSON payloads: their schemas, readers and flattening into table rows.

The flattening works on any DataFrame with the payload columns, so batch files, streamed files and
parsed strings share it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.functions.labels import with_metric_name
from matchstats.functions.values import is_scalar, percent_value, stat_value
from matchstats.sources import storage
from matchstats.sources.tables import keep_first

KINDS = ("rounds", "events", "statistics", "lineups")

_TEAM = (
    "STRUCT<id: BIGINT, name: STRING, shortName: STRING, slug: STRING, gender: STRING, "
    "nameCode: STRING, disabled: BOOLEAN, national: BOOLEAN, type: INT, "
    "teamColors: STRUCT<primary: STRING, secondary: STRING>>"
)
_EVENT = (
    "STRUCT<id: BIGINT, startTimestamp: BIGINT, "
    "tournament: STRUCT<uniqueTournament: STRUCT<id: BIGINT, name: STRING, slug: STRING>, "
    "category: STRUCT<name: STRING>>, "
    "season: STRUCT<id: BIGINT, name: STRING, year: STRING>, "
    "roundInfo: STRUCT<round: INT, name: STRING, slug: STRING>, "
    f"status: STRUCT<code: INT>, homeTeam: {_TEAM}, awayTeam: {_TEAM}, "
    "homeScore: STRUCT<current: INT>, awayScore: STRUCT<current: INT>>"
)
_ITEM = (
    "STRUCT<key: STRING, homeValue: STRING, awayValue: STRING, homeTotal: STRING, awayTotal: STRING>"
)
_PERIOD = f"STRUCT<period: STRING, groups: ARRAY<STRUCT<statisticsItems: ARRAY<{_ITEM}>>>>"
_PLAYER = (
    "STRUCT<id: BIGINT, name: STRING, slug: STRING, shortName: STRING, position: STRING, "
    "jerseyNumber: STRING, height: INT, country: STRUCT<alpha3: STRING>, "
    "dateOfBirthTimestamp: BIGINT, proposedMarketValueRaw: STRUCT<value: DOUBLE>>"
)
_LINEUP = (
    f"STRUCT<players: ARRAY<STRUCT<position: STRING, player: {_PLAYER}, "
    "statistics: MAP<STRING, STRING>>>>"
)
_FIELDS = {
    "rounds": "rounds ARRAY<STRUCT<round: INT, slug: STRING, name: STRING>>",
    "events": f"events ARRAY<{_EVENT}>",
    "statistics": f"statistics ARRAY<{_PERIOD}>",
    "lineups": f"home {_LINEUP}, away {_LINEUP}",
}
_ENVELOPE = {
    "rounds": "tournament_id BIGINT, season_id BIGINT",
    "events": "tournament_id BIGINT, season_id BIGINT",
    "statistics": "match_id BIGINT",
    "lineups": "match_id BIGINT",
}

# One schema per payload kind (number and text values are both read as text), and all in one.
SCHEMAS = {kind: f"{_ENVELOPE[kind]}, {_FIELDS[kind]}" for kind in KINDS}
ANY_PAYLOAD = "tournament_id BIGINT, season_id BIGINT, match_id BIGINT, " + ", ".join(_FIELDS.values())

_LANDED_AT = "_metadata.file_modification_time AS landed_at"


# A line that is no payload of its kind, whole; NULL for every other line.
BROKEN = "_broken"


def read_files(spark: SparkSession, paths: Sequence[str], kind: str) -> DataFrame:
    """Payloads of landed files (one to a line), with the file, the time it was landed and, of lines
    that are no payload, the line."""
    reader = spark.read.schema(f"{SCHEMAS[kind]}, {BROKEN} STRING").option("recursiveFileLookup", "true")
    reader = reader.option("columnNameOfCorruptRecord", BROKEN)
    return reader.json(list(paths)).selectExpr("*", _LANDED_AT, "_metadata.file_path AS file")


def read_payloads(spark: SparkSession, landing: str, kind: str) -> DataFrame:
    """All whole payloads of one kind, with the time each was landed."""
    if not storage.exists(spark, f"{landing}/{kind}"):
        return spark.createDataFrame([], SCHEMAS[kind]).withColumn(
            "landed_at", F.lit(None).cast("timestamp")
        )
    return read_files(spark, [f"{landing}/{kind}"], kind).filter(F.col(BROKEN).isNull()).drop(BROKEN, "file")


def stream_payloads(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    """Landed files of every kind as one stream, broken lines among them."""
    reader = spark.readStream.schema(f"{ANY_PAYLOAD}, {BROKEN} STRING").option("recursiveFileLookup", "true")
    reader = reader.option("columnNameOfCorruptRecord", BROKEN)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(landing).selectExpr("*", _LANDED_AT, "_metadata.file_path AS file")


def parse_payloads(texts: DataFrame, kind: str, column: str = "body") -> DataFrame:
    """Payloads held as JSON text in a column."""
    parsed = F.from_json(column, SCHEMAS[kind]).alias("payload")
    return texts.select(parsed, F.lit(None).cast("timestamp").alias("landed_at")).select(
        "payload.*", "landed_at"
    )


def flatten_rounds(payloads: DataFrame, competitions: DataFrame) -> DataFrame:
    """Rounds of each wanted competition season; 1 to 38 where no round list has landed."""
    assumed = F.transform(
        F.sequence(F.lit(1), F.lit(38)),
        lambda n: F.struct(
            n.alias("round"),
            F.lit(None).cast("string").alias("slug"),
            F.lit(None).cast("string").alias("name"),
        ),
    )
    landed = payloads.select(
        "tournament_id", "season_id", F.coalesce("rounds", F.array()).alias("rounds")
    )
    return (
        competitions.select("tournament_id", "season_id")
        .join(landed, ["tournament_id", "season_id"], "left")
        .select("tournament_id", "season_id", F.explode(F.coalesce("rounds", assumed)).alias("r"))
        .select(
            "tournament_id",
            "season_id",
            F.col("r.round").alias("round_id"),
            F.col("r.slug").alias("round_slug"),
            F.coalesce(
                F.col("r.name"), F.concat(F.lit("Round "), F.col("r.round").cast("string"))
            ).alias("round_name"),
        )
        .distinct()
    )


def flatten_events(payloads: DataFrame) -> DataFrame:
    """One row per delivered event."""
    return payloads.select(F.explode("events").alias("event"), "landed_at").filter(
        F.col("event.id").isNotNull()
    )


def _first_seen(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: from the latest landed file, there the first in ingest order."""
    return keep_first(rows, keys, [F.desc_nulls_last("landed_at"), *order])


def event_tournaments(events: DataFrame) -> DataFrame:
    tournament = "event.tournament.uniqueTournament"
    rows = events.select(
        F.col(f"{tournament}.id").alias("unique_tournament_id"),
        F.col(f"{tournament}.name").alias("name"),
        F.col(f"{tournament}.slug").alias("slug"),
        F.col("event.tournament.category.name").alias("category_name"),
        F.col("event.season.id").alias("season_id"),
        F.col("event.season.name").alias("season_name"),
        F.col("event.season.year").alias("season_year"),
        F.col("event.id").alias("match_id"),
        "landed_at",
    ).filter(F.coalesce("unique_tournament_id", F.lit(0)) != 0)
    keys = ["unique_tournament_id", "season_id"]
    return _first_seen(rows, keys, [F.asc("match_id")]).drop("match_id", "landed_at")


def event_clubs(events: DataFrame) -> DataFrame:
    sides = events.select(
        F.explode(F.array("event.homeTeam", "event.awayTeam")).alias("team"),
        F.col("event.id").alias("match_id"),
        "landed_at",
    )
    rows = sides.select(
        F.col("team.id").alias("team_id"),
        F.col("team.name").alias("name"),
        F.col("team.shortName").alias("short_name"),
        F.col("team.slug").alias("slug"),
        F.col("team.gender").alias("gender"),
        F.col("team.nameCode").alias("name_code"),
        F.col("team.disabled").alias("disabled"),
        F.col("team.national").alias("national"),
        F.col("team.type").alias("type"),
        F.col("team.teamColors.primary").alias("primary_color"),
        F.col("team.teamColors.secondary").alias("secondary_color"),
        "match_id",
        "landed_at",
    ).filter(F.coalesce("team_id", F.lit(0)) != 0)
    return _first_seen(rows, ["team_id"], [F.asc("match_id")]).drop("match_id", "landed_at")


def event_matches(events: DataFrame) -> DataFrame:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    rows = events.select(
        F.col("event.id").alias("match_id"),
        F.col("event.tournament.uniqueTournament.id").alias("tournament_id"),
        F.col("event.season.id").alias("season_id"),
        F.col("event.roundInfo.round").alias("round_id"),
        F.col("event.homeTeam.id").alias("home_team_id"),
        F.col("event.awayTeam.id").alias("away_team_id"),
        F.col("event.homeTeam.name").alias("home_team_name"),
        F.col("event.awayTeam.name").alias("away_team_name"),
        F.timestamp_add("SECOND", F.col("event.startTimestamp"), epoch).alias("match_date"),
        F.col("event.status.code").alias("status_code"),
        F.col("event.homeScore.current").alias("home_score"),
        F.col("event.awayScore.current").alias("away_score"),
        F.col("event.roundInfo.name").alias("round_name"),
        F.col("event.roundInfo.slug").alias("round_slug"),
        "landed_at",
    )
    # Deliveries landed at the same moment: the further advanced one.
    return _first_seen(rows, ["match_id"], [F.desc_nulls_last("status_code")]).drop("landed_at")


def with_match(payloads: DataFrame, matches: DataFrame) -> DataFrame:
    """Payloads of known matches, with the season and both clubs."""
    known = matches.select("match_id", "season_id", "home_team_id", "away_team_id")
    return payloads.join(known, "match_id")


def flatten_match_stats(payloads: DataFrame) -> DataFrame:
    """Statistic items of a match, plus one extra row for each item that has totals."""
    keep = [c for c in ("match_id", "season_id") if c in payloads.columns]
    items = (
        payloads.select(*keep, F.explode("statistics").alias("p"))
        .select(*keep, "p.period", F.explode("p.groups").alias("g"))
        .select(*keep, "period", F.explode("g.statisticsItems").alias("item"))
        .filter(F.coalesce("item.key", F.lit("")) != "")
    )
    named = with_metric_name(items.withColumn("metric_key", F.col("item.key")))
    own = F.struct(
        F.col("metric_key").alias("metric_key"),
        F.col("metric_name").alias("metric_name"),
        percent_value(F.col("item.homeValue")).alias("home_value"),
        percent_value(F.col("item.awayValue")).alias("away_value"),
    )
    total = F.struct(
        F.concat("metric_key", F.lit("Total")).alias("metric_key"),
        F.concat("metric_name", F.lit(" (Total)")).alias("metric_name"),
        percent_value(F.coalesce("item.homeTotal", F.lit("0"))).alias("home_value"),
        percent_value(F.coalesce("item.awayTotal", F.lit("0"))).alias("away_value"),
    )
    has_total = F.col("item.homeTotal").isNotNull() | F.col("item.awayTotal").isNotNull()
    variants = F.when(has_total, F.array(own, total)).otherwise(F.array(own))
    return named.select(*keep, "period", F.explode(variants).alias("v")).select(*keep, "period", "v.*")


def flatten_lineups(payloads: DataFrame) -> DataFrame:
    """One row per listed player, with the club on whose side the player is listed.

    The payloads carry their match's clubs; the statistics stay a map.
    """
    sides = F.array(
        F.struct(F.col("home_team_id").alias("team_id"), F.col("home.players").alias("players")),
        F.struct(F.col("away_team_id").alias("team_id"), F.col("away.players").alias("players")),
    )
    keep = ["match_id", "season_id", "landed_at"]
    return (
        payloads.select(*keep, F.explode(sides).alias("s"))
        .select(*keep, "s.team_id", F.explode("s.players").alias("listed"))
        .select(*keep, "team_id", "listed.*")
    )


def listed_players(payloads: DataFrame) -> DataFrame:
    """The rows of ``flatten_lineups`` with the player only: statistics are not read."""
    keep = ["match_id", "season_id", "landed_at"]
    teams = ["home_team_id", "away_team_id"]
    # paths, not structs, so that the scan leaves out the rest
    narrow = payloads.select(
        *keep, *teams, F.col("home.players.player").alias("home"), F.col("away.players.player").alias("away")
    )
    sides = F.array(
        F.struct(F.col("home_team_id").alias("team_id"), F.col("home").alias("players")),
        F.struct(F.col("away_team_id").alias("team_id"), F.col("away").alias("players")),
    )
    return narrow.select(*keep, F.explode(sides).alias("s")).select(
        *keep, "s.team_id", F.explode("s.players").alias("player")
    )


def lineup_players(lineups: DataFrame) -> DataFrame:
    """Player rows of lineups: one per player and club."""
    rows = lineups.select(
        F.col("player.id").alias("player_id"),
        F.col("player.name").alias("name"),
        F.col("player.slug").alias("slug"),
        F.col("player.shortName").alias("short_name"),
        "team_id",
        F.col("player.position").alias("position"),
        F.col("player.jerseyNumber").alias("jersey_number"),
        F.col("player.height").alias("height"),
        F.col("player.country.alpha3").alias("country_alpha3"),
        F.col("player.dateOfBirthTimestamp").alias("date_of_birth_timestamp"),
        F.col("player.proposedMarketValueRaw.value").alias("market_value"),
        F.col("match_id").alias("last_updated_match_id"),
        "landed_at",
    ).filter(F.coalesce("player_id", F.lit(0)) != 0)
    keys = ["player_id", "team_id"]
    return _first_seen(rows, keys, [F.asc("last_updated_match_id")]).drop("landed_at")


def lineup_stats(lineups: DataFrame) -> DataFrame:
    """Player facts: one row per statistic; nested statistics are left out."""
    stats = lineups.select(
        "match_id",
        F.col("player.id").alias("player_id"),
        "team_id",
        "position",
        "season_id",
        F.explode("statistics").alias("metric_key", "text"),
    ).filter(is_scalar(F.col("text")))
    return with_metric_name(stats).select(
        "match_id",
        "player_id",
        "team_id",
        "position",
        "metric_key",
        "metric_name",
        stat_value(F.col("text")).alias("value"),
        "season_id",
    )
