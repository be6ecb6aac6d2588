"""Every operator as a query over the bound test tables, whole and unfiltered.

Each takes (spark, folder of tables) and returns a DataFrame whose doubles are rounded to six
places (after ten, which removes what summing in another order adds), so that another engine gives
the same values.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from matchstats.functions.labels import with_metric_name
from matchstats.functions.metrics import apply_calc_mode, with_ratios
from matchstats.functions.values import day_text, match_date, match_title, percent_value
from matchstats.operators import context as X
from matchstats.operators.compare import compare, with_without, with_without_split
from matchstats.operators.entities import context_entities, players_to_choose
from matchstats.operators.facts import club_match_rows, club_player_rows, club_rows, player_rows
from matchstats.operators.games import club_games, game_sources, last_games, match_records, player_games
from matchstats.operators.leaderboards import (
    UNKNOWN_CLUB,
    club_leaderboard,
    club_lists,
    club_names,
    club_totals,
    player_leaderboard,
    player_totals,
)
from matchstats.operators.streaks import streaks
from matchstats.plans.ingest import ingest, reprocess
from matchstats.registry import CATEGORIES, club_sources, player_sources
from matchstats.schema import MINUTES
from matchstats.session import scratch_folder, tune
from matchstats.sources import landed, storage
from matchstats.sources import landing as L
from matchstats.sources import orders_binding as B
from matchstats.sources.landed import quarantine
from matchstats.sources.sinks import (
    append_facts,
    as_table,
    loaded_near,
    not_loaded,
    replace_by_match,
    upsert,
    write_dimension,
)
from matchstats.sources.tables import (
    StatsTables,
    dimension_columns,
    keep_first,
    read_table,
    unique_dimension,
)
from matchstats.streaming.ingest import stream_ingest

Query = Callable[[SparkSession, str], DataFrame]

PLAYER_A, PLAYER_B, SHARED_PLAYER = 101, 302, 9010
CLUB_A, CLUB_B = 1, 24
COMPETITIONS, SEASONS = ["AMERICA", "ASIA", "EUROPE"], ["1996", "1997"]

_REGISTERED: dict[str, Query] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Doubles to six places, integers to long, times to text."""

    def column(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            value = F.round(F.round(value, 10), 6) + F.lit(0.0)
        elif isinstance(field.dataType, T.IntegerType):
            value = value.cast("long")
        elif isinstance(field.dataType, T.TimestampNTZType):
            value = value.cast("string")
        elif isinstance(field.dataType, T.DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        return value.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def _tuned(spark: SparkSession, sf_dir: str) -> SparkSession:
    return tune(spark, B.bound_bytes(spark, sf_dir))


def query(name: str):
    """Register a function of the bound tables under a name."""

    def register(build: Callable[[StatsTables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(build(B.bind(_tuned(spark, sf_dir), sf_dir)))

        _REGISTERED[name] = run
        return build

    return register


def query_on_files(name: str):
    """Register a function of (spark, folder), for queries that need more than the tables."""

    def register(build: Query):
        _REGISTERED[name] = lambda spark, sf_dir: tidy(build(_tuned(spark, sf_dir), sf_dir))
        return build

    return register


def registered() -> dict[str, Query]:
    return dict(_REGISTERED)


# Scans, sources and sinks


@query("scan_dimensions")
def _(t: StatsTables) -> DataFrame:
    scans = dimension_columns(t)
    key = {"tournaments": "unique_tournament_id", "matches": "match_id", "clubs": "team_id"}
    parts = []
    for name, df in scans.items():
        label = "home_team_name" if name == "matches" else "name"
        second = {"tournaments": "season_id", "players": "team_id"}.get(name)
        parts.append(
            df.select(
                F.lit(name).alias("dimension"),
                F.col(key.get(name, "player_id")).cast("long").alias("id"),
                (F.col(second) if second else F.lit(-1)).cast("long").alias("second_id"),
                F.col(label).alias("name"),
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query("scan_player_facts")
def _(t: StatsTables) -> DataFrame:
    return player_rows(t, X.finished(t.matches), ["goals", "expectedGoals"])


@query_on_files("scan_spatial")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of shots, actions and average positions, as they are stored."""
    root = scratch_folder(spark, "spatial")
    lines = B.bound_lines(spark, sf_dir, B.bound_matches(spark, sf_dir))
    given = lines.select(
        (F.col("match_id") * 10 + F.col("ln")).alias("id"), "match_id", "player_id",
        (F.col("side") == "home").alias("is_home_team"), F.col("disc").alias("x_coord"),
        F.col("disc").alias("x_start"), F.col("disc").alias("avg_x"), F.col("ln").alias("time_min"),
    )
    parts = []
    for name, place in (
        ("match_shots", "x_coord"), ("match_spatial_actions", "x_start"), ("match_average_positions", "avg_x"),
    ):
        as_table(given, name).write.parquet(f"{root}/{name}")
        stored = read_table(spark, root, name)
        parts.append(stored.select(F.lit(name).alias("table_name"), "id", "match_id", "player_id", F.col(place).alias("x")))
    return parts[0].union(parts[1]).union(parts[2])


def _parsed(payloads: DataFrame, kind: str) -> DataFrame:
    return L.parse_payloads(payloads, kind)


@query("ingest_rounds")
def _(t: StatsTables) -> DataFrame:
    payloads = _parsed(B.rounds_payloads(t.matches, t.tournaments), "rounds")
    return L.flatten_rounds(payloads, t.matches.select("tournament_id", "season_id").distinct())


def _events(t: StatsTables) -> DataFrame:
    return L.flatten_events(_parsed(B.event_payloads(t.matches, t.tournaments), "events"))


@query("ingest_matches")
def _(t: StatsTables) -> DataFrame:
    return L.event_matches(_events(t)).drop("home_score", "away_score", "round_slug")


@query("ingest_clubs")
def _(t: StatsTables) -> DataFrame:
    return L.event_clubs(_events(t)).select("team_id", "name", "disabled", "national")


@query("ingest_tournaments")
def _(t: StatsTables) -> DataFrame:
    return L.event_tournaments(_events(t)).select(
        "unique_tournament_id", "season_id", "name", "season_year"
    )


@query("ingest_match_stats")
def _(t: StatsTables) -> DataFrame:
    return L.flatten_match_stats(_parsed(B.statistics_payloads(t.match_stats), "statistics"))


@query_on_files("ingest_player_stats")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = B.bound_matches(spark, sf_dir)
    payloads = B.lineup_payloads(B.bound_lines(spark, sf_dir, matches))
    listed = L.flatten_lineups(L.with_match(_parsed(payloads, "lineups"), matches))
    return (
        L.lineup_stats(listed)
        .groupBy("player_id", "team_id", "position", "metric_key", "metric_name")
        .agg(F.count("*").alias("rows"), F.sum("value").alias("total"))
    )


@query_on_files("ingest_players")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = B.bound_matches(spark, sf_dir)
    payloads = B.lineup_payloads(B.bound_lines(spark, sf_dir, matches))
    listed = L.flatten_lineups(L.with_match(_parsed(payloads, "lineups"), matches))
    return L.lineup_players(listed).select(
        "player_id", "team_id", "name", "market_value", "last_updated_match_id"
    )


@query_on_files("upsert_last_wins")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = B.bound_matches(spark, sf_dir)
    old = matches.select("match_id", "status_code", "round_id")
    new = B.bound_lines(spark, sf_dir, matches).filter("rf = 'R'").select(
        "match_id", (F.col("ln") + 200).alias("status_code"), F.lit(0).alias("round_id")
    )
    return upsert(old, new, ["match_id"], [F.desc("status_code")])


@query("append_facts")
def _(t: StatsTables) -> DataFrame:
    spark = t.matches.sparkSession
    root = scratch_folder(spark, "append")
    rows = t.match_stats.join(t.matches.select("match_id", "season_id"), "match_id")
    append_facts(rows.filter("period = 'ALL'"), root, "match_stats_log")
    append_facts(rows.filter("period <> 'ALL'"), root, "match_stats_log")
    return read_table(spark, root, "match_stats_log").drop("metric_name")


@query("replace_by_match")
def _(t: StatsTables) -> DataFrame:
    fetched = t.matches.filter(F.col("status_code") == 60)
    new = t.match_stats.join(fetched.select("match_id"), "match_id", "left_semi").withColumn(
        "home_value", F.col("home_value") + 1
    )
    return replace_by_match(t.match_stats, new, fetched)


#: Stored bytes of the bound tables whose facts are appended by one job: its shuffle files are some twenty times that.
_PIECE_BYTES = 40 << 20


@query_on_files("reprocess_team_attribution")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player facts with the club of the player's latest match, put right by the job."""
    root = scratch_folder(spark, "reprocess")
    t = B.land(spark, sf_dir, f"{root}/landing")
    write_dimension(t.matches, f"{root}/tables", "matches")
    current = t.players.groupBy("player_id").agg(F.max("team_id").alias("current_team_id"))
    current = storage.held(current, f"{root}/tables", "current")
    wrong = t.player_stats.join(current, "player_id").select(
        "match_id", "player_id", F.col("current_team_id").alias("team_id"), "metric_key", "value"
    )
    seasons = t.matches.select("match_id", "season_id")
    pieces = max(1, B.bound_bytes(spark, sf_dir) // _PIECE_BYTES)
    buckets = max(storage.BUCKETS, pieces)
    for piece in range(pieces):
        # of both, so that each is cut before they are shuffled
        own = storage.bucket_of("match_id", buckets) % pieces == piece
        rows = wrong.filter(own).join(seasons.filter(own), "match_id")
        append_facts(rows, f"{root}/tables", "player_stats_log", buckets)
    storage.let_go(spark, f"{root}/tables", "current")
    reprocess(spark, f"{root}/landing", f"{root}/tables")
    repaired = read_table(spark, f"{root}/tables", "player_stats_log")
    return repaired.groupBy("player_id", "team_id", "metric_key").agg(
        F.count("*").alias("rows"), F.sum("value").alias("total")
    )


@query("incremental_new_matches")
def _(t: StatsTables) -> DataFrame:
    loaded = t.match_stats.join(
        t.matches.filter(F.year("match_date") < 2000).select("match_id"), "match_id", "left_semi"
    )
    return not_loaded(X.finished(t.matches), loaded).select("match_id", "season_id")


def _loaded_player_facts(spark: SparkSession, warehouse: str) -> DataFrame:
    facts = read_table(spark, warehouse, "player_stats_log")
    return facts.groupBy("match_id", "season_id", "team_id", "player_id", "metric_key").agg(
        F.count("*").alias("rows"), F.sum("value").alias("total")
    )


def _loaded_match_facts(spark: SparkSession, warehouse: str) -> DataFrame:
    return read_table(spark, warehouse, "match_stats_log").drop("metric_name")


def _loaded_dimensions(spark: SparkSession, warehouse: str) -> DataFrame:
    """All columns of the four dimensions, as text, but the match a player was last read from: that
    depends on which file landed last."""
    parts = []
    for name in ("tournaments", "clubs", "matches", "players"):
        df = read_table(spark, warehouse, name).drop("last_updated_match_id")
        values = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in df.columns]
        parts.append(df.select(F.lit(name).alias("dimension"), F.concat_ws("|", *values).alias("row")))
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_folder(spark, "ingest")
    B.land(spark, sf_dir, f"{root}/landing")
    ingest(spark, f"{root}/landing", f"{root}/tables")
    return f"{root}/tables"


def _streamed(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_folder(spark, "stream")
    B.land(spark, sf_dir, f"{root}/landing")
    stream_ingest(spark, f"{root}/landing", f"{root}/tables", f"{root}/checkpoint").awaitTermination()
    return f"{root}/tables"


for _way, _load in (("ingest_job", _ingested), ("stream_ingest", _streamed)):
    for _suffix, _content in (
        ("", _loaded_player_facts), ("_match_facts", _loaded_match_facts), ("_dimensions", _loaded_dimensions),
    ):
        query_on_files(f"{_way}{_suffix}")(
            lambda spark, sf_dir, load=_load, content=_content: content(spark, load(spark, sf_dir))
        )


@query_on_files("ingest_quarantine")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineups cut short go to the quarantine whole, with all others loaded."""
    root = scratch_folder(spark, "quarantine")
    match_id = F.regexp_extract("body", r'"match_id":(\d+)', 1).cast("long")
    B.land(spark, sf_dir, f"{root}/landing", match_id % 10 == 3)
    ingest(spark, f"{root}/landing", f"{root}/tables")
    lost = quarantine(spark, f"{root}/tables").select(
        F.col("kind").alias("state"), F.regexp_extract("line", r'"match_id":(\d+)', 1).cast("long").alias("match_id")
    )
    loaded = read_table(spark, f"{root}/tables", "player_stats_log")
    return lost.union(loaded.select(F.lit("loaded"), "match_id").distinct())


@query_on_files("ingest_ledger")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load knows of matches without reading facts or payloads: which are loaded, and which
    deliveries wait for their match.  Events land last, and the loads are compacted."""
    root = scratch_folder(spark, "ledger")
    B.land(spark, sf_dir, f"{root}/landing")
    for kinds in (("lineups", "statistics"), ("events",)):
        for kind in kinds:
            storage.move(spark, f"{root}/landing/{kind}", f"{root}/come/{kind}")
        ingest(spark, f"{root}/come", f"{root}/tables")
    landed.compact(spark, f"{root}/tables")
    waits = landed.state(spark, f"{root}/tables").waiting.select(F.col("kind").alias("state"), "match_id")
    loaded = loaded_near(read_table(spark, f"{root}/tables", "matches"), f"{root}/tables")
    return waits.union(loaded.select(F.lit("loaded"), "match_id"))


# Context


@query("ctx_competition_season")
def _(t: StatsTables) -> DataFrame:
    ctx = X.in_competition_season(t.matches, t.tournaments, COMPETITIONS, SEASONS)
    return ctx.select("match_id", "tournament_id", "season_id")


@query("ctx_competition_only")
def _(t: StatsTables) -> DataFrame:
    return X.select_matches(t, competitions=COMPETITIONS).select("match_id", "tournament_id")


@query("ctx_season_only")
def _(t: StatsTables) -> DataFrame:
    return X.select_matches(t, seasons=SEASONS, teams=[]).select("match_id", "season_id")


@query("ctx_until_date")
def _(t: StatsTables) -> DataFrame:
    return X.select_matches(t, end=date(1996, 2, 10), competitions=[]).select("match_id", "match_date")


@query("ctx_seasons")
def _(t: StatsTables) -> DataFrame:
    return X.available_seasons(t.tournaments, COMPETITIONS)


@query("ctx_default_season")
def _(t: StatsTables) -> DataFrame:
    return X.default_season(t.tournaments, COMPETITIONS)


@query("ctx_competitions")
def _(t: StatsTables) -> DataFrame:
    return X.competitions_in(t.matches, t.tournaments)


@query("ctx_bounds")
def _(t: StatsTables) -> DataFrame:
    return X.bounds(t.matches)


@query("ctx_date_range")
def _(t: StatsTables) -> DataFrame:
    ctx = X.in_date_range(t.matches, date(1996, 2, 10), date(1998, 7, 31))
    return ctx.select("match_id", "match_date")


@query("ctx_round_phases")
def _(t: StatsTables) -> DataFrame:
    return X.round_phases(t.matches)


@query("ctx_round_names")
def _(t: StatsTables) -> DataFrame:
    return X.round_names(t.matches)


@query("ctx_round_filter")
def _(t: StatsTables) -> DataFrame:
    choices = {
        "both": X.round_condition((2, 5), [27]),
        "range": X.round_condition((2, 5)),
        "extra": X.round_condition(None, [26, 27]),
        "none": X.round_condition(None),
    }
    kept = [F.when(chosen, F.lit(name)) for name, chosen in choices.items()]
    return t.matches.select(
        "match_id", "round_id", F.array_join(F.array_compact(F.array(*kept)), ",").alias("kept_by")
    )


@query("ctx_club_filter")
def _(t: StatsTables) -> DataFrame:
    return X.with_club(t.matches, [CLUB_A, CLUB_B]).select("match_id", "home_team_id", "away_team_id")


@query("ctx_clubs")
def _(t: StatsTables) -> DataFrame:
    return X.clubs_in(t.matches, t.clubs)


@query("ctx_players")
def _(t: StatsTables) -> DataFrame:
    listed = X.players_of(t.players, [CLUB_A, 3]).select("player_id", "team_id", "name")
    ids = X.player_ids_named(t.players, [f"PLAYER_{PLAYER_A}", f"PLAYER_{SHARED_PLAYER}"])
    return listed.join(ids.withColumn("named", F.lit(True)), "player_id", "left").withColumn(
        "named", F.coalesce("named", F.lit(False))
    )


@query("ctx_all_filters")
def _(t: StatsTables) -> DataFrame:
    return X.select_matches(
        t, COMPETITIONS, SEASONS, date(1996, 2, 10), date(1997, 11, 30),
        X.round_condition((1, 10), [26]), [CLUB_A, 7, CLUB_B],
    ).select("match_id")


@query("finished_matches")
def _(t: StatsTables) -> DataFrame:
    return X.finished(t.matches).select("match_id", "status_code")


# Joins and facts


@query("filter_position")
def _(t: StatsTables) -> DataFrame:
    board = player_leaderboard(t, t.matches, "finishing", positions=["G", "F"])
    return board.select("player_id", "position", "games", "goals")


@query("venue_semi_join")
def _(t: StatsTables) -> DataFrame:
    return player_rows(t, t.matches, [MINUTES], venue="home")


@query("venue_club_home")
def _(t: StatsTables) -> DataFrame:
    return club_leaderboard(t, t.matches, "passing", perspective="against", venue="home").select(
        "team_id", "games", "totalPass", "accuratePass", "pass_accuracy_pct"
    )


@query("join_fact_match")
def _(t: StatsTables) -> DataFrame:
    return player_rows(t, t.matches, [MINUTES], carry=["season_id", "home_team_id", "away_team_id"])


@query("join_match_competition")
def _(t: StatsTables) -> DataFrame:
    return X.with_competition(t.matches, t.tournaments).select("match_id", "competition", "season")


@query("join_club_name")
def _(t: StatsTables) -> DataFrame:
    rows = player_rows(t, t.matches, [MINUTES]).groupBy("team_id").agg(F.count("*").alias("rows"))
    return rows.join(club_names(t.clubs), "team_id", "left").withColumn(
        "club", F.coalesce("club", F.lit(UNKNOWN_CLUB))
    )


@query("with_without_split")
def _(t: StatsTables) -> DataFrame:
    return with_without_split(t, t.matches, SHARED_PLAYER, 3).select("match_id", "played")


@query("context_entities")
def _(t: StatsTables) -> DataFrame:
    return context_entities(t, t.matches)


@query("players_to_choose")
def _(t: StatsTables) -> DataFrame:
    return players_to_choose(context_entities(t, t.matches), COMPETITIONS, SEASONS, [CLUB_A, 3, 7])


# Aggregations


@query("player_games_minutes")
def _(t: StatsTables) -> DataFrame:
    return player_totals(t, t.matches, player_sources("finishing")).select(
        "player_id", "games", "minutes"
    )


@query("player_metric_totals")
def _(t: StatsTables) -> DataFrame:
    keys = [s.key for s in player_sources("duels")]
    return (
        player_rows(t, t.matches, keys)
        .groupBy("player_id", "metric_key")
        .agg(F.sum("value").alias("value"))
    )


@query("club_games_minutes")
def _(t: StatsTables) -> DataFrame:
    return club_totals(t, t.matches, club_sources("finishing", True)).select(
        "team_id", "games", "minutes"
    )


def _club_metric_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("team_id", "metric_key").agg(F.sum("value").alias("value"))


@query("club_player_stats_for")
def _(t: StatsTables) -> DataFrame:
    return _club_metric_totals(club_player_rows(t, t.matches, ["goals", "totalShots"]))


@query("club_player_stats_against")
def _(t: StatsTables) -> DataFrame:
    return _club_metric_totals(club_player_rows(t, t.matches, ["goals", "totalShots"], "against"))


@query("club_match_stats_for")
def _(t: StatsTables) -> DataFrame:
    return _club_metric_totals(club_match_rows(t, t.matches, ["passes", "shotsOnGoal"]))


@query("club_match_stats_against")
def _(t: StatsTables) -> DataFrame:
    return _club_metric_totals(club_match_rows(t, t.matches, ["passes", "shotsOnGoal"], "against"))


@query("club_metrics_union")
def _(t: StatsTables) -> DataFrame:
    rows = club_rows(t, t.matches, club_sources("finishing", True))
    return rows.groupBy("team_id", "source", "metric_key").agg(
        F.count("*").alias("rows"), F.sum("value").alias("value")
    )


@query("player_club_list")
def _(t: StatsTables) -> DataFrame:
    return club_lists(t, t.matches)


@query("pivot_player_category")
def _(t: StatsTables) -> DataFrame:
    sources = player_sources("passing")
    return player_totals(t, t.matches, sources).drop("games", "minutes")


@query("game_totals_player")
def _(t: StatsTables) -> DataFrame:
    sources = game_sources("player", "duels")
    games = player_games(t, X.describable(t.matches, t.tournaments), sources)
    return games.select("player_id", "team_id", "match_id", "duelWon", "duelLost", MINUTES)


@query("game_totals_club")
def _(t: StatsTables) -> DataFrame:
    sources = game_sources("club", "passing", prefer_match=True)
    games = club_games(t, X.describable(t.matches, t.tournaments), sources)
    return games.select("team_id", "match_id", "totalPass", "accuratePass")


@query("ratio_metrics_player")
def _(t: StatsTables) -> DataFrame:
    sources = player_sources("passing")
    totals = player_totals(t, t.matches, sources, venue="away")
    wide = with_ratios(totals, "passing", [s.metric for s in sources])
    return wide.select("player_id", "totalPass", "accuratePass", "pass_accuracy_pct", "cross_pct")


@query("ratio_duels")
def _(t: StatsTables) -> DataFrame:
    sources = player_sources("duels")
    wide = with_ratios(
        player_totals(t, t.matches, sources), "duels", [s.metric for s in sources]
    )
    return wide.select("player_id", "duelWon", "duelLost", "duel_won_pct", "aerial_won_pct")


@query("calc_modes")
def _(t: StatsTables) -> DataFrame:
    totals = player_totals(t, t.matches, player_sources("finishing"))
    parts = [
        apply_calc_mode(totals, ["goals", "totalShots"], mode).select(
            F.lit(mode).alias("mode"), "player_id", "goals", "totalShots"
        )
        for mode in ("total", "per_game", "per_90")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("dedup_dimensions")
def _(t: StatsTables) -> DataFrame:
    return unique_dimension(t.players.select("player_id", "team_id", "name"), ["player_id"])


@query("dedup_first_seen")
def _(t: StatsTables) -> DataFrame:
    appearances = player_rows(t, t.matches, [MINUTES], carry=["match_date"])
    first = keep_first(appearances, ["player_id", "team_id"], ["match_date", "match_id"])
    return first.select("player_id", "team_id", "match_id")


# Scalar functions


@query("match_title")
def _(t: StatsTables) -> DataFrame:
    known = F.when(F.col("status_code") != 60, F.col("away_team_name"))
    return t.matches.select(
        "match_id",
        match_title(F.col("home_team_name"), known).alias("title"),
        day_text(F.col("match_date")).alias("day"),
    )


@query("normalize_match_date")
def _(t: StatsTables) -> DataFrame:
    seconds = B.epoch_seconds().cast("string")
    day = F.date_format("match_date", "yyyy-MM-dd")
    text = (
        F.when(F.col("status_code") == 100, seconds)
        .when(F.col("round_id") == 27, "unknown")
        .when(F.col("round_id") == 26, F.concat(day, F.lit("T23:30:00-03:00")))
        .otherwise(day)
    )
    return t.matches.select("match_id", match_date(text).alias("match_date"))


@query_on_files("parse_percent_values")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = B.bound_lines(spark, sf_dir, B.bound_matches(spark, sf_dir))
    percent = F.concat(F.col("q").cast("int").cast("string"), F.lit("%"))
    text = (
        F.when(F.col("rf") == "R", percent)
        .when(F.col("rf") == "A", F.concat(F.col("ln").cast("string"), F.lit("/7")))
        .when(F.col("ln") == 1, F.concat(F.lit("1/7 ("), percent, F.lit(")")))
        .when(F.col("ln") > 2, F.col("q").cast("string"))
    )
    return lines.select(
        "match_id", F.col("ln").alias("line"), percent_value(text).alias("value")
    )


@query("metric_label_from_key")
def _(t: StatsTables) -> DataFrame:
    keys = t.player_stats.select("metric_key").union(t.match_stats.select("metric_key")).distinct()
    endings = F.array(F.lit(""), F.lit("OnTargetX"), F.lit("2ndHalf"))
    variants = keys.select("metric_key", F.explode(endings).alias("ending"))
    return with_metric_name(variants.select(F.concat("metric_key", "ending").alias("metric_key")))


# Leaderboards


def _player_board(name: str, category: str, **options) -> None:
    query(name)(lambda t: player_leaderboard(t, t.matches, category, **options))


def _club_board(name: str, category: str, **options) -> None:
    query(name)(lambda t: club_leaderboard(t, t.matches, category, **options))


PLAYER_BOARDS = {
    "leaderboard_player_total": ("finishing", {}),
    "leaderboard_player_cumulative": ("passing", {}),
    "leaderboard_player_by_competition_season": (
        "finishing", {"group_mode": "by_competition_season"},
    ),
    "leaderboard_player_by_season": ("duels", {"group_mode": "by_season", "venue": "home"}),
    "leaderboard_player_by_competition": ("passing", {"group_mode": "by_competition"}),
    "leaderboard_player_per_game": ("finishing", {"calc_mode": "per_game"}),
    "leaderboard_player_per_90": ("finishing", {"calc_mode": "per_90", "venue": "away"}),
    "leaderboard_player_min_games": ("duels", {"min_games": 20, "min_minutes": 1500}),
    "leaderboard_player_of_clubs": (
        "finishing", {"teams": [CLUB_A, CLUB_B], "positions": ["D", "F"]},
    ),
}
CLUB_BOARDS = {
    "leaderboard_club_total": ("finishing", {}),
    "leaderboard_club_cumulative": ("passing", {"perspective": "against"}),
    "leaderboard_club_by_competition_season": (
        "finishing", {"group_mode": "by_competition_season", "perspective": "against"},
    ),
    "leaderboard_club_by_season": ("passing", {"group_mode": "by_season", "venue": "away"}),
    "leaderboard_club_by_competition": ("duels", {"group_mode": "by_competition"}),
    "leaderboard_club_per_game": ("finishing", {"calc_mode": "per_game"}),
    "leaderboard_club_per_90": (
        "finishing", {"calc_mode": "per_90", "perspective": "against", "venue": "home"},
    ),
    "club_first_half": ("passing", {"period": "1ST"}),
    "club_second_half_against": (
        "finishing", {"period": "2ND", "perspective": "against", "teams": [CLUB_A, CLUB_B]},
    ),
}
for _name, (_category, _options) in PLAYER_BOARDS.items():
    _player_board(_name, _category, **_options)
for _name, (_category, _options) in CLUB_BOARDS.items():
    _club_board(_name, _category, **_options)


# Single games


RECORDS = {
    "records_player": ("player", "finishing", "totalShots", {}),
    "records_player_lowest": ("player", "passing", "totalPass", {"order": "lowest"}),
    "records_player_home": ("player", "finishing", "expectedGoals", {"venue": "home"}),
    "records_player_ratio": ("player", "passing", "pass_accuracy_pct", {}),
    "records_club": ("club", "finishing", "goals", {}),
    "records_club_against": ("club", "duels", "duelWon", {"perspective": "against", "venue": "away"}),
}
LAST_GAMES = {
    "last_n_player": ("player", "finishing", 10, {}),
    "last_n_club": ("club", "passing", 10, {}),
    "last_n_club_against": ("club", "finishing", 5, {"perspective": "against", "venue": "home"}),
}
STREAKS = {
    "streaks_player": ("player", "finishing", "goals", ">=", 1.0, None),
    "streaks_club": ("club", "finishing", "goals", ">=", 2.0, None),
    "streaks_top100": ("player", "passing", "totalPass", ">=", 20.0, 100),
    "streak_condition_ge": ("player", "duels", "duelWon", ">=", 3.0, None),
    "streak_condition_gt": ("player", "duels", "duelWon", ">", 3.0, None),
    "streak_condition_le": ("club", "duels", "duelLost", "<=", 9.0, None),
    "streak_condition_lt": ("player", "duels", "duelLost", "<", 4.0, None),
    "streak_condition_eq": ("player", "finishing", "goals", "=", 0.0, None),
}


def _records(name: str, target: str, category: str, metric: str, **options) -> None:
    query(name)(lambda t: match_records(target, t, t.matches, category, metric, **options))


def _last(name: str, target: str, category: str, n: int, **options) -> None:
    query(name)(lambda t: last_games(target, t, t.matches, category, n, **options))


def _streaks(name: str, target, category, metric, operator, threshold, limit) -> None:
    query(name)(
        lambda t: streaks(target, t, t.matches, category, metric, operator, threshold, limit=limit)
    )


for _name, (*_arguments, _options) in RECORDS.items():
    _records(_name, *_arguments, **_options)
for _name, (*_arguments, _options) in LAST_GAMES.items():
    _last(_name, *_arguments, **_options)
for _name, _arguments in STREAKS.items():
    _streaks(_name, *_arguments)


# The order of sorted results: the row's key, and its place as it comes.  The last entry is the order
# stated for the result, which only the SQL uses.
RANKED = {
    "ranked_leaderboard_player": ("leaderboard_player_total", ["player_id"], f"{CATEGORIES['finishing'][0]} DESC, player_id"),
    "ranked_leaderboard_club": ("leaderboard_club_total", ["team_id"], f"{CATEGORIES['finishing'][0]} DESC, team_id"),
    "ranked_records": ("records_player", ["player_id", "team_id", "match_id"], "totalShots DESC, match_id, player_id, team_id"),
    "ranked_records_lowest": ("records_player_lowest", ["player_id", "team_id", "match_id"], "totalPass, match_id, player_id, team_id"),
    "ranked_last_games": (
        "last_n_player", ["player_id", "team_id", "match_id"], "match_date DESC, match_id DESC, team_id DESC, player_id",
    ),
    "ranked_streaks": ("streaks_top100", ["player_id"], "active_streak DESC, success_pct DESC, player_id"),
}


def in_order(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of a result and the place of each row in it."""
    placed = df.withColumn("_at", F.monotonically_increasing_id())
    return placed.select(*keys, F.row_number().over(Window.orderBy("_at")).cast("long").alias("rank"))


def _ranked(name: str, base: str, keys: list[str]) -> None:
    _REGISTERED[name] = lambda spark, sf_dir: in_order(_REGISTERED[base](spark, sf_dir), keys)


for _name, (_base, _keys, _) in RANKED.items():
    _ranked(_name, _base, _keys)


# Comparison


COMPARISONS = {
    "compare_players": ("player", PLAYER_A, SHARED_PLAYER, "duels", "per_game", "for", {}),
    "compare_players_by_season": (
        "player", PLAYER_A, PLAYER_A, "finishing", "total", "for",
        {"a_seasons": ["1996"], "b_seasons": ["1997", "1998"], "b_competitions": COMPETITIONS},
    ),
    "compare_clubs": ("club", CLUB_A, CLUB_B, "passing", "per_90", "against", {}),
}
IMPACTS = {
    "with_without_player": (SHARED_PLAYER, 3, "finishing", "per_game", "for", {}),
    "with_without_player_against": (
        PLAYER_A, CLUB_A, "passing", "total", "against", {"seasons": SEASONS},
    ),
}


def _compare(name: str, target, a, b, category, calc_mode, perspective, options) -> None:
    query(name)(
        lambda t: compare(target, t, t.matches, a, b, category, calc_mode, perspective, **options)
    )


def _impact(name: str, player, team, category, calc_mode, perspective, options) -> None:
    query(name)(
        lambda t: with_without(t, t.matches, player, team, category, calc_mode, perspective, **options)
    )


for _name, _arguments in COMPARISONS.items():
    _compare(_name, *_arguments)
for _name, _arguments in IMPACTS.items():
    _impact(_name, *_arguments)
