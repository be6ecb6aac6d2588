"""The bound tables: counts, equality with the SQL text, invariants and plans."""

import re

import oracle_check
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from matchstats import open_tables
from matchstats.operators.compare import with_without
from matchstats.operators.context import describable, in_competition_season
from matchstats.operators.facts import club_match_rows
from matchstats.operators.games import last_games, match_records
from matchstats.operators.leaderboards import player_leaderboard
from matchstats.operators.streaks import streaks
from matchstats.plans.oracle import VIEWS, registered_sql
from matchstats.plans.queries import registered
from matchstats.sources.orders_binding import bind
from matchstats.sources.sinks import append_facts, as_table
from matchstats.sources.storage import write_version

SF = "/root/testdata/sf0.001"
COUNTS = {
    "matches": 1500, "clubs": 24, "tournaments": 35, "players": 245,
    "player_stats": 49678, "match_stats": 12171,
}


@pytest.fixture(scope="module")
def t(spark):
    return bind(spark, SF)


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SF)


def test_counts(t):
    assert {name: getattr(t, name).count() for name in COUNTS} == COUNTS


@pytest.mark.parametrize("name", ["matches", "clubs", "tournaments", "players", "player_stats", "match_stats"])
def test_binding_equals_its_sql(spark, t, name):
    for table in oracle_check.TABLES:
        spark.read.parquet(f"{SF}/{table}.parquet").createOrReplaceTempView(table)
    for view, text in VIEWS.items():
        spark.sql(text.replace("VARCHAR", "STRING")).createOrReplaceTempView(view)
    view = {"player_stats": "b_player_stats_log", "match_stats": "b_match_stats_log"}.get(name, f"b_{name}")
    want = spark.table(view)
    got = getattr(t, name).select(want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


QUERIES = sorted(registered())
WRITES = [n for n in QUERIES if n.startswith(("append_", "ingest_job", "stream_", "reprocess_", "ingest_quarantine", "scan_spatial"))]


def test_every_query_has_sql():
    assert set(registered()) == set(registered_sql())
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert oracle_check.difference(spark, con, name, SF) is None


@pytest.mark.parametrize("name", ["ctx_date_range", "last_n_club", "ingest_matches", "normalize_match_date", "streaks_player"])
def test_results_do_not_depend_on_the_session_zone(spark, con, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")  # skips midnights
    try:
        assert oracle_check.difference(spark, con, name, SF) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


# Invariants


def test_what_clubs_make_others_concede(t):
    total = {
        side: club_match_rows(t, t.matches, ["passes"], side).agg(F.sum("value")).first()[0]
        for side in ("for", "against")
    }
    assert total["for"] == total["against"]


def test_streaks_are_ordered(t):
    board = streaks("player", t, t.matches, "finishing", "goals", limit=None)
    wrong = board.filter(
        "active_streak > best_streak or best_streak > hits or hits > games or active_streak < 0"
    )
    assert wrong.isEmpty()


def test_with_and_without_make_all_games(t):
    row = with_without(t, t.matches, 9010, 3, "finishing").first()
    games = t.player_stats.filter("team_id = 3 and metric_key = 'minutesPlayed'")
    assert row.games_with + row.games_without == games.select("match_id").distinct().count()


def test_per_90_is_the_total_rescaled(t):
    total = player_leaderboard(t, t.matches, "finishing").select("player_id", "minutes", "goals")
    scaled = player_leaderboard(t, t.matches, "finishing", calc_mode="per_90").select(
        "player_id", F.col("goals").alias("scaled")
    )
    off = total.join(scaled, "player_id").filter(F.abs(F.col("scaled") * F.col("minutes") / 90 - F.col("goals")) > 1e-6)
    assert off.isEmpty()


# Plans


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in WRITES])
def test_no_python_evaluation(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "EvalPython" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_metric_filter_reaches_the_scan(spark, t, tmp_path):
    facts = str(tmp_path / "facts")
    t.player_stats.write.parquet(facts)
    stored = type(t)(**{**t.__dict__, "player_stats": spark.read.parquet(facts)})
    text = plan(player_leaderboard(stored, t.matches, "finishing"))
    scans = [line for line in text.splitlines() if "FileScan" in line and "metric_key" in line]
    assert scans and all(re.search(r"PushedFilters: \[[^]]*metric_key", line) for line in scans)
    assert not any("team_id" in line for line in scans if "value" in line)


def test_a_season_reads_its_partition_only(spark, t, tmp_path):
    root = str(tmp_path)
    seasons = t.matches.select("match_id", "season_id")
    append_facts(t.player_stats.join(seasons, "match_id"), root, "player_stats_log")
    write_version(as_table(t.tournaments, "tournaments"), f"{root}/tournaments")
    write_version(as_table(t.matches, "matches"), f"{root}/matches")
    stored = open_tables(spark, root)
    ctx = in_competition_season(stored.matches, stored.tournaments, ["ASIA"], ["1997"])
    text = plan(player_leaderboard(stored, ctx, "finishing"))
    assert "dynamicpruning" in text


def test_top_and_last_games_are_limited_early(t):
    assert "TakeOrderedAndProject" in plan(match_records("player", t, t.matches, "finishing", "goals"))
    assert "WindowGroupLimit" in plan(last_games("player", t, t.matches, "finishing", 10))
    assert "TakeOrderedAndProject" in plan(streaks("player", t, t.matches, "finishing", "goals"))


def test_names_do_not_travel_with_the_facts(t):
    assert set(describable(t.matches, t.tournaments).columns) == set(t.matches.columns)
