"""Landed JSON into tables: golden rows, repeated and incremental loads, streaming."""

import json
import os
import shutil
import time
from datetime import datetime, timedelta
from pathlib import Path
from types import SimpleNamespace

import pytest

from matchstats.operators.leaderboards import player_leaderboard
from matchstats.plans.ingest import ingest, reprocess
from matchstats.schema import TABLES
from matchstats.session import scratch_folder
from matchstats.sources import landed, storage
from matchstats.sources import landing as L
from matchstats.sources.sinks import append_facts, as_table
from matchstats.sources.storage import write_version
from matchstats.sources.tables import open_tables, read_table
from matchstats.streaming import waiting
from matchstats.streaming.ingest import load_batch, stream_ingest

TOURNAMENT = {"uniqueTournament": {"id": 9, "name": "Cup", "slug": "cup"}, "category": {"name": "World"}}
SEASON = {"id": 90, "name": "Cup 2025", "year": "2025"}


def team(team_id, name):
    return {"id": team_id, "name": name, "shortName": name[:3], "disabled": False, "national": True, "type": 0, "teamColors": {"primary": "#fff"}}


def event(match_id, status, home=1, away=2, name="Reds", season=SEASON):
    return {
        "id": match_id, "startTimestamp": 1741000000 + match_id, "tournament": TOURNAMENT, "season": season,
        "roundInfo": {"round": 1, "name": "Final", "slug": "final"}, "status": {"code": status},
        "homeTeam": team(home, name), "awayTeam": team(away, "Blues"),
        "homeScore": {"current": 2}, "awayScore": {"current": 1},
    }


def listed(player_id, name, **stats):
    return {
        "position": "F",
        "player": {"id": player_id, "name": name, "position": "F", "country": {"alpha3": "BRA"}, "proposedMarketValueRaw": {"value": 5}},
        "statistics": stats,
    }


def land(folder, kind, file, *payloads):
    path = folder / kind
    path.mkdir(parents=True, exist_ok=True)
    (path / f"{file}.json").write_text("\n".join(json.dumps(p) for p in payloads))


def statistics(match_id, *items, period="ALL"):
    return {"match_id": match_id, "statistics": [{"period": period, "groups": [{"statisticsItems": list(items)}]}]}


def lineups(match_id, home, away):
    return {"match_id": match_id, "home": {"players": home}, "away": {"players": away}}


ITEMS = [
    {"key": "passes", "homeValue": 55, "awayValue": "55%"},
    {"key": "fouls", "homeValue": "12/20", "awayValue": None},
    {"key": "odd", "homeValue": "12/20 (60%)", "awayValue": 3},
    {"key": "accurateCross", "homeValue": 4, "awayValue": 2, "homeTotal": 9},
    {"homeValue": 1, "awayValue": 1},
]


def land_first(folder):
    land(
        folder, "events", "a",
        {"tournament_id": 9, "season_id": 90, "events": [event(1, 100), event(2, 60), event(3, 110, 2, 1, "Blues")]},
        {"tournament_id": 9, "season_id": 90, "events": [event(4, 120)]},
    )
    land(folder, "statistics", "a", statistics(1, *ITEMS), statistics(2, ITEMS[0]), statistics(3, ITEMS[0]))
    land(
        folder, "lineups", "a",
        lineups(1, [listed(7, "Ana", goals=None, captain=True, rating={"x": 1}, minutesPlayed=90, expectedGoalsOnTargetX=7)], [listed(8, "Bea", minutesPlayed="80")]),
        lineups(2, [listed(7, "Ana", minutesPlayed=1)], []),
        lineups(3, [listed(7, "Ana", minutesPlayed=45)], [listed(9, "Cleo")]),
        lineups(4, [listed(7, "Ana", minutesPlayed=30)], []),
    )
    return folder


@pytest.fixture
def landing(tmp_path):
    return land_first(tmp_path / "landing")


@pytest.fixture(scope="session")
def loaded_once(spark, tmp_path_factory):
    """The first files, landed and loaded."""
    folder = tmp_path_factory.mktemp("loaded")
    land_first(folder / "landing")
    ingest(spark, str(folder / "landing"), str(folder / "tables"))
    return folder


@pytest.fixture
def loaded(loaded_once, tmp_path):
    """The same landing folder and a copy of the tables; files that a test lands go again."""
    first = {p for p in (loaded_once / "landing").rglob("*") if p.is_file()}
    shutil.copytree(loaded_once / "tables", tmp_path / "tables")
    yield loaded_once / "landing", str(tmp_path / "tables")
    for path in (loaded_once / "landing").rglob("*"):
        if path.is_file() and path not in first:
            path.unlink()


def content(spark, warehouse):
    """All rows, but for the match a player was last read from: a match without statistics is
    read again by every load."""
    return {
        name: sorted(map(repr, read_table(spark, warehouse, name).drop("last_updated_match_id").collect()))
        for name in ("tournaments", "clubs", "matches", "players", "match_stats_log", "player_stats_log")
    }


def facts(spark, warehouse, *columns):
    return sorted(tuple(r) for r in read_table(spark, warehouse, "player_stats_log").select(*columns).collect())


def test_first_load(spark, loaded):
    _, warehouse = loaded
    t = open_tables(spark, warehouse)
    assert [tuple(r) for r in t.tournaments.collect()] == [(9, "Cup", "cup", "World", 90, "Cup 2025", "2025")]
    assert sorted(r[0] for r in t.matches.select("match_id").collect()) == [1, 2, 3, 4]
    first = t.matches.filter("match_id = 1").first()
    assert (first.match_date, first.status_code, first.home_score, first.round_name) == (
        datetime(2025, 3, 3, 11, 6, 41), 100, 2, "Final",
    )
    clubs = {r.team_id: (r.name, r.disabled, r.national, r.type, r.primary_color) for r in t.clubs.collect()}
    assert clubs == {1: ("Reds", False, True, 0, "#fff"), 2: ("Blues", False, True, 0, "#fff")}

    got = sorted(
        (r.match_id, r.metric_key, r.metric_name, r.home_value, r.away_value) for r in t.match_stats.collect()
    )
    assert got == [
        (1, "accurateCross", "Cruzamentos Certos", 4.0, 2.0),
        (1, "accurateCrossTotal", "Cruzamentos Certos (Total)", 9.0, 0.0),
        (1, "fouls", "Cometeu Falta", 0.0, None),
        (1, "odd", "Odd", None, 3.0),
        (1, "passes", "Passes", 55.0, 55.0),
        (3, "passes", "Passes", 55.0, 55.0),
    ]
    assert facts(spark, warehouse, "match_id", "player_id", "team_id", "metric_key", "value", "season_id") == [
        (1, 7, 1, "captain", 1.0, 90),
        (1, 7, 1, "expectedGoalsOnTargetX", 7.0, 90),
        (1, 7, 1, "goals", 0.0, 90),
        (1, 7, 1, "minutesPlayed", 90.0, 90),
        (1, 8, 2, "minutesPlayed", 80.0, 90),
        (3, 7, 2, "minutesPlayed", 45.0, 90),
        (4, 7, 1, "minutesPlayed", 30.0, 90),
    ]
    label = t.player_stats.filter("metric_key = 'expectedGoalsOnTargetX'").first()
    assert label.metric_name == "Expected Goals On Target X"
    # One row per player and club, also for a player listed without statistics.
    assert sorted((r.player_id, r.team_id, r.name) for r in t.players.collect()) == [
        (7, 1, "Ana"), (7, 2, "Ana"), (8, 2, "Bea"), (9, 1, "Cleo"),
    ]


def test_loading_again_changes_nothing(spark, loaded):
    landing, warehouse = loaded
    before = content(spark, warehouse)
    ingest(spark, str(landing), warehouse)
    assert content(spark, warehouse) == before
    ingest(spark, str(landing), warehouse, force=True)
    assert content(spark, warehouse) == before


def test_loaded_matches_are_skipped_unless_forced(spark, loaded):
    landing, warehouse = loaded
    land(landing, "lineups", "b", lineups(1, [listed(7, "Ana", minutesPlayed=91)], []))
    ingest(spark, str(landing), warehouse)
    assert (1, "minutesPlayed", 90.0) in facts(spark, warehouse, "match_id", "metric_key", "value")
    ingest(spark, str(landing), warehouse, force=True)
    kept = facts(spark, warehouse, "match_id", "player_id", "metric_key", "value")
    assert [r for r in kept if r[0] == 1] == [(1, 7, "minutesPlayed", 91.0)]
    assert [r for r in kept if r[0] == 3] == [(3, 7, "minutesPlayed", 45.0)]


def test_second_load_updates_a_club(spark, loaded):
    landing, warehouse = loaded
    land(landing, "events", "b", {"tournament_id": 9, "season_id": 90, "events": [event(5, 100, name="Crimsons")]})
    ingest(spark, str(landing), warehouse)
    clubs = {r.team_id: r.name for r in read_table(spark, warehouse, "clubs").collect()}
    assert clubs[1] == "Crimsons" and len(clubs) == 2


def test_a_match_that_moves_to_another_season_leaves_no_rows_behind(spark, loaded):
    landing, warehouse = loaded
    land(landing, "events", "b", {"events": [event(4, 120, season={"id": 91, "year": "2026"})]})
    before = facts(spark, warehouse, "match_id", "metric_key", "value")
    ingest(spark, str(landing), warehouse)
    ingest(spark, str(landing), warehouse)
    assert [r for r in facts(spark, warehouse, "match_id", "season_id", "value") if r[0] == 4] == [(4, 91, 30.0)]
    assert facts(spark, warehouse, "match_id", "metric_key", "value") == before
    # A loaded match moves without being read again.
    land(landing, "events", "c", {"events": [event(1, 100, season={"id": 91, "year": "2026"})]})
    land(landing, "lineups", "c", lineups(1, [], []))
    ingest(spark, str(landing), warehouse)
    assert {r for r in facts(spark, warehouse, "match_id", "season_id")} == {(1, 91), (3, 90), (4, 91)}
    assert facts(spark, warehouse, "match_id", "metric_key", "value") == before


def test_a_season_that_loses_its_only_match_is_empty(spark, landing, tmp_path):
    warehouse = str(tmp_path / "tables")
    land(landing, "events", "b", {"events": [event(6, 100, season={"id": 95, "year": "2030"})]})
    land(landing, "lineups", "b", lineups(6, [listed(7, "Ana", minutesPlayed=20)], []))
    ingest(spark, str(landing), warehouse)
    ingest(spark, str(landing), warehouse)
    assert [r for r in facts(spark, warehouse, "match_id", "season_id") if r[0] == 6] == [(6, 95)]
    land(landing, "events", "c", {"events": [event(6, 100, season={"id": 96, "year": "2031"})]})
    ingest(spark, str(landing), warehouse, force=True)
    assert [r for r in facts(spark, warehouse, "match_id", "season_id") if r[0] == 6] == [(6, 96)]
    assert read_table(spark, warehouse, "player_stats_log").filter("match_id is null").isEmpty()


def test_a_match_without_a_season_is_found(spark, landing, tmp_path):
    warehouse = str(tmp_path / "tables")
    land(landing, "events", "b", {"events": [event(6, 100, season={})]})
    land(landing, "lineups", "b", lineups(6, [listed(7, "Ana", minutesPlayed=20, goals=3)], []))
    ingest(spark, str(landing), warehouse)
    ingest(spark, str(landing), warehouse)
    t = open_tables(spark, warehouse)
    only = t.matches.filter("match_id = 6")
    assert only.first().season_id is None
    board = player_leaderboard(t, only, "finishing").first()
    assert (board.player_id, board.games, board.goals) == (7, 1, 3.0)
    assert player_leaderboard(t, only, "finishing", "by_season").isEmpty()


def files_of(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("part-*")}


def test_a_load_that_breaks_off_before_publishing_changes_nothing(spark, loaded, monkeypatch):
    landing, warehouse = loaded
    before = content(spark, warehouse)
    land(landing, "lineups", "b", lineups(1, [listed(7, "Ana", minutesPlayed=91)], []))
    land(landing, "statistics", "b", statistics(1, ITEMS[0]))
    whole = storage.write_version

    def broken(df, folder):
        if folder.endswith(storage.CURRENT):
            raise RuntimeError("lost")
        return whole(df, folder)

    monkeypatch.setattr(storage, "write_version", broken)
    with pytest.raises(RuntimeError):
        ingest(spark, str(landing), warehouse, force=True)
    assert content(spark, warehouse) == before
    monkeypatch.undo()
    ingest(spark, str(landing), warehouse, force=True)
    assert [r for r in facts(spark, warehouse, "match_id", "player_id", "value") if r[0] == 1] == [(1, 7, 91.0)]
    assert content(spark, warehouse)["matches"] == before["matches"]


def test_a_load_of_one_match_leaves_the_files_of_other_parts(spark, landing, tmp_path):
    warehouse = tmp_path / "tables"
    spark.conf.set("spark.matchstats.buckets", "16")
    try:
        ingest(spark, str(landing), str(warehouse))
    finally:
        spark.conf.unset("spark.matchstats.buckets")
    old = {p.folder: p for p in storage.current_parts(spark, str(warehouse), "player_stats_log")}
    assert len(old) > 1
    files = files_of(warehouse / "player_stats_log")
    land(landing, "lineups", "b", lineups(5, [listed(7, "Ana", minutesPlayed=9)], []))
    land(landing, "events", "b", {"events": [event(5, 100)]})
    ingest(spark, str(landing), str(warehouse))
    new = {p.folder: p for p in storage.current_parts(spark, str(warehouse), "player_stats_log")}
    assert len(set(old) - set(new)) <= 1 and len(set(new) - set(old)) == 1
    assert all(p.buckets == 16 for p in new.values())
    now = files_of(warehouse / "player_stats_log")
    assert {k: v for k, v in now.items() if k in files} == files
    assert (5, 7, 9.0) in facts(spark, str(warehouse), "match_id", "player_id", "value")


def test_open_tables_can_be_read_after_many_loads(spark, loaded):
    landing, warehouse = loaded
    opened = open_tables(spark, warehouse)
    rows = opened.player_stats.count(), opened.clubs.count()
    for n in range(5):
        land(landing, "events", f"n{n}", {"events": [event(1, 100, name=f"Reds {n}")]})
        land(landing, "lineups", f"n{n}", lineups(1, [listed(7, "Ana", minutesPlayed=n)], []))
        ingest(spark, str(landing), warehouse, force=True)
    assert (opened.player_stats.count(), opened.clubs.count()) == rows
    assert storage.clean_up(spark, warehouse) == []
    before = content(spark, warehouse)
    removed = storage.clean_up(spark, warehouse, timedelta(seconds=-60))
    assert removed and content(spark, warehouse) == before
    left = sorted(p.name for p in (Path(warehouse) / "clubs").iterdir())
    assert len(left) == 1


def test_clean_up_keeps_what_was_current_within_the_retention(spark, tmp_path):
    row = as_table(spark.createDataFrame([(1, "Reds")], "team_id long, name string"), "clubs")
    folder = tmp_path / "clubs"
    for _ in range(4):
        write_version(row, str(folder))
    long_ago = time.time() - 1000
    for n in (1, 2, 3):
        for path in (folder / f"version={n}" / "_SUCCESS", folder / f"version={n}"):
            os.utime(path, (long_ago + n, long_ago + n))
    storage.clean_up(spark, str(tmp_path), timedelta(seconds=500))
    # version 3 was current until version 4 came, just now
    assert sorted(p.name for p in folder.iterdir()) == ["version=3", "version=4"]


def test_nothing_fetched_writes_nothing(spark, loaded, tmp_path):
    landing, warehouse = loaded[0], tmp_path / "tables"
    before = files_of(warehouse)
    land(landing, "events", "b", {"events": [event(1, 100)]})
    ingest(spark, str(landing), str(warehouse))
    after = files_of(warehouse)
    assert not [p for p in after.keys() - before.keys() if not p.startswith("_landed")]


def test_every_line_is_accounted_for(spark, landing, tmp_path):
    cut = [json.dumps(lineups(n, [listed(7, "Ana", minutesPlayed=n)], [])) for n in range(10, 30)]
    kept = [line if n % 5 else line[: len(line) // 2] for n, line in enumerate(cut)]
    (landing / "lineups" / "cut.json").write_text("\n".join(kept))
    land(landing, "events", "b", {"events": [event(n, 100) for n in range(10, 30)]})
    pretty = json.dumps({"events": [event(99, 100)]}, indent=1)
    (landing / "events" / "pretty.json").write_text(pretty)
    warehouse = str(tmp_path / "tables")
    broken = ingest(spark, str(landing), warehouse)
    assert broken["lineups"] == 4 and 0 < broken["events"] <= len(pretty.splitlines())
    found = {r[0] for r in facts(spark, warehouse, "match_id")}
    assert {n for n in found if 10 <= n < 30} == {n for n in range(10, 30) if n % 5}
    lines = [r.line for r in landed.quarantine(spark, warehouse).filter("kind = 'lineups'").collect()]
    assert sorted(lines) == sorted(line for n, line in enumerate(kept) if n % 5 == 0)
    assert ingest(spark, str(landing), warehouse) == broken
    with pytest.raises(ValueError, match="lineups"):
        ingest(spark, str(landing), str(tmp_path / "other"), on_broken="fail")
    assert open_tables(spark, str(tmp_path / "other")).matches.isEmpty()


def test_a_load_reads_only_new_files_and_the_parts_of_its_matches(spark, landing, tmp_path):
    warehouse = str(tmp_path / "tables")
    ingest(spark, str(landing), warehouse)
    for path in (landing / "lineups").iterdir():
        path.write_text("no longer needed")
        os.utime(path, ns=(path.stat().st_mtime_ns, next(m for f, m in _times(spark, warehouse) if f.endswith(path.name)) * 1_000_000))
    land(landing, "events", "b", {"events": [event(2, 100)]})
    assert ingest(spark, str(landing), warehouse) == {}
    assert (2, 7, 1.0) in facts(spark, warehouse, "match_id", "player_id", "value")


def _times(spark, warehouse):
    rows = spark.read.schema("kind string, path string, modified long").parquet(f"{warehouse}/_landed/files/load=1").collect()
    return [(r.path, r.modified) for r in rows if r.kind == "lineups"]


def test_streamed_broken_lines_are_kept(spark, landing, tmp_path):
    (landing / "lineups" / "cut.json").write_text('{"match_id": 5, "home": {"pl')
    streamed = str(tmp_path / "streamed")
    stream_ingest(spark, str(landing), streamed, str(tmp_path / "checkpoint")).awaitTermination()
    assert [(r.kind, r.line) for r in landed.quarantine(spark, streamed).collect()] == [("lineups", '{"match_id": 5, "home": {"pl')]
    assert len(facts(spark, streamed, "match_id")) == 7


def test_reprocess_restores_the_club_of_the_side(spark, landing, tmp_path):
    warehouse = str(tmp_path / "tables")
    ingest(spark, str(landing), warehouse)
    right = content(spark, warehouse)
    wrong = read_table(spark, warehouse, "player_stats_log").selectExpr(
        *[c if c != "team_id" else "1L as team_id" for c in TABLES["player_stats_log"].fieldNames()]
    )
    other = str(tmp_path / "other")
    for name in ("tournaments", "clubs", "matches", "players"):
        write_version(read_table(spark, warehouse, name), f"{other}/{name}")
    append_facts(wrong, other, "player_stats_log")
    reprocess(spark, str(landing), other)
    assert content(spark, other)["player_stats_log"] == right["player_stats_log"]


def test_an_interrupted_version_is_not_read(spark, tmp_path):
    warehouse = str(tmp_path / "tables")
    row = spark.createDataFrame([(1, "Reds")], "team_id long, name string")
    write_version(as_table(row, "clubs"), f"{warehouse}/clubs")
    broken = tmp_path / "tables" / "clubs" / "version=2"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("half a file")
    assert read_table(spark, warehouse, "clubs").count() == 1
    assert write_version(as_table(row, "clubs"), f"{warehouse}/clubs").endswith("version=3")


def test_tables_that_do_not_exist_are_empty(spark, tmp_path):
    for name, schema in TABLES.items():
        df = read_table(spark, str(tmp_path), name)
        assert df.schema == schema and df.isEmpty()
    ingest(spark, str(tmp_path / "nothing"), str(tmp_path / "tables"))
    assert open_tables(spark, str(tmp_path / "tables")).player_stats.isEmpty()


def test_spatial_tables_are_typed(spark, tmp_path):
    shots = spark.createDataFrame([(1, 2, 3, "Ana", True)], "id long, match_id long, player_id long, player_name string, is_home_team boolean")
    as_table(shots, "match_shots").write.parquet(str(tmp_path / "match_shots"))
    df = read_table(spark, str(tmp_path), "match_shots")
    assert df.schema == TABLES["match_shots"] and df.first().x_coord is None


def test_rounds(spark, tmp_path):
    land(tmp_path, "rounds", "a", {"tournament_id": 9, "season_id": 90, "rounds": [{"round": 1}, {"round": 29, "name": "Final", "slug": "final"}]})
    wanted = spark.createDataFrame([(9, 90), (9, 91)], "tournament_id long, season_id long")
    got = L.flatten_rounds(L.read_payloads(spark, str(tmp_path), "rounds"), wanted)
    first = sorted(tuple(r)[2:] for r in got.filter("season_id = 90").collect())
    assert first == [(1, None, "Round 1"), (29, "final", "Final")]
    assert sorted(r.round_id for r in got.filter("season_id = 91").collect()) == list(range(1, 39))


def test_stream_equals_batch_in_any_order(spark, landing, tmp_path):
    batch = str(tmp_path / "batch")
    ingest(spark, str(landing), batch)

    streamed, late = str(tmp_path / "streamed"), tmp_path / "late"
    run = lambda: stream_ingest(spark, str(late), streamed, str(tmp_path / "checkpoint"), files_per_batch=1).awaitTermination()
    for kind in ("lineups", "statistics", "events"):
        land(late, kind, "a", *[json.loads(x) for x in (landing / kind / "a.json").read_text().splitlines()])
        run()
    assert content(spark, streamed) == content(spark, batch)

    land(late, "lineups", "again", *[json.loads(x) for x in (landing / "lineups" / "a.json").read_text().splitlines()])
    run()
    assert content(spark, streamed) == content(spark, batch)
    # A match that moves to another season takes its facts along, without being delivered again.
    land(late, "events", "moved", {"events": [event(3, 110, 2, 1, "Blues", season={"id": 92, "year": "2027"})]})
    run()
    assert {r for r in facts(spark, streamed, "match_id", "season_id")} == {(1, 90), (3, 92), (4, 90)}
    # A match that finishes later takes up what has been waiting for it.
    land(late, "events", "b", {"events": [event(2, 100)]})
    run()
    assert (2, 7, 1.0) in facts(spark, streamed, "match_id", "player_id", "value")


def test_only_the_latest_delivery_waits(spark, tmp_path):
    late, tables = tmp_path / "late", tmp_path / "tables"
    for file, minutes in (("a", 10), ("b", 20), ("c", 30)):
        land(late, "lineups", file, lineups(2, [listed(7, "Ana", minutesPlayed=minutes)], []))
        if file == "a":
            land(late, "statistics", file, statistics(2, ITEMS[0]))
        stream_ingest(spark, str(late), str(tables), str(tmp_path / "checkpoint")).awaitTermination()
        time.sleep(1.1)
    assert waiting.waiting(spark, str(tables)).count() == 2
    land(late, "events", "a", {"events": [event(2, 100)]})
    stream_ingest(spark, str(late), str(tables), str(tmp_path / "checkpoint")).awaitTermination()
    assert facts(spark, str(tables), "match_id", "value") == [(2, 30.0)]


def test_a_repeated_micro_batch_changes_nothing(spark, landing, tmp_path):
    reader = spark.read.schema(f"{L.ANY_PAYLOAD}, {L.BROKEN} STRING").option("recursiveFileLookup", "true")
    metadata = ["_metadata.file_modification_time AS landed_at", "_metadata.file_path AS file"]
    payloads = reader.json(str(landing)).selectExpr("*", *metadata)
    warehouse = str(tmp_path / "tables")
    load_batch(payloads, 0, warehouse)
    before = content(spark, warehouse)
    load_batch(payloads, 0, warehouse)
    load_batch(payloads, 1, warehouse)
    assert content(spark, warehouse) == before


def test_scratch_folders_are_new_and_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first != second
    assert not shared or first.startswith(shared)


@pytest.mark.parametrize(("master", "allowed"), [("local[8]", True), ("local", True), ("yarn", False), ("local-cluster[3,2,1000]", False)])
def test_a_cluster_has_to_name_its_shared_folder(master, allowed):
    class Conf(dict):
        pass

    session = SimpleNamespace(conf=Conf(), sparkContext=SimpleNamespace(master=master))
    if allowed:
        assert "matchstats-x" in scratch_folder(session, "x")
    else:
        with pytest.raises(ValueError, match="checkpoint"):
            scratch_folder(session, "x")
    session.conf["spark.checkpoint.dir"] = "hdfs:///shared"
    assert scratch_folder(session, "x").startswith("hdfs:///shared/")
