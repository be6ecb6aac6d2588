"""What a load holds, and how its work is dealt out, as tables grow."""

import json
import re
from pathlib import Path

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchstats import tune
from matchstats.plans import ingest as jobs
from matchstats.plans import queries as Q
from matchstats.plans.ingest import ingest
from matchstats.session import BYTES_EACH, PARTITIONS
from matchstats.sources import landed
from matchstats.sources import landing as L
from matchstats.sources import orders_binding as B
from matchstats.sources import storage
from matchstats.sources.tables import read_table
from matchstats.streaming.ingest import stream_ingest

SF = "/root/testdata/sf0.001"


def _land(folder, kind, *payloads):
    (folder / kind).mkdir(parents=True, exist_ok=True)
    (folder / kind / "a.json").write_text("\n".join(map(json.dumps, payloads)))


@pytest.fixture
def landing(tmp_path):
    def player(n):
        return {"position": "F", "player": {"id": n, "name": f"P{n}"}, "statistics": {"goals": n, "minutesPlayed": 90}}

    team = {"homeTeam": {"id": 1, "name": "A"}, "awayTeam": {"id": 2, "name": "B"}}
    unique = {"uniqueTournament": {"id": 9, "name": "Cup"}}
    events = [
        {"id": n, "startTimestamp": 0, "status": {"code": code}, "season": {"id": 90, "year": "2025"}, "tournament": unique, **team}
        for n, code in ((1, 100), (2, 60))
    ]
    item = {"key": "passes", "homeValue": "3", "awayValue": "4"}
    periods = [{"period": "ALL", "groups": [{"statisticsItems": [item]}]}]
    folder = tmp_path / "landing"
    _land(folder, "events", {"tournament_id": 9, "season_id": 90, "events": events})
    _land(folder, "lineups", *({"match_id": n, "home": {"players": [player(7)]}, "away": None} for n in (1, 2)))
    _land(folder, "statistics", *({"match_id": n, "statistics": periods} for n in (1, 2)))
    return str(folder)


@pytest.mark.parametrize("way", ["batch", "stream"])
def test_a_load_holds_no_payloads(spark, landing, tmp_path, monkeypatch, way):
    held, persist, tables = [], DataFrame.persist, str(tmp_path / "tables")

    def noted(df, *level):
        held.extend(f.name for f in df.schema.fields if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)))
        return persist(df, *level)

    monkeypatch.setattr(DataFrame, "persist", noted)
    if way == "batch":
        ingest(spark, landing, tables)
    else:
        stream_ingest(spark, landing, tables, str(tmp_path / "checkpoint")).awaitTermination()
        assert not storage.exists(spark, f"{tables}/_batch")
    assert not held
    facts = read_table(spark, tables, "player_stats_log").select("match_id", "player_id", "team_id", "metric_key", "value")
    assert {tuple(r) for r in facts.collect()} == {(1, 7, 1, "goals", 7.0), (1, 7, 1, "minutesPlayed", 90.0)}
    assert read_table(spark, tables, "match_stats_log").count() == 1


def test_keys_of_a_load_do_not_go_through_the_driver(spark, landing, tmp_path, monkeypatch):
    """What Spark takes for small by its files may be millions of matches: the joins of all keys are shuffles."""
    plans, held = {}, storage.held

    def noted(df, root, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return held(df, root, name)

    monkeypatch.setattr(storage, "held", noted)
    for _ in range(2):
        ingest(spark, landing, str(tmp_path / "tables"), force=True)
    for name in ("moved", "wanted", "chosen"):
        assert "SortMergeJoin" in plans[name] and "Broadcast" not in plans[name]


def test_facts_to_be_put_right_are_appended_by_pieces(spark, monkeypatch):
    """Pieces of whole buckets, with the rows that one piece has."""
    name = "reprocess_team_attribution"
    whole = sorted(map(tuple, Q.registered()[name](spark, SF).collect()), key=str)
    appended, append = [], Q.append_facts

    def noted(rows, root, *rest):
        append(rows, root, *rest)
        appended.append({p.bucket for p in storage.current_parts(spark, root, rest[0])})

    monkeypatch.setattr(Q, "append_facts", noted)
    monkeypatch.setattr(Q, "_PIECE_BYTES", B.bound_bytes(spark, SF) // 3)
    assert sorted(map(tuple, Q.registered()[name](spark, SF).collect()), key=str) == whole
    assert [len(buckets) for buckets in appended] == [2, 3, 4]


def test_payloads_of_one_moment_all_count(spark, landing, tmp_path):
    """Lineups that land at the same time as an empty second delivery: each payload's rows come once."""
    with open(f"{landing}/lineups/a.json", "a") as file:
        file.write('\n{"match_id": 1, "home": null, "away": null}')
    stream_ingest(spark, landing, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    assert read_table(spark, str(tmp_path / "t"), "player_stats_log").count() == 2


def test_players_are_read_without_statistics(spark, tmp_path):
    player = {"position": "M", "player": {"id": 5, "name": "E"}, "statistics": {"goals": 1}}
    texts = [json.dumps({"match_id": 1, "home": {"players": [player, None]}, "away": away}) for away in (None, {"players": None})]
    parsed = L.parse_payloads(spark.createDataFrame([(t,) for t in texts], "body string"), "lineups")
    parsed.write.parquet(str(tmp_path / "log"))
    matches = spark.createDataFrame([(1, 90, 11, 12)], "match_id long, season_id long, home_team_id long, away_team_id long")
    payloads = L.with_match(spark.read.parquet(str(tmp_path / "log")), matches)
    players = L.lineup_players(L.listed_players(payloads))
    assert players.collect() == L.lineup_players(L.flatten_lineups(payloads)).collect()
    read = re.findall(r"ReadSchema: (.*)", players._jdf.queryExecution().toString())
    assert any("player:" in schema for schema in read) and not any("statistics" in schema for schema in read)


def test_landed_files_are_small_and_their_texts_are_not_shuffled(spark, tmp_path, monkeypatch):
    texts = []
    repartition = DataFrame.repartition
    monkeypatch.setattr(DataFrame, "repartition", lambda df, *to: texts.extend(c for c in df.columns if c == "body") or repartition(df, *to))
    tables = B.land(spark, SF, str(tmp_path))
    assert not texts
    for kind in ("events", "lineups", "statistics"):
        files = list((tmp_path / kind).glob("part-*"))
        assert len(files) > 1 and all(f.name.endswith(".gz") for f in files)
    landed = L.flatten_events(L.read_payloads(spark, str(tmp_path), "events")).select("event.id")
    assert landed.count() == tables.matches.count()


def test_shuffles_are_dealt_by_the_size_of_the_tables(spark):
    try:
        tune(spark, 100 * BYTES_EACH)
        plan = spark.range(10).groupBy(F.col("id") % 3).count()._jdf.queryExecution().toString()
        assert re.search(r"hashpartitioning\(.*, 100\)", plan)
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8m"
    finally:
        tune(spark)
    assert spark.conf.get(PARTITIONS, None) is None
    assert 0 < B.bound_bytes(spark, SF) < B.bound_bytes(spark, "/root/testdata/sf0.01")
    assert storage.size(spark, f"{SF}/none.parquet") == 0


def _noted(monkeypatch, module, name):
    """The first argument of each call of a function of a module."""
    whole, seen = getattr(module, name), []
    monkeypatch.setattr(module, name, lambda first, *rest, **named: seen.append(first) or whole(first, *rest, **named))
    return seen


def test_facts_are_loaded_by_groups_of_buckets(spark, tmp_path, monkeypatch):
    B.land(spark, SF, str(tmp_path / "landing"))
    facts = {}
    for most in (landed.DELIVERIES_EACH, 1):
        with monkeypatch.context() as patch:
            patch.setattr(landed, "DELIVERIES_EACH", most)
            seen = _noted(patch, jobs, "load_lineups")
            ingest(spark, str(tmp_path / "landing"), str(tmp_path / f"t{most}"))
            matches = [{r.match_id for r in lineups.select("match_id").collect()} for lineups in seen]
        assert len(matches) == (storage.BUCKETS if most == 1 else 1)
        assert sum(map(len, matches)) == len(set().union(*matches))
        tables = [read_table(spark, str(tmp_path / f"t{most}"), n) for n in ("player_stats_log", "match_stats_log", "players")]
        facts[most] = [sorted(map(str, table.collect())) for table in tables]
    assert facts[1] == facts[landed.DELIVERIES_EACH] and all(facts[1])


def test_files_are_parsed_by_bytes(spark, landing, tmp_path, monkeypatch):
    monkeypatch.setattr(landed, "BATCH_BYTES", 1)
    seen = _noted(monkeypatch, landed, "read_files")
    now = landed.absorb(spark, landing, str(tmp_path / "t"))
    assert len(seen) == 3 and len(storage.found(spark, f"{tmp_path}/t/_landed/files/load=1/batch=*")) > 1
    assert landed.deliveries(spark, str(tmp_path / "t"), now.new).count() == 4


def test_logs_are_compacted_by_groups_of_buckets(spark, tmp_path, monkeypatch):
    folder, tables = tmp_path / "landing", str(tmp_path / "t")
    for name, goals in (("a", 1), ("b", 2)):
        for n in range(12 if name == "a" else 6):
            player = {"position": "F", "player": {"id": 7, "name": "P"}, "statistics": {"goals": goals}}
            _land(folder / f"{name}{n}", "x", {"match_id": n, "home": {"players": [player]}, "away": None})
        _land(folder / f"{name}_", "x", {"match_id": None, "home": None, "away": None})
        for path in folder.glob(f"{name}*/x/a.json"):
            to = folder / "lineups" / path.parts[-3]
            to.mkdir(parents=True)
            (to / "a.json").write_text(path.read_text() + ("\n{cut" if path.parts[-3] == "a0" else ""))
        ingest(spark, str(folder), tables)
    monkeypatch.setattr(landed, "DELIVERIES_EACH", 1)
    seen = _noted(monkeypatch, landed, "_write")
    assert landed.compact(spark, tables)
    assert len(seen) > 4
    now = landed.state(spark, tables)
    goals = landed.payloads(spark, tables, "lineups", now.done).selectExpr("match_id", "home.players[0].statistics['goals'] AS goals")
    assert sorted(map(tuple, goals.filter("match_id IS NOT NULL").collect())) == [(n, "2" if n < 6 else "1") for n in range(12)]
    assert goals.filter("match_id IS NULL").count() == 2 and landed.quarantine(spark, tables).count() == 1


@pytest.mark.parametrize("way", ["batch", "stream"])
def test_a_load_keeps_nothing_in_memory(spark, landing, tmp_path, monkeypatch, way):
    kept, persist, tables = [], DataFrame.persist, str(tmp_path / "tables")
    monkeypatch.setattr(DataFrame, "persist", lambda df, *level: kept.append(df.columns) or persist(df, *level))
    if way == "batch":
        ingest(spark, landing, tables)
    else:
        stream_ingest(spark, landing, tables, str(tmp_path / "checkpoint")).awaitTermination()
    assert not kept
    assert read_table(spark, tables, "matches").count() == 2 and read_table(spark, tables, "player_stats_log").count() == 2
    assert all(path.endswith("/chosen") for path, _ in storage.found(spark, f"{tables}/{storage.HELD}/*"))


def test_a_large_first_load_is_dealt_to_more_buckets(spark, landing, tmp_path, monkeypatch):
    tables = str(tmp_path / "t")
    monkeypatch.setattr(landed, "BUCKET_BYTES", -(-sum(f.stat().st_size for f in Path(landing).glob("*/*.json")) // 7))
    ingest(spark, landing, tables)
    for name in ("player_stats_log", "match_stats_log"):
        assert {part.buckets for part in storage.current_parts(spark, tables, name)} == {7}
    assert landed.state(spark, tables).buckets == 7 * landed.BUCKETS_EACH
    assert read_table(spark, tables, "player_stats_log").count() == 2 and read_table(spark, tables, "match_stats_log").count() == 1


def test_few_deliveries_go_to_their_payloads(spark, tmp_path, monkeypatch):
    """Payloads are joined with the keys of a piece where they are, unless these are too many."""
    chosen = spark.createDataFrame([("lineups", n, 90) for n in range(8)], "kind string, match_id long, season_id long")
    for most in (landed.DELIVERIES_EACH, 0):
        monkeypatch.setattr(landed, "DELIVERIES_EACH", most)
        for piece in jobs._pieces(chosen, str(tmp_path), 4):
            other = spark.range(1000).withColumnRenamed("id", "match_id").join(piece.filter("kind = 'lineups'"), "match_id")
            hinted = "rightHint=(strategy=broadcast)" in other._jdf.queryExecution().optimizedPlan().toString()
            assert hinted == (most > 0)
