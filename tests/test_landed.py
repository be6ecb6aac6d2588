"""The log of landed payloads: what a load reads, broken-off loads, compaction, waiting payloads."""

import json
import os
import time
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_ingest import ITEMS, content, event, facts, files_of, land, landing, lineups, listed, loaded, loaded_once, statistics  # noqa: F401

from matchstats.plans import ingest as jobs
from matchstats.plans.ingest import ingest, reprocess
from matchstats.sources import landed, sinks, storage
from matchstats.sources import landing as L
from matchstats.sources.tables import read_table
from matchstats.streaming import waiting
from matchstats.streaming.ingest import load_batch


def spoil(paths):
    """Make files unreadable, as they are, for whoever reads them."""
    paths = list(paths)
    for path in paths:
        path.write_bytes(b"not to be read")
        checksum = path.with_name(f".{path.name}.crc")
        if checksum.exists():
            checksum.unlink()
    return len(paths)


def rows(spark, warehouse):
    return facts(spark, warehouse, "match_id", "player_id", "metric_key", "value")


def test_a_load_of_one_match_reads_its_own_part_of_the_log(spark, loaded):  # noqa: F811
    landing, warehouse = loaded[0], Path(loaded[1])
    # fifty earlier loads of ten matches each, whose events have not come yet
    land(landing, "lineups", "n", *[lineups(m, [listed(7, "Ana", minutesPlayed=m)], []) for m in range(1000, 1500)])
    now = landed.absorb(spark, str(landing), str(warehouse))
    logged = landed._logged(spark, str(warehouse), "lineups", now.new)
    spread = logged.withColumn("load", F.floor(F.col("match_id") / 10).cast("int"))
    spread.hint("rebalance", "load", "bucket").write.mode("append").partitionBy("load", "bucket").parquet(f"{warehouse}/_landed/lineups")
    files = spark.createDataFrame([(n, "lineups", f"n{n}", 0) for n in range(100, 150)], "load int, kind string, path string, modified long")
    files.repartition("load").write.mode("append").partitionBy("load").parquet(f"{warehouse}/_landed/files")
    loads = [1, *range(100, 150)]
    waits = landed.latest(landed.deliveries(spark, str(warehouse), loads))
    landed.commit(spark, str(warehouse), now._replace(done=[*loads, *now.new], new=[], waiting=waits))

    where = landed.state(spark, str(warehouse)).waiting.filter("match_id = 1234 AND kind = 'lineups'").first()
    own = f"lineups/load={where.load}/bucket={where.bucket}/"
    logged = list((warehouse / "_landed" / "lineups").rglob("part-*")) + list((warehouse / "_landed" / "statistics").rglob("part-*"))
    assert spoil(path for path in logged if own not in str(path)) > 200
    spoil((warehouse / "match_stats_log").glob("load=*/*/*/part-*"))
    land(landing, "events", "new", {"events": [event(1234, 100, season={"id": 77, "year": "2020"})]})
    ingest(spark, str(landing), str(warehouse))
    found = read_table(spark, str(warehouse), "player_stats_log").filter("season_id = 77").collect()
    assert [(r.match_id, r.value) for r in found] == [(1234, 1234.0)]


def test_whether_a_match_is_loaded_reads_no_facts(spark, loaded):  # noqa: F811
    landing, warehouse = loaded[0], Path(loaded[1])
    before = rows(spark, str(warehouse))
    assert spoil((warehouse / "match_stats_log").glob("load=*/*/*/part-*"))
    land(landing, "events", "b", {"events": [event(1, 100), event(3, 110, 2, 1, "Blues")]})
    land(landing, "lineups", "b", lineups(1, [listed(7, "Ana", minutesPlayed=1)], []))
    ingest(spark, str(landing), str(warehouse))
    assert rows(spark, str(warehouse)) == before
    asked = sinks.loaded_near(read_table(spark, str(warehouse), "matches"), str(warehouse))
    assert {r.match_id for r in asked.collect()} == {1, 3}


def test_the_list_of_matches_follows_replaced_and_moved_facts(spark, loaded):  # noqa: F811
    landing, warehouse = loaded
    land(landing, "events", "b", {"events": [event(1, 100, season={"id": 91, "year": "2026"})]})
    land(landing, "statistics", "b", statistics(3))
    ingest(spark, str(landing), warehouse, force=True)
    loaded = {r.match_id for r in sinks.loaded_near(read_table(spark, warehouse, "matches"), warehouse).collect()}
    assert loaded == {r.match_id for r in read_table(spark, warehouse, "match_stats_log").collect()} == {1}
    # match 3 has lost its statistics: it waits and is taken up again
    land(landing, "statistics", "c", statistics(3, ITEMS[0]))
    ingest(spark, str(landing), warehouse)
    assert {r.match_id for r in read_table(spark, warehouse, "match_stats_log").collect()} == {1, 3}


@pytest.mark.parametrize("batch", [1, 2, 100])
def test_new_files_are_parsed_in_batches(spark, landing, tmp_path, batch):  # noqa: F811
    for n in range(5):
        land(landing / "deep", "x", "x") if not n else None
        land(landing, f"lineups/day={n}", "x", lineups(4, [listed(7, "Ana", minutesPlayed=n)], []))
    warehouse = str(tmp_path / "tables")
    now = landed.absorb(spark, str(landing), warehouse, batch=batch)
    assert now.new == [1] and not now.done
    assert landed.ledger(spark, warehouse, [1]).count() == 8
    assert landed.payloads(spark, warehouse, "lineups", [1]).count() == 9
    again = landed.absorb(spark, str(landing), warehouse, batch=batch)
    assert again.new == [1]
    assert landed.listing(spark, str(landing)).count() == 8


def test_a_changed_file_is_parsed_again(spark, landing, tmp_path):  # noqa: F811
    warehouse = str(tmp_path / "tables")
    ingest(spark, str(landing), warehouse)
    land(landing, "lineups", "a", lineups(4, [listed(7, "Ana", minutesPlayed=31)], []))
    os.utime(landing / "lineups" / "a.json", (time.time() + 5, time.time() + 5))
    ingest(spark, str(landing), warehouse)
    assert (4, 7, "minutesPlayed", 31.0) in rows(spark, warehouse)
    assert landed.state(spark, warehouse).done == [1, 2]


def test_broken_lines_that_fail_a_load_leave_its_files_new(spark, loaded):  # noqa: F811
    landing, warehouse = loaded
    before = content(spark, warehouse)
    cut = landing / "lineups" / "cut.json"
    cut.write_text('{"match_id": 4, "home": {"pl')
    for _ in range(2):
        with pytest.raises(ValueError, match="'lineups': 1"):
            ingest(spark, str(landing), warehouse, on_broken="fail")
    assert content(spark, warehouse) == before and landed.state(spark, warehouse).loads == [1]
    cut.write_text(json.dumps(lineups(4, [listed(7, "Ana", minutesPlayed=33)], [])))
    assert ingest(spark, str(landing), warehouse, on_broken="fail") == {}
    assert (4, 7, "minutesPlayed", 33.0) in rows(spark, warehouse)
    # lines that an earlier load has put aside fail no later one
    cut.write_text('{"match_id": 4, "home"')
    os.utime(cut, (time.time() + 9, time.time() + 9))
    assert ingest(spark, str(landing), warehouse) == {"lineups": 1}
    assert ingest(spark, str(landing), warehouse, on_broken="fail") == {"lineups": 1}
    assert landed.quarantine(spark, warehouse).count() == 1


def test_a_load_that_breaks_off_anywhere_is_made_good(spark, landing, tmp_path, monkeypatch):  # noqa: F811
    whole = str(tmp_path / "whole")
    ingest(spark, str(landing), whole)
    steps = [(landed, "_write"), (landed, "commit"), (jobs, "load_events"), (jobs, "load_lineups"), (jobs, "load_statistics"), (landed, "latest")]
    warehouse = str(tmp_path / "tables")
    for module, name in steps:
        with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="lost"):
            patch.setattr(module, name, lambda *_, **__: (_ for _ in ()).throw(RuntimeError("lost")))
            ingest(spark, str(landing), warehouse)
    ingest(spark, str(landing), warehouse)
    assert content(spark, warehouse) == content(spark, whole)
    assert landed.state(spark, warehouse).new == []


def test_compacted_loads_hold_what_counts(spark, loaded):  # noqa: F811
    landing, warehouse = loaded[0], Path(loaded[1])
    for n in range(3):
        land(landing, "lineups", f"c{n}", lineups(2, [listed(7, "Ana", minutesPlayed=n)], []))
        (landing / "statistics" / f"cut{n}.json").write_text('{"match_id": ')
        ingest(spark, str(landing), str(warehouse))
        time.sleep(0.05)
    before, broken = content(spark, str(warehouse)), landed.quarantine(spark, str(warehouse)).count()
    assert landed.compact(spark, str(warehouse)) and not landed.compact(spark, str(warehouse))
    now = landed.state(spark, str(warehouse))
    assert len(now.done) == 1 and broken == 3 == landed.quarantine(spark, str(warehouse)).count()
    assert landed.payloads(spark, str(warehouse), "lineups", now.done).count() == 4
    removed = landed.clean_up(spark, str(warehouse), timedelta(seconds=-60))
    assert any("load=1" in path for path in removed)
    assert {p.name for p in (warehouse / "_landed" / "lineups").iterdir()} == {f"load={now.done[0]}"}
    assert ingest(spark, str(landing), str(warehouse)) == {"statistics": 3}
    assert content(spark, str(warehouse)) == before
    # a match that has waited through all that
    land(landing, "events", "d", {"events": [event(2, 100)]})
    ingest(spark, str(landing), str(warehouse))
    assert [r for r in rows(spark, str(warehouse)) if r[0] == 2] == [(2, 7, "minutesPlayed", 2.0)]
    ingest(spark, str(landing), str(warehouse), force=True)
    assert [r for r in rows(spark, str(warehouse)) if r[0] != 2] == [r for r in _rows_of(before)]


def _rows_of(stored):
    found = []
    for text in stored["player_stats_log"]:
        fields = dict(part.split("=", 1) for part in text.removeprefix("Row(").removesuffix(")").split(", "))
        found.append((int(fields["match_id"]), int(fields["player_id"]), fields["metric_key"].strip("'"), float(fields["value"])))
    return sorted(found)


def test_what_waits_is_what_is_not_loaded(spark, loaded):  # noqa: F811
    landing, warehouse = loaded
    held = landed.state(spark, warehouse).waiting.collect()
    # match 2 is unfinished, match 4 has no statistics
    assert {(r.kind, r.match_id) for r in held} == {("lineups", 2), ("statistics", 2), ("lineups", 4)}


def test_clean_up_keeps_loads_within_the_retention(spark, loaded, tmp_path):  # noqa: F811
    landing, warehouse = loaded
    land(landing, "events", "b", {"events": [event(2, 60)]})
    ingest(spark, str(landing), warehouse)
    landed.compact(spark, warehouse)
    assert landed.clean_up(spark, warehouse) == []
    assert landed.clean_up(spark, str(tmp_path / "nothing")) == []


def test_reprocessing_goes_on_where_it_broke_off(spark, landing, tmp_path, monkeypatch):  # noqa: F811
    spark.conf.set("spark.matchstats.buckets", "8")
    try:
        warehouse = str(tmp_path / "tables")
        ingest(spark, str(landing), warehouse)
        before = content(spark, warehouse)
        whole, seen = jobs._load_delivered, []

        def breaks(*args):
            seen.append(args)
            if len(seen) == 4:
                raise RuntimeError("lost")
            whole(*args)

        with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="lost"):
            patch.setattr(jobs, "_load_delivered", breaks)
            reprocess(spark, str(landing), warehouse)
        assert reprocess(spark, str(landing), warehouse) == [3, 4, 5, 6, 7]
        assert content(spark, warehouse) == before
        assert reprocess(spark, str(landing), warehouse) == list(range(8))
        assert content(spark, warehouse) == before
    finally:
        spark.conf.unset("spark.matchstats.buckets")


def batch_of(spark, folder):
    reader = spark.read.schema(f"{L.ANY_PAYLOAD}, {L.BROKEN} STRING").option("recursiveFileLookup", "true")
    reader = reader.option("columnNameOfCorruptRecord", L.BROKEN)
    metadata = ["_metadata.file_modification_time AS landed_at", "_metadata.file_path AS file"]
    return reader.json(str(folder)).selectExpr("*", *metadata)


def test_a_micro_batch_rewrites_only_the_buckets_of_its_matches(spark, tmp_path):
    late, tables = tmp_path / "late", tmp_path / "tables"
    land(late / "0", "lineups", "a", *[lineups(n, [listed(7, "Ana", minutesPlayed=n)], []) for n in range(2, 40)])
    load_batch(batch_of(spark, late / "0"), 0, str(tables))
    parts = waiting.parts_before(spark, str(tables))
    assert len(parts) > 10 and waiting.waiting(spark, str(tables)).count() == 38

    land(late / "1", "events", "a", {"events": [event(7, 60)]})
    files = files_of(tables / "_waiting")
    load_batch(batch_of(spark, late / "1"), 1, str(tables))
    assert files_of(tables / "_waiting") == files

    land(late / "2", "events", "a", {"events": [event(7, 100)]})
    for _ in range(2):
        load_batch(batch_of(spark, late / "2"), 2, str(tables))
        now = waiting.parts_before(spark, str(tables))
        assert {p.bucket for p in set(parts) - set(now)} == waiting.touched(spark.range(7, 8).toDF("match_id"))
        assert waiting.waiting(spark, str(tables)).count() == 37
        assert facts(spark, str(tables), "match_id", "value") == [(7, 7.0)]


def test_what_waits_for_long_is_reported_and_stays(spark, tmp_path):
    late, tables = tmp_path / "late", str(tmp_path / "tables")
    land(late, "lineups", "old", lineups(2, [listed(7, "Ana", minutesPlayed=1)], []))
    land(late, "statistics", "new", statistics(3, ITEMS[0]))
    os.utime(late / "lineups" / "old.json", (time.time() - 90000, time.time() - 90000))
    load_batch(batch_of(spark, late), 0, tables)
    found = waiting.overdue(spark, tables, timedelta(days=1)).collect()
    assert [(r.match_id, r.statistics, r.lineups) for r in found] == [(2, False, True)]
    assert waiting.waiting(spark, tables).count() == 2
    assert waiting.overdue(spark, str(tmp_path / "none"), timedelta(days=1)).isEmpty()
    assert storage.exists(spark, f"{tables}/_waiting")
