"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The bound tables are first written in the library's own storage layout, so that deriving them is
not timed.  Each query runs once to warm up and three times for the median.  The write path is
timed as well: one first load of all payloads as a job and as a stream (landing them is not timed),
and replacing the facts of every hundredth match, three times.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from matchstats import StatsTables, open_tables, tune  # noqa: E402
from matchstats.operators.compare import compare, with_without  # noqa: E402
from matchstats.operators.context import in_competition_season  # noqa: E402
from matchstats.operators.entities import context_entities  # noqa: E402
from matchstats.operators.games import last_games, match_records  # noqa: E402
from matchstats.operators.leaderboards import club_leaderboard, player_leaderboard  # noqa: E402
from matchstats.operators.streaks import streaks  # noqa: E402
from matchstats.plans.ingest import ingest  # noqa: E402
from matchstats.session import scratch_folder  # noqa: E402
from matchstats.sources.orders_binding import bind, land  # noqa: E402
from matchstats.sources.sinks import append_facts, as_table, replace_facts  # noqa: E402
from matchstats.sources.storage import write_version  # noqa: E402
from matchstats.streaming.ingest import stream_ingest  # noqa: E402

RUNS = 3

QUERIES = {
    "leaderboard_player_total": lambda t: player_leaderboard(t, t.matches, "finishing"),
    "leaderboard_player_by_competition_season": lambda t: player_leaderboard(
        t, t.matches, "finishing", "by_competition_season"
    ),
    "leaderboard_player_one_season": lambda t: player_leaderboard(
        t, in_competition_season(t.matches, t.tournaments, ["ASIA"], ["1997"]), "passing"
    ),
    "leaderboard_club_for": lambda t: club_leaderboard(t, t.matches, "finishing"),
    "leaderboard_club_against": lambda t: club_leaderboard(
        t, t.matches, "finishing", perspective="against"
    ),
    "records_player": lambda t: match_records("player", t, t.matches, "finishing", "totalShots"),
    "records_club": lambda t: match_records("club", t, t.matches, "finishing", "goals"),
    "last_n_player": lambda t: last_games("player", t, t.matches, "finishing", 10),
    "streaks_player": lambda t: streaks("player", t, t.matches, "finishing", "goals"),
    "streaks_club": lambda t: streaks("club", t, t.matches, "finishing", "goals"),
    "compare_players": lambda t: compare("player", t, t.matches, 101, 9010, "duels"),
    "with_without_player": lambda t: with_without(t, t.matches, 9010, 3, "finishing"),
    "context_entities": lambda t: context_entities(t, t.matches),
}


def stored_tables(spark: SparkSession, sf_dir: str) -> StatsTables:
    """The bound tables, written and opened like ingested ones."""
    root = scratch_folder(spark, "bench")
    bound = bind(spark, sf_dir)
    for name in ("tournaments", "clubs", "matches", "players"):
        write_version(as_table(getattr(bound, name), name), f"{root}/{name}")
    seasons = bound.matches.select("match_id", "season_id")
    append_facts(bound.match_stats.join(seasons, "match_id"), root, "match_stats_log")
    append_facts(bound.player_stats.join(seasons, "match_id"), root, "player_stats_log")
    return open_tables(spark, root)


def timed(build, tables: StatsTables) -> float:
    start = time.perf_counter()
    result: DataFrame = build(tables)
    result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def timed_run(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def write_paths(spark: SparkSession, sf_dir: str, tables: StatsTables) -> dict[str, list[float]]:
    """Seconds of loads and replacements."""
    root = scratch_folder(spark, "bench-load")
    land(spark, sf_dir, f"{root}/landing")
    few = tables.matches.filter("match_id % 100 = 1").select("match_id", "season_id")
    facts = tables.match_stats.join(few.select("match_id"), "match_id", "left_semi")
    append_facts(tables.match_stats, f"{root}/replaced", "match_stats_log")
    return {
        "ingest_first_load": [timed_run(lambda: ingest(spark, f"{root}/landing", f"{root}/tables"))],
        "stream_first_load": [
            timed_run(
                lambda: stream_ingest(
                    spark, f"{root}/landing", f"{root}/streamed", f"{root}/checkpoint"
                ).awaitTermination()
            )
        ],
        "replace_match_facts": [
            timed_run(lambda: replace_facts(facts, few, f"{root}/replaced", "match_stats_log"))
            for _ in range(RUNS)
        ],
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = tune(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("matchstats-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.matchstats.buckets", "1")  # a season is a few megabytes here
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = stored_tables(spark, sf_dir)
    seconds = {}
    for name in sys.argv[1:] or QUERIES:
        runs = [timed(QUERIES[name], tables) for _ in range(RUNS + 1)]
        seconds[name] = round(statistics.median(runs[1:]), 4)
    if not sys.argv[1:]:
        for name, runs in write_paths(spark, sf_dir, tables).items():
            seconds[name] = round(statistics.median(runs), 4)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
