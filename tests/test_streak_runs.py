"""Streak lengths against a plain loop, with a hot entity and many games on one day."""

import random
from datetime import datetime, timedelta
from itertools import groupby

import pytest

from matchstats.operators.streaks import streak_summary

SCHEMA = "entity long, team_id long, match_date timestamp_ntz, match_id long, played int, hit int, recorded int"


def by_loop(hits):
    runs = [len(list(g)) for value, g in groupby(hits) if value]
    active = 0
    for h in reversed(hits):
        if not h:
            break
        active += 1
    return len(hits), sum(hits), active, max(runs, default=0)


def summary(spark, games):
    df = spark.createDataFrame(games, SCHEMA).repartition(5)
    return {
        r["entity"]: (r["games"], r["hits"], r["active_streak"], r["best_streak"], r["latest_team_id"])
        for r in streak_summary(df, "entity").collect()
    }


@pytest.mark.parametrize(
    ("hits", "active", "best"),
    [([1, 1, 0, 1], 1, 2), ([0, 0, 0], 0, 0), ([1, 1, 1], 3, 3), ([1, 0], 0, 1), ([0], 0, 0)],
)
def test_listed_cases(spark, hits, active, best):
    day = datetime(2025, 1, 1)
    games = [(1, 7, day + timedelta(days=i), i, 1, h, 1) for i, h in enumerate(hits)]
    assert summary(spark, games) == {1: (len(hits), sum(hits), active, best, 7)}
    same_day = [(1, 7, day, i, 1, h, 1) for i, h in enumerate(hits)]
    assert summary(spark, same_day) == {1: (len(hits), sum(hits), active, best, 7)}


@pytest.mark.parametrize("seed", range(4))
def test_random_games(spark, seed):
    rng = random.Random(seed)
    games, expected = [], {}
    match_id = 0
    for entity in range(40):
        count = 1500 if entity == 0 else rng.randint(1, 30)
        hit_rate = rng.choice([0.1, 0.5, 0.9, 1.0])
        own = []
        for _ in range(count):
            match_id += 1
            when = datetime(2024, 1, 1) + timedelta(days=rng.randint(0, 25), hours=rng.choice([0, 18]))
            own.append((entity, rng.randint(1, 3), when, match_id, 1, int(rng.random() < hit_rate), 1))
        own.sort(key=lambda g: (g[2], g[3], g[1]))
        expected[entity] = (*by_loop([g[5] for g in own]), own[-1][1])
        games += own
    rng.shuffle(games)
    assert summary(spark, games) == expected


def test_rows_outside_the_calendar_are_neutral(spark):
    day = datetime(2025, 1, 1)
    games = [
        (1, 1, day, 1, 1, 1, 0),
        (1, 1, day + timedelta(days=1), 2, 0, 0, 1),
        (1, 1, day + timedelta(days=2), 3, 1, 1, 0),
        (1, 1, None, 4, 1, 1, 0),
        (2, 2, day, 1, 1, 1, 0),
        (3, 3, day, 1, 0, 0, 1),
    ]
    got = summary(spark, games)
    # Entity 2 has no recorded game, entity 3 no game in the calendar; the undated game is last.
    assert {k: v[:4] for k, v in got.items()} == {1: (3, 3, 3, 3)}
