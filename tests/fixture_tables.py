"""Small tables with the awkward cases, computed by hand in the tests that use them."""

from datetime import datetime

from matchstats.schema import CLUBS, MATCH_STATS, MATCHES, PLAYER_STATS, PLAYERS, TOURNAMENTS
from matchstats.sources.tables import StatsTables


def _frame(spark, schema, rows):
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def _match(match_id, day, home, away, tournament=1, season=11, round_id=1, status=100, **more):
    names = {1: "Reds", 2: "Blues", 3: "Greens", 4: "Reds", 5: "Ghosts"}
    return {
        "match_id": match_id,
        "tournament_id": tournament,
        "season_id": season,
        "round_id": round_id,
        "home_team_id": home,
        "away_team_id": away,
        "home_team_name": names[home],
        "away_team_name": names[away],
        "match_date": None if day is None else datetime(2025, 3, day, 20, 0),
        "status_code": status,
        **more,
    }


MATCHES_ROWS = [
    _match(1, 1, 1, 2, round_id=1),
    _match(2, 2, 2, 1, round_id=2),
    _match(3, 2, 1, 3, round_id=2),
    _match(4, 4, 3, 1, round_id=3),
    _match(5, 5, 2, 3, round_id=27, round_name="Final"),
    _match(6, 6, 1, 2, tournament=1, season=12),
    _match(7, 7, 1, 4, tournament=2, season=12),
    _match(8, None, 1, 2),
    _match(9, 9, 1, 3, status=60),
    _match(10, 10, 1, 2, tournament=99, season=99),
    _match(11, 11, 5, 1, status=110),
]

TOURNAMENT_ROWS = [
    {"unique_tournament_id": 1, "season_id": 11, "name": "A", "season_year": "2025"},
    {"unique_tournament_id": 1, "season_id": 12, "name": "A", "season_year": "2026"},
    {"unique_tournament_id": 2, "season_id": 12, "name": "B", "season_year": "2026"},
]

CLUB_ROWS = [
    {"team_id": 1, "name": "Reds"},
    {"team_id": 2, "name": "Blues"},
    {"team_id": 3, "name": "Greens"},
    {"team_id": 4, "name": "Reds"},
]

PLAYER_ROWS = [
    {"player_id": 10, "team_id": 1, "name": "Ana", "position": "F"},
    {"player_id": 10, "team_id": 2, "name": "Ana", "position": "M"},
    {"player_id": 20, "team_id": 2, "name": "Bea", "position": "G"},
    {"player_id": 30, "team_id": 3, "name": "Cleo", "position": None},
    {"player_id": 40, "team_id": 1, "name": "Dora", "position": "D"},
]


def _stat(match, player, team, **stats):
    return [
        {"match_id": match, "player_id": player, "team_id": team, "metric_key": k, "value": float(v), "season_id": 11}
        for k, v in stats.items()
    ]


PLAYER_FACTS = [
    *_stat(1, 10, 1, minutesPlayed=90, goals=2, totalShots=5, onTargetScoringAttempt=3, duelWon=3, duelLost=5),
    *_stat(2, 10, 1, minutesPlayed=45, goals=1, totalShots=3, onTargetScoringAttempt=1),
    *_stat(3, 10, 1, minutesPlayed=90, totalShots=0),
    *_stat(4, 10, 1, minutesPlayed=90, goals=1, totalShots=2, onTargetScoringAttempt=1),
    *_stat(5, 10, 2, minutesPlayed=30, goals=1, totalShots=1),
    *_stat(1, 20, 2, minutesPlayed=90, totalShots=1, saves=4),
    *_stat(2, 20, 2, minutesPlayed=90, totalShots=0),
    *_stat(4, 30, 3, minutesPlayed=90, goals=1, totalShots=4),
    *_stat(1, 40, 1, minutesPlayed=10),
    *_stat(1, 50, 5, minutesPlayed=5, goals=1, totalShots=1),
]


def _official(match, period, key, home, away):
    return {"match_id": match, "period": period, "metric_key": key, "home_value": float(home), "away_value": float(away), "season_id": 11}


MATCH_FACTS = [
    _official(1, "ALL", "shotsOnGoal", 4, 1),
    _official(1, "1ST", "shotsOnGoal", 3, 0),
    _official(1, "2ND", "shotsOnGoal", 1, 1),
    _official(1, "ALL", "passes", 400, 300),
    _official(1, "ALL", "accuratePasses", 300, 240),
    _official(2, "ALL", "passes", 200, 100),
    _official(2, "ALL", "accuratePasses", 100, 80),
    _official(1, "ALL", "ballPossession", 60, 40),
    _official(2, "ALL", "ballPossession", 55, 45),
]


def small_tables(spark) -> StatsTables:
    return StatsTables(
        tournaments=_frame(spark, TOURNAMENTS, TOURNAMENT_ROWS),
        clubs=_frame(spark, CLUBS, CLUB_ROWS),
        matches=_frame(spark, MATCHES, MATCHES_ROWS),
        players=_frame(spark, PLAYERS, PLAYER_ROWS),
        match_stats=_frame(spark, MATCH_STATS, MATCH_FACTS).drop("season_id"),
        player_stats=_frame(spark, PLAYER_STATS, PLAYER_FACTS).drop("season_id"),
    )
