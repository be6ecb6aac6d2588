"""Operators on hand-computed tables."""

from datetime import date, datetime

import pytest
from fixture_tables import small_tables
from pyspark.sql import functions as F

from matchstats.functions.metrics import apply_calc_mode, best_flags, condition, ratio
from matchstats.functions.values import is_scalar, match_date, percent_value, split_camel_case, stat_value
from matchstats.operators import context as X
from matchstats.operators.compare import compare, with_without, with_without_split
from matchstats.operators.entities import context_entities
from matchstats.operators.games import last_games, match_records
from matchstats.operators.leaderboards import club_leaderboard, club_lists, player_leaderboard
from matchstats.operators.streaks import streaks
from matchstats.plans.queries import in_order
from matchstats.registry import CATEGORIES
from matchstats.sources.sinks import not_loaded, replace_by_match, upsert
from matchstats.sources.tables import keep_first, unique_dimension


@pytest.fixture(scope="module")
def t(spark):
    return small_tables(spark)


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()] if columns else [tuple(r) for r in df.collect()]


def ids(df, column="match_id"):
    return sorted(r[0] for r in df.select(column).collect())


# Context


def test_competition_and_season_ids_filter_independently(t):
    assert ids(X.in_competition_season(t.matches, t.tournaments, ["A"], ["2026"])) == [6]
    # B has only season 12, but tournament 1 has a season 12 as well: the cross combination passes.
    assert ids(X.in_competition_season(t.matches, t.tournaments, ["A", "B"], ["2025", "2026"])) == [
        1, 2, 3, 4, 5, 6, 7, 8, 9, 11,
    ]


def test_seasons(t):
    assert rows(X.available_seasons(t.tournaments, ["A"])) == [("2026",), ("2025",)]
    assert rows(X.default_season(t.tournaments, ["A"])) == [("2026",)]
    older = t.tournaments.filter("season_year = '2025'")
    assert rows(X.default_season(older, ["A"])) == [("2025",)]
    assert rows(X.default_season(older.withColumn("season_year", F.lit("25/26")), ["A"])) == [("25/26",)]


def test_bounds(t):
    assert rows(X.bounds(t.matches)) == [(date(2025, 3, 1), date(2025, 3, 11), 1, 27)]
    undated = t.matches.filter("match_date is null")
    assert rows(X.bounds(undated)) == [(date(2020, 1, 1), date.today(), 1, 38)]


def test_date_range_includes_both_days_and_drops_undated(t):
    assert ids(X.in_date_range(t.matches, date(2025, 3, 2), date(2025, 3, 5))) == [2, 3, 4, 5]
    assert 8 not in ids(X.in_date_range(t.matches, date(2000, 1, 1)))


def test_round_phases(spark, t):
    assert sorted(rows(X.round_phases(t.matches))) == [(1, True), (2, True), (3, True), (27, False)]
    only = lambda *r: spark.createDataFrame([(x, None) for x in r], "round_id int, round_name string")
    assert sorted(rows(X.round_phases(only(1, 5, 6)))) == [(1, False), (5, False), (6, False)]
    assert sorted(rows(X.round_phases(only(2, 3)))) == [(2, False), (3, False)]
    assert sorted(rows(X.round_phases(only(0, 1, 2)))) == [(0, False), (1, False), (2, False)]
    assert rows(X.round_phases(only())) == []
    assert sorted(rows(X.round_names(only(1, 5)))) == [(1, "Phase 1"), (5, "Phase 5")]


def test_round_names(t):
    assert rows(X.round_names(t.matches)) == [(27, "Final")]


def test_round_filter(t):
    assert ids(X.in_rounds(t.matches, (2, 3), [27])) == [2, 3, 4, 5]
    assert ids(X.in_rounds(t.matches, (3, 3))) == [4]
    assert ids(X.in_rounds(t.matches, None, [27])) == [5]
    assert ids(X.in_rounds(t.matches, None)) == []


def test_clubs_and_players(t):
    assert ids(X.with_club(t.matches, [4, 5])) == [7, 11]
    assert rows(X.clubs_in(t.matches, t.clubs), "name", "team_id") == [
        ("Blues", 2), ("Greens", 3), ("Reds", 1), ("Reds", 4),
    ]
    assert rows(X.players_of(t.players, [1]), "name") == [("Ana",), ("Dora",)]
    assert rows(X.player_ids_named(t.players, ["Ana"])) == [(10,)]
    as_frame = t.clubs.filter("name = 'Blues'").select("team_id")
    assert rows(X.players_of(t.players, as_frame), "name") == [("Ana",), ("Bea",)]
    assert ids(X.finished(t.matches)) == [1, 2, 3, 4, 5, 6, 7, 8, 10, 11]


def test_all_filters_together(t):
    ctx = X.select_matches(
        t, ["A"], ["2025"], date(2025, 3, 1), date(2025, 3, 31), X.round_condition((1, 3)), [3]
    )
    assert ids(ctx) == [3, 4, 9]


# Leaderboards


def test_player_leaderboard(t):
    board = player_leaderboard(t, t.matches, "finishing")
    # Cleo has no position, Dora no finishing row, player 50 no player row.
    assert rows(board, "player_id", "player", "club", "position", "games", "minutes", "goals", "totalShots", "shot_accuracy_pct") == [
        (10, "Ana", "Blues,Reds", "M", 5, 345, 5.0, 11.0, pytest.approx(500 / 11)),
        (20, "Bea", "Blues", "G", 2, 180, 0.0, 1.0, 0.0),
    ]
    assert board.columns[6:] == CATEGORIES["finishing"]


def test_player_leaderboard_modes(t):
    by = player_leaderboard(t, t.matches, "finishing", "by_competition_season", players=[10])
    assert rows(by, "competition", "season", "games", "goals") == [("A", "2025", 5, 5.0)]
    home = player_leaderboard(t, t.matches, "finishing", venue="home")
    assert rows(home, "player_id", "club", "games", "goals") == [(10, "Blues,Reds", 3, 3.0), (20, "Blues", 1, 0.0)]
    at_reds = player_leaderboard(t, t.matches, "finishing", teams=[1])
    assert rows(at_reds, "player_id", "club", "games") == [(10, "Reds", 4)]
    forwards = player_leaderboard(t, t.matches, "finishing", positions=["F"])
    assert rows(forwards, "player_id", "position") == [(10, "F")]
    assert rows(player_leaderboard(t, t.matches, "finishing", min_games=3), "player_id") == [(10,)]
    assert rows(player_leaderboard(t, t.matches, "finishing", min_minutes=200), "player_id") == [(10,)]
    per_game = player_leaderboard(t, t.matches, "finishing", calc_mode="per_game")
    assert rows(per_game, "goals", "shot_accuracy_pct")[0] == (1.0, pytest.approx(500 / 11))


def test_zero_denominator_ratio(t):
    board = player_leaderboard(t, t.matches.filter("match_id = 3"), "finishing")
    assert rows(board, "totalShots", "shot_accuracy_pct") == [(0.0, 0.0)]


def test_empty_context_gives_typed_empty_tables(t):
    empty = t.matches.filter("match_id < 0")
    assert player_leaderboard(t, empty, "finishing").count() == 0
    board = club_leaderboard(t, empty, "possession", period="1ST")
    assert board.count() == 0 and "ballPossession" in board.columns
    assert match_records("club", t, empty, "finishing", "goals").count() == 0


def test_club_leaderboard_for_and_against(t):
    mine = club_leaderboard(t, t.matches, "finishing")
    got = {r[0]: r[1:] for r in rows(mine, "team_id", "club", "games", "minutes", "goals", "onTargetScoringAttempt")}
    assert got[1] == ("Reds", 4, 360, 4.0, 4.0)
    assert got[2] == ("Blues", 3, 270, 1.0, 1.0)
    assert got[5] == ("Unknown", 1, 90, 1.0, 0.0)
    conceded = club_leaderboard(t, t.matches, "finishing", perspective="against")
    got = {r[0]: r[1:] for r in rows(conceded, "team_id", "goals", "onTargetScoringAttempt")}
    # The goal of the club on neither side counts against both; official shots swap sides.
    assert got[1] == (2.0, 1.0)
    assert got[2] == (4.0, 4.0)


def test_club_minutes_follow_games_and_venue(t):
    home = club_leaderboard(t, t.matches, "finishing", venue="home")
    got = {r[0]: r[1:] for r in rows(home, "team_id", "games", "goals")}
    assert got[1] == (2, 2.0)
    assert got[2] == (2, 1.0)
    assert 5 not in got


def test_club_half(t):
    half = club_leaderboard(t, t.matches, "finishing", period="1ST")
    assert "goals" not in half.columns and "shot_accuracy_pct" not in half.columns
    got = {r[0]: r[1] for r in rows(half, "team_id", "onTargetScoringAttempt")}
    assert got == {1: 3.0, 2: 0.0}


def test_possession_percentages_are_summed_and_scaled(t):
    total = club_leaderboard(t, t.matches, "possession", teams=[1])
    assert rows(total, "games", "ballPossession") == [(4, 105.0)]
    scaled = club_leaderboard(t, t.matches, "possession", teams=[1], calc_mode="per_game")
    assert rows(scaled, "ballPossession") == [(26.25,)]


def test_club_list_ignores_missing_names(t):
    assert dict(rows(club_lists(t, t.matches))) == {
        10: "Blues,Reds", 20: "Blues", 30: "Greens", 40: "Reds", 50: "Unknown",
    }


# Single games


def test_records(t):
    top = match_records("player", t, t.matches, "finishing", "goals", limit=2)
    assert rows(top, "player", "club", "title", "day", "goals", "minutesPlayed") == [
        ("Ana", "Reds", "Reds vs Blues", "01/03/2025", 2.0, 90.0),
        ("Ana", "Reds", "Blues vs Reds", "02/03/2025", 1.0, 45.0),
    ]
    lowest = match_records("player", t, t.matches, "finishing", "totalShots", order="lowest", limit=3)
    assert rows(lowest, "player", "match_id", "totalShots") == [("Dora", 1, 0.0), ("Bea", 2, 0.0), ("Ana", 3, 0.0)]
    # 50 plays for a club it is not listed for.
    everything = match_records("player", t, t.matches, "finishing", "goals", limit=None)
    assert {r[0] for r in rows(everything, "player_id")} == {10, 20, 30, 40}
    assert everything.count() == 9


def test_records_of_a_metric_the_target_lacks_raise(t):
    with pytest.raises(ValueError, match="ballPossession"):
        match_records("player", t, t.matches, "possession", "ballPossession")


def test_context_filters_apply_by_themselves(t):
    def chosen(**options):
        return {r.match_id for r in X.select_matches(t, **options).select("match_id").collect()}

    everything = chosen()
    assert everything == {r.match_id for r in t.matches.collect()}
    for empty in ({"competitions": []}, {"seasons": []}, {"teams": []}, {"competitions": [], "seasons": [], "teams": []}):
        assert chosen(**empty) == everything
    some = t.tournaments.first()
    in_competition, in_season = chosen(competitions=[some.name]), chosen(seasons=[some.season_year])
    assert 0 < len(in_competition) and 0 < len(in_season)
    assert chosen(competitions=["none"]) == chosen(seasons=["none"]) == set()
    assert chosen(competitions=[some.name], seasons=[some.season_year]) <= in_competition & in_season
    assert chosen(end=date(1900, 1, 1)) == set()
    assert chosen(end=date(2100, 1, 1)) == chosen(start=date(1900, 1, 1), end=date(2100, 1, 1))


def test_a_reversed_order_is_noticed(t):
    board = match_records("player", t, t.matches, "finishing", "goals")
    keys = ["player_id", "match_id"]
    forward = {tuple(r) for r in in_order(board, keys).collect()}
    assert [r[:2] for r in sorted(forward, key=lambda r: r[2])] == [tuple(r) for r in board.select(*keys).collect()]
    turned = match_records("player", t, t.matches, "finishing", "goals", order="lowest")
    assert {tuple(r) for r in in_order(turned, keys).collect()} != forward


def test_club_records_use_player_sums(t):
    top = match_records("club", t, t.matches, "finishing", "onTargetScoringAttempt", limit=1)
    assert rows(top, "club", "match_id", "onTargetScoringAttempt") == [("Reds", 1, 3.0)]


def test_last_games(t):
    last = last_games("player", t, t.matches, "finishing", 2)
    got = [r for r in rows(last, "player_id", "match_id", "day") if r[0] == 10]
    assert got == [(10, 5, "05/03/2025"), (10, 4, "04/03/2025")]
    # Two games on one day: the higher match id is the later one.
    third = [r[1] for r in rows(last_games("player", t, t.matches, "finishing", 3), "player_id", "match_id") if r[0] == 10]
    assert third == [5, 4, 3]
    assert last_games("player", t, t.matches, "finishing", 0).count() == 9
    clubs = last_games("club", t, t.matches, "finishing", 1, teams=[1])
    assert rows(clubs, "match_id", "goals", "onTargetScoringAttempt") == [(4, 1.0, 0.0)]


# Streaks


def test_player_streaks(t):
    got = rows(streaks("player", t, t.matches, "finishing", "goals", ">=", 1))
    # Ana by date and id: hit, hit, miss, hit, hit.
    assert got[0] == (10, "Ana", "Blues", 5, 4, 80.0, 2, 2)
    assert {r[0]: r[3:] for r in got}[20] == (2, 0, 0.0, 0, 0)
    # A metric without a row counts as 0, so "at most" can hit.
    low = {r[0]: r[3:] for r in rows(streaks("player", t, t.matches, "finishing", "goals", "<=", 0))}
    assert low[20] == (2, 2, 100.0, 2, 2)


def test_club_streaks_use_the_calendar(t):
    got = {r[0]: r[2:] for r in rows(streaks("club", t, t.matches, "finishing", "goals", ">=", 1))}
    # Reds finished 1,2,3,4,6,7,(undated 8),10,11; goals in 1,2,4 (ids by date).
    assert got[1] == (9, 3, pytest.approx(100 / 3), 0, 2)
    assert 4 not in got


def test_unknown_choices_are_rejected(t):
    with pytest.raises(ValueError):
        streaks("player", t, t.matches, "finishing", "goals", "~", 1)
    with pytest.raises(ValueError):
        streaks("player", t, t.matches, "possession", "ballPossession")
    with pytest.raises(ValueError):
        match_records("referee", t, t.matches, "finishing", "goals")
    with pytest.raises(ValueError):
        club_leaderboard(t, t.matches, "finishing", venue="moon")


# Comparison


def test_compare_players(t):
    got = {r["metric"]: r for r in compare("player", t, t.matches, 10, 20, "finishing").collect()}
    assert list(got) == CATEGORIES["finishing"]
    goals = got["goals"]
    assert (goals.value_a, goals.value_b, goals.a_best, goals.b_best) == (5.0, 0.0, True, False)
    assert (goals.games_a, goals.minutes_a, goals.games_b, goals.minutes_b) == (5, 345, 2, 180)
    assert got["shot_accuracy_pct"].value_a == pytest.approx(500 / 11)
    assert (got["ownGoals"].a_best, got["ownGoals"].b_best) == (False, False)


def test_compare_shows_metrics_the_target_lacks_and_nothing_for_nobody(t):
    got = {r["metric"]: r for r in compare("player", t, t.matches, 10, 20, "possession").collect()}
    assert got == {}
    other = {r["metric"]: r for r in compare("club", t, t.matches, 1, 2, "possession").collect()}
    assert (other["ballPossession"].value_a, other["ballPossession"].value_b) == (105.0, 95.0)


def test_compare_side_filters(t):
    got = compare("club", t, t.matches, 1, 1, "finishing", a_seasons=["2025"], b_seasons=["2026"])
    goals = [r for r in got.collect() if r.metric == "goals"][0]
    assert (goals.value_a, goals.value_b, goals.games_b) == (4.0, 0.0, 0)


def test_with_without(t):
    split = dict(rows(with_without_split(t, t.matches, 10, 2), "match_id", "played"))
    # An appearance for the other side counts as well.
    assert split == {1: True, 2: True, 5: True, 6: False, 8: False, 10: False}
    impact = with_without(t, t.matches, 20, 2, "finishing")
    goals = [r for r in impact.collect() if r.metric == "goals"][0]
    assert (goals.games_with, goals.games_without) == (2, 1)
    assert (goals.value_with, goals.value_without, goals.without_best) == (0.0, 1.0, True)


def test_context_entities(t):
    got = rows(context_entities(t, t.matches), "team_id", "player_id", "competition", "season", "player", "club")
    assert sorted(got) == [
        (1, 10, "A", "2025", "Ana", "Reds"),
        (1, 40, "A", "2025", "Dora", "Reds"),
        (2, 10, "A", "2025", "Ana", "Blues"),
        (2, 20, "A", "2025", "Bea", "Blues"),
        (3, 30, "A", "2025", "Cleo", "Greens"),
    ]


# Expressions


def test_calc_modes(spark):
    df = spark.createDataFrame([(6.0, 37.5, 4, 270.0), (6.0, 37.5, 0, 0.0)], "goals double, shot_accuracy_pct double, games long, minutes double")
    one = lambda mode: rows(apply_calc_mode(df, ["goals", "shot_accuracy_pct"], mode), "goals", "shot_accuracy_pct")
    assert one("total") == [(6.0, 37.5), (6.0, 37.5)]
    assert one("per_game") == [(1.5, 37.5), (0.0, 37.5)]
    assert one("per_90") == [(2.0, 37.5), (0.0, 37.5)]
    with pytest.raises(ValueError):
        one("per_minute")


def test_ratio_and_best(spark):
    df = spark.createDataFrame([(3.0, 8.0), (0.0, 0.0)], "n double, d double")
    assert rows(df.select(ratio(F.col("n"), F.col("d")))) == [(37.5,), (0.0,)]
    pairs = spark.createDataFrame([("goals", 3.0, 2.0), ("fouls", 3.0, 2.0), ("goals", 1.0, 1.0)], "m string, a double, b double")
    flags = best_flags(F.col("a"), F.col("b"), F.col("m"))
    assert rows(pairs.select(*flags)) == [(True, False), (False, True), (False, False)]


@pytest.mark.parametrize(("op", "hits"), [(">=", [0, 1, 1]), (">", [0, 0, 1]), ("<=", [1, 1, 0]), ("<", [1, 0, 0]), ("=", [0, 1, 0])])
def test_conditions(spark, op, hits):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "v double")
    assert [int(r[0]) for r in df.select(condition(F.col("v"), op, 1)).collect()] == hits


def test_payload_values(spark):
    texts = ["55", "55%", "12/20", None, "12/20 (60%)", "12.5", " 7 ", "12d", "abc"]
    df = spark.createDataFrame([(x,) for x in texts], "v string")
    assert [r[0] for r in df.select(percent_value(F.col("v"))).collect()] == [55.0, 55.0, 0.0, None, None, 12.5, 7.0, 0.0, 0.0]
    stats = [None, "true", "false", "7", '{"x":1}', "[1]", "abc"]
    df = spark.createDataFrame([(x,) for x in stats], "v string")
    assert [r[0] for r in df.select(stat_value(F.col("v"))).collect()][:4] == [0.0, 1.0, 0.0, 7.0]
    assert [r[0] for r in df.select(is_scalar(F.col("v"))).collect()] == [True, True, True, True, False, False, True]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_match_dates_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["1700000000", "2024-01-02T03:04:05", "2024-01-02T03:04:05+02:00", "2024-01-02", "soon", None]
        df = spark.createDataFrame([(x,) for x in texts], "v string")
        assert [r[0] for r in df.select(match_date(F.col("v"))).collect()] == [
            datetime(2023, 11, 14, 22, 13, 20),
            datetime(2024, 1, 2, 3, 4, 5),
            datetime(2024, 1, 2, 1, 4, 5),
            datetime(2024, 1, 2),
            None,
            None,
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_camel_case(spark):
    df = spark.createDataFrame([("expectedGoalsOnTargetX",), ("fouls",)], "k string")
    assert rows(df.select(split_camel_case(F.col("k")))) == [("Expected Goals On Target X",), ("Fouls",)]


# Keyed tables


def test_upsert_and_replace(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    new = spark.createDataFrame([(2, "c"), (2, "d"), (3, "e")], "id long, name string")
    assert sorted(rows(upsert(old, new, ["id"], [F.desc("name")]))) == [(1, "a"), (2, "d"), (3, "e")]
    facts = spark.createDataFrame([(1, 1.0), (2, 2.0)], "match_id long, v double")
    more = spark.createDataFrame([(2, 5.0), (2, 6.0)], "match_id long, v double")
    fetched = spark.createDataFrame([(2,), (2,), (7,)], "match_id long")
    assert sorted(rows(replace_by_match(facts, more, fetched))) == [(1, 1.0), (2, 5.0), (2, 6.0)]
    assert ids(not_loaded(fetched, facts)) == [7]


def test_dedup(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k long, v string")
    assert sorted(rows(keep_first(df, ["k"], ["v"]))) == [(1, "a"), (2, "c")]
    assert sorted(rows(unique_dimension(df, ["k"]))) == [(1, "a"), (2, "c")]
