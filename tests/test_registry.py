from matchstats import registry as R


def test_counts():
    assert len(R.METRICS) == 76
    assert sum(m.source == "player" for m in R.METRICS) == 63
    assert sum(m.source == "match" for m in R.METRICS) == 13
    assert sum(m.match_key is not None for m in R.METRICS) == 31
    assert [len(c) for c in R.CATEGORIES.values()] == [13, 18, 9, 11, 12, 7]
    assert len(R.RATIOS) == 9
    assert len(R.LOWER_IS_BETTER) == 15
    assert len(R.BY_LABEL) == 76


def test_every_shown_metric_is_known():
    shown = {m for c in R.CATEGORIES.values() for m in c}
    assert shown <= set(R.BY_KEY) | set(R.RATIOS)


def test_clubs_prefer_official_numbers_players_do_not():
    assert R.resolve("onTargetScoringAttempt") == ("onTargetScoringAttempt", "onTargetScoringAttempt", "player")
    assert R.resolve("onTargetScoringAttempt", prefer_match=True) == (
        "onTargetScoringAttempt",
        "shotsOnGoal",
        "match",
    )
    assert R.resolve("goals", prefer_match=True) == ("goals", "goals", "player")


def test_match_metrics_are_no_player_metrics():
    assert "ballPossession" not in [s.metric for s in R.player_sources("possession")]
    assert "ballPossession" in [s.metric for s in R.club_sources("possession", True)]


def test_a_half_has_official_metrics_only_and_no_ratio_without_its_terms():
    sources = R.club_sources("passing", True, "1ST")
    assert all(s.source == "match" for s in sources)
    columns = R.columns_for("passing", [s.metric for s in sources])
    assert "pass_accuracy_pct" in columns
    assert "opp_half_pass_pct" not in columns
    assert R.columns_for("finishing", [s.metric for s in R.club_sources("finishing", True, "2ND")]).count("shot_accuracy_pct") == 0


def test_minutes_come_last():
    assert R.columns_for("goalkeeping", ["saves", "minutesPlayed"]) == ["saves", "minutesPlayed"]
