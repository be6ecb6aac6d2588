"""The metric registry: which fact and key holds each metric, and what the categories show."""

from __future__ import annotations

from typing import NamedTuple

from matchstats.schema import MINUTES


class Metric(NamedTuple):
    label: str
    key: str
    match_key: str | None
    source: str
    group: str


class MetricSource(NamedTuple):
    """Where one output column comes from."""

    metric: str
    key: str
    source: str


# Metric label, player-fact key, match-fact key, source and group, in display order.
METRICS = [
    Metric("Gols", "goals", None, "player", "attack"),
    Metric("xG (Gols Esperados)", "expectedGoals", "expectedGoals", "player", "attack"),
    Metric("Finalizações Totais", "totalShots", None, "player", "attack"),
    Metric("Finalizações no Alvo", "onTargetScoringAttempt", "shotsOnGoal", "player", "attack"),
    Metric("Chutes pra Fora", "shotOffTarget", "shotsOffGoal", "player", "attack"),
    Metric("Chutes Bloqueados", "blockedScoringAttempt", "blockedScoringAttempt", "player", "attack"),
    Metric("Na Trave", "hitWoodwork", "hitWoodwork", "player", "attack"),
    Metric("Grandes Chances Perdidas", "bigChanceMissed", "bigChanceMissed", "player", "attack"),
    Metric("Grandes Chances Convertidas", "bigChanceScored", "bigChanceScored", "player", "attack"),
    Metric("xGoT (No Alvo)", "expectedGoalsOnTarget", None, "player", "attack"),
    Metric("Pênalti Sofrido", "penaltyWon", None, "player", "attack"),
    Metric("Finalizações (Dentro da Área)", "totalShotsInsideBox", None, "match", "attack"),
    Metric("Finalizações (Fora da Área)", "totalShotsOutsideBox", None, "match", "attack"),
    Metric("Assistências", "goalAssist", None, "player", "creation"),
    Metric("xA (Assistências Esperadas)", "expectedAssists", None, "player", "creation"),
    Metric("Grandes Chances Criadas", "bigChanceCreated", "bigChanceCreated", "player", "creation"),
    Metric("Passes Decisivos", "keyPass", None, "player", "creation"),
    Metric("Entradas no Terço Final", "finalThirdEntries", None, "match", "creation"),
    Metric("Ações no Terço Final (Certas)", "finalThirdPhaseStatistic", None, "match", "creation"),
    Metric("Ações no Terço Final (Total)", "finalThirdPhaseStatisticTotal", None, "match", "creation"),
    Metric("Passes Certos", "accuratePass", "accuratePasses", "player", "distribution"),
    Metric("Passes Totais", "totalPass", "passes", "player", "distribution"),
    Metric("Bolas Longas Certas", "accurateLongBalls", "accurateLongBalls", "player", "distribution"),
    Metric("Bolas Longas Totais", "totalLongBalls", "accurateLongBallsTotal", "player", "distribution"),
    Metric("Cruzamentos Certos", "accurateCross", "accurateCross", "player", "distribution"),
    Metric("Cruzamentos Totais", "totalCross", "accurateCrossTotal", "player", "distribution"),
    Metric("Passes em Profundidade Certos", "accurateThroughBall", "accurateThroughBall", "player", "distribution"),
    Metric("Passes Certos Campo Rival", "accurateOppositionHalfPasses", None, "player", "distribution"),
    Metric("Passes Totais Campo Rival", "totalOppositionHalfPasses", None, "player", "distribution"),
    Metric("Passes Certos Campo Defesa", "accurateOwnHalfPasses", None, "player", "distribution"),
    Metric("Laterais", "throwIns", None, "match", "distribution"),
    Metric("Desarmes Totais", "totalTackle", "totalTackle", "player", "defence"),
    Metric("Desarmes Certos", "wonTackle", None, "player", "defence"),
    Metric("Interceptações", "interceptionWon", "interceptionWon", "player", "defence"),
    Metric("Cortes", "totalClearance", "totalClearance", "player", "defence"),
    Metric("Cortes na Linha", "clearanceOffLine", None, "player", "defence"),
    Metric("Bloqueios", "outfielderBlock", None, "player", "defence"),
    Metric("Bolas Recuperadas", "ballRecovery", "ballRecovery", "player", "defence"),
    Metric("Dribles Sofridos", "challengeLost", None, "player", "defence"),
    Metric("Gols Evitados", "goalsPrevented", "goalsPrevented", "player", "goalkeeping"),
    Metric("Sem Sofrer Gols", "cleanSheet", None, "match", "defence"),
    Metric("Gols Contra", "ownGoals", None, "player", "defence"),
    Metric("Erro Capital (Gol)", "errorLeadToAGoal", "errorsLeadToGoal", "player", "defence"),
    Metric("Erro Capital (Chute)", "errorLeadToAShot", "errorsLeadToShot", "player", "defence"),
    Metric("Pênalti Cometido", "penaltyConceded", None, "player", "defence"),
    Metric("Dribles Certos", "wonContest", None, "player", "duels"),
    Metric("Dribles Totais", "totalContest", None, "player", "duels"),
    Metric("Duelos Ganhos", "duelWon", None, "player", "duels"),
    Metric("Duelos Perdidos", "duelLost", None, "player", "duels"),
    Metric("Duelos no Chão Totais", "groundDuelsPercentageTotal", None, "match", "duels"),
    Metric("Duelos Aéreos Ganhos", "aerialWon", None, "player", "duels"),
    Metric("Duelos Aéreos Perdidos", "aerialLost", None, "player", "duels"),
    Metric("Duelos Aéreos Totais", "aerialDuelsPercentageTotal", None, "match", "duels"),
    Metric("Desarmado", "dispossessed", "dispossessed", "player", "duels"),
    Metric("Defesas", "saves", "goalkeeperSaves", "player", "goalkeeping"),
    Metric("Socos", "punches", "punches", "player", "goalkeeping"),
    Metric("Defesas Aéreas", "highClaims", None, "match", "goalkeeping"),
    Metric("Saídas Líbero Certas", "accurateKeeperSweeper", None, "player", "goalkeeping"),
    Metric("Pênaltis Defendidos", "penaltySave", "penaltySaves", "player", "goalkeeping"),
    Metric("Defesas Difíceis", "diveSaves", "diveSaves", "player", "goalkeeping"),
    Metric("Defesas Dentro da Área", "savedShotsFromInsideTheBox", None, "player", "goalkeeping"),
    Metric("Posse de Bola (%)", "ballPossession", None, "match", "general"),
    Metric("Ações com a Bola", "touches", None, "player", "general"),
    Metric("Toques na Área Rival", "touchesInOppBox", None, "player", "general"),
    Metric("Perda de Posse", "possessionLostCtrl", None, "player", "general"),
    Metric("Domínios Errados", "unsuccessfulTouch", None, "player", "general"),
    Metric("Conduções", "ballCarriesCount", None, "player", "general"),
    Metric("Conduções Progressivas", "progressiveBallCarriesCount", None, "player", "general"),
    Metric("Faltas Cometidas", "fouls", "fouls", "player", "discipline"),
    Metric("Faltas Sofridas", "wasFouled", None, "player", "discipline"),
    Metric("Cartões Amarelos", "yellowCards", "yellowCards", "player", "discipline"),
    Metric("Cartões Vermelhos", "redCards", "redCards", "player", "discipline"),
    Metric("Impedimentos", "totalOffside", "offsides", "player", "discipline"),
    Metric("Escanteios", "cornerKicks", None, "match", "discipline"),
    Metric("Tiros de Meta", "goalKicks", None, "match", "discipline"),
    Metric("Nota", "rating", None, "player", "index"),
]

# Metrics and ratios of each category in display order; the first one sorts its board.
CATEGORIES = {
    "finishing": [
        "goals", "expectedGoals", "totalShots", "onTargetScoringAttempt", "shot_accuracy_pct",
        "expectedGoalsOnTarget", "bigChanceScored", "bigChanceMissed", "shotOffTarget",
        "blockedScoringAttempt", "hitWoodwork", "penaltyWon", "ownGoals",
    ],
    "passing": [
        "goalAssist", "expectedAssists", "bigChanceCreated", "keyPass", "totalPass", "accuratePass",
        "pass_accuracy_pct", "totalOppositionHalfPasses", "accurateOppositionHalfPasses",
        "opp_half_pass_pct", "accurateOwnHalfPasses", "accurateThroughBall", "totalLongBalls",
        "accurateLongBalls", "long_ball_pct", "totalCross", "accurateCross", "cross_pct",
    ],
    "possession": [
        "ballPossession", "touches", "touchesInOppBox", "ballCarriesCount",
        "progressiveBallCarriesCount", "unsuccessfulTouch", "possessionLostCtrl", "wasFouled",
        "totalOffside",
    ],
    "duels": [
        "duelWon", "duelLost", "duel_won_pct", "aerialWon", "aerialLost", "aerial_won_pct",
        "totalContest", "wonContest", "dribble_pct", "challengeLost", "dispossessed",
    ],
    "defence": [
        "totalTackle", "wonTackle", "tackle_pct", "interceptionWon", "ballRecovery",
        "totalClearance", "clearanceOffLine", "outfielderBlock", "errorLeadToAGoal",
        "errorLeadToAShot", "penaltyConceded", "fouls",
    ],
    "goalkeeping": [
        "saves", "diveSaves", "savedShotsFromInsideTheBox", "punches", "accurateKeeperSweeper",
        "penaltySave", "goalsPrevented",
    ],
}

# Ratio -> (numerator, terms summed for the denominator).
RATIOS = {
    "shot_accuracy_pct": ("onTargetScoringAttempt", ("totalShots",)),
    "pass_accuracy_pct": ("accuratePass", ("totalPass",)),
    "long_ball_pct": ("accurateLongBalls", ("totalLongBalls",)),
    "cross_pct": ("accurateCross", ("totalCross",)),
    "opp_half_pass_pct": ("accurateOppositionHalfPasses", ("totalOppositionHalfPasses",)),
    "dribble_pct": ("wonContest", ("totalContest",)),
    "tackle_pct": ("wonTackle", ("totalTackle",)),
    "duel_won_pct": ("duelWon", ("duelWon", "duelLost")),
    "aerial_won_pct": ("aerialWon", ("aerialWon", "aerialLost")),
}

# Metrics for which the lower of two values is the better one.
LOWER_IS_BETTER = (
    "challengeLost", "ownGoals", "errorLeadToAGoal", "errorLeadToAShot", "penaltyConceded",
    "duelLost", "aerialLost", "dispossessed", "possessionLostCtrl", "unsuccessfulTouch", "fouls",
    "yellowCards", "redCards", "totalOffside", "bigChanceMissed",
)

BY_KEY = {m.key: m for m in METRICS}
BY_LABEL = {m.label: m for m in METRICS}


def resolve(metric: str, prefer_match: bool = False) -> MetricSource:
    """Fact and key of a metric; club boards prefer the official match-level key if there is one."""
    entry = BY_KEY[metric]
    if prefer_match and entry.match_key:
        return MetricSource(metric, entry.match_key, "match")
    return MetricSource(metric, entry.key, entry.source)


def plain_metrics(category: str) -> list[str]:
    """The category's metrics without its ratios."""
    return [m for m in CATEGORIES[category] if m not in RATIOS]


def player_sources(category: str) -> list[MetricSource]:
    """Player tables know only player-fact metrics."""
    sources = [resolve(m) for m in plain_metrics(category)]
    return [s for s in sources if s.source == "player"]


def club_sources(category: str, prefer_match: bool, period: str = "ALL") -> list[MetricSource]:
    """Club tables mix both facts; a half has match-fact metrics only."""
    sources = [resolve(m, prefer_match) for m in plain_metrics(category)]
    if period != "ALL":
        sources = [s for s in sources if s.source == "match"]
    return sources


def columns_for(category: str, metrics: list[str]) -> list[str]:
    """Output columns in display order: the given metrics and each ratio whose terms are all there."""
    have = set(metrics)
    shown = []
    for name in CATEGORIES[category]:
        if name in RATIOS:
            numerator, terms = RATIOS[name]
            if {numerator, *terms} <= have:
                shown.append(name)
        elif name in have:
            shown.append(name)
    if MINUTES in have:
        shown.append(MINUTES)
    return shown
