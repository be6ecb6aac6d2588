"""Display names of raw metric keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchstats.functions.values import split_camel_case

# Display name of each raw metric key.
METRIC_NAMES = {
    "goals": "Gols",
    "goalAssist": "Assistências",
    "totalShots": "Finalizações",
    "shotsOnTarget": "Chutes no Gol",
    "shotsOffTarget": "Chutes pra Fora",
    "blockedShots": "Chutes Bloqueados",
    "totalPass": "Passes Totais",
    "accuratePass": "Passes Certos",
    "keyPass": "Passes Decisivos",
    "totalLongBalls": "Bolas Longas",
    "accurateLongBalls": "Bolas Longas Certas",
    "totalCross": "Cruzamentos",
    "accurateCross": "Cruzamentos Certos",
    "totalContest": "Dribles Totais",
    "wonContest": "Dribles Certos",
    "bigChanceCreated": "Grandes Chances Criadas",
    "bigChanceMissed": "Grandes Chances Perdidas",
    "duelWon": "Duelos Ganhos",
    "duelLost": "Duelos Perdidos",
    "aerialWon": "Duelos Aéreos Ganhos",
    "aerialLost": "Duelos Aéreos Perdidos",
    "interceptionWon": "Interceptações",
    "totalTackle": "Desarmes",
    "wonTackle": "Desarmes Certos",
    "totalClearance": "Cortes",
    "errorLeadToGoal": "Erro Capital (Gol)",
    "errorLeadToShot": "Erro Capital (Chute)",
    "wasFouled": "Sofreu Falta",
    "fouls": "Cometeu Falta",
    "minutesPlayed": "Minutos Jogados",
    "touches": "Ações com a Bola",
    "rating": "Nota",
    "possessionLostCtrl": "Perda de Posse",
    "expectedGoals": "xG (Gols Esperados)",
    "expectedAssists": "xA (Assistências Esperadas)",
    "challengeLost": "Dribles Sofridos",
    "dispossessed": "Desarmado",
    "onTargetScoringAttempt": "Chutes no Alvo",
    "hitWoodwork": "Na Trave",
    "penaltyWon": "Pênalti Sofrido",
    "penaltyConceded": "Pênalti cometido",
    "saves": "Defesas de Goleiro",
    "punches": "Socos (Goleiro)",
    "claim": "Saídas do Gol",
    "cleanSheet": "Sem Sofrer Gols",
    "runsOut": "Saídas do Gol (Líbero)",
    "successfulRunsOut": "Saídas Certas",
    "highClaims": "Defesas Aéreas",
    "crossesNotClaimed": "Cruzamentos Não Cortados",
    "ballPossession": "Posse de Bola",
    "cornerKicks": "Escanteios",
    "freeKicks": "Faltas",
    "goalKicks": "Tiros de Meta",
    "offsides": "Impedimentos",
    "ownGoals": "Gols Contra",
    "passes": "Passes",
    "redCards": "Cartões Vermelhos",
    "throwIns": "Laterais",
    "yellowCards": "Cartões Amarelos",
    "goalsPrevented": "Gols Evitados",
    "accuratePasses": "Passes Certos",
    "shotOffTarget": "Chutes pra Fora",
    "shotsOnGoal": "Chutes no Gol",
    "totalShotsOnGoal": "Finalizações no Gol",
    "totalShotsInsideBox": "Finalizações (Dentro da Área)",
    "totalShotsOutsideBox": "Finalizações (Fora da Área)",
    "diveSaves": "Defesas Difíceis",
    "goalkeeperSaves": "Defesas de Goleiro",
    "goodHighClaim": "Defesas Aéreas",
    "penaltySave": "Pênaltis Defendidos",
    "penaltyFaced": "Pênaltis Enfrentados",
    "savedShotsFromInsideTheBox": "Defesas (Dentro da Área)",
    "ballRecovery": "Bolas Recuperadas",
    "bigChanceScored": "Grandes Chances Convertidas",
    "clearanceOffLine": "Cortes em Cima da Linha",
    "lastManTackle": "Desarme (Último Homem)",
    "penaltyMiss": "Pênaltis Perdidos",
    "totalOffside": "Impedimentos",
    "touchesInOppBox": "Toques na Área Rival",
    "aerialDuelsPercentage": "Duelos Aéreos Ganhos (%)",
    "groundDuelsPercentage": "Duelos no Chão Ganhos (%)",
    "dribblesPercentage": "Dribles Certos (%)",
    "wonTacklePercent": "Desarmes Certos (%)",
    "expectedGoalsOnTarget": "xGoT (Gols Esperados no Alvo)",
    "finalThirdEntries": "Entradas no Terço Final",
    "ballCarriesCount": "Conduções",
    "progressiveBallCarriesCount": "Conduções Progressivas",
    "accurateCrossTotal": "Cruzamentos Certos (Total)",
    "accurateKeeperSweeper": "Saídas Certas (Líbero)",
    "accurateLongBallsTotal": "Bolas Longas Certas (Total)",
    "accurateOppositionHalfPasses": "Passes Certos Campo Rival",
    "accurateOwnHalfPasses": "Passes Certos Campo Defesa",
    "accurateThroughBall": "Passes em Profundidade Certos",
    "aerialDuelsPercentageTotal": "Duelos Aéreos Total",
    "bestBallCarryProgression": "Melhor Condução (Distância)",
    "blockedScoringAttempt": "Chutes Bloqueados (2)",
    "crossNotClaimed": "Cruzamentos Não Cortados (2)",
    "defensiveValueNormalized": "Valor Defensivo (Norm)",
    "dribbleValueNormalized": "Valor Drible (Norm)",
    "dribblesPercentageTotal": "Dribles Certos Total (%)",
    "duelWonPercent": "Duelos Ganhos (%)",
    "errorLeadToAGoal": "Erro Capital (Gol) (2)",
    "errorLeadToAShot": "Erro Capital (Chute) (2)",
    "errorsLeadToGoal": "Erros Capital (Gol)",
    "errorsLeadToShot": "Erros Capital (Chute)",
    "finalThirdPhaseStatistic": "Ações Terço Final",
    "finalThirdPhaseStatisticTotal": "Ações Terço Final (Total)",
    "fouledFinalThird": "Sofreu Falta (Terço Final)",
    "goalkeeperValueNormalized": "Valor Goleiro (Norm)",
    "groundDuelsPercentageTotal": "Duelos Chão Total",
    "keeperSaveValue": "Valor Defesas",
    "outfielderBlock": "Bloqueios (Linha)",
    "passValueNormalized": "Valor Passe (Norm)",
    "penaltySaves": "Pênaltis Defendidos (2)",
    "shotValueNormalized": "Valor Chute (Norm)",
    "shotsOffGoal": "Chutes pra Fora (2)",
    "totalBallCarriesDistance": "Distância Conduzida Total",
    "totalKeeperSweeper": "Saídas Líbero (Total)",
    "totalOppositionHalfPasses": "Passes Campo Rival",
    "totalOwnHalfPasses": "Passes Campo Defesa",
    "totalProgression": "Progressão Total",
    "totalProgressiveBallCarriesDistance": "Distância Condução Progressiva",
    "unsuccessfulTouch": "Domínios Errados",
    "wonTacklePercentTotal": "Desarmes Certos Total (%)",
}


def with_metric_name(df: DataFrame) -> DataFrame:
    """Add ``metric_name`` for ``metric_key``: the fixed name, else the key split into words.

    The broadcast side is the constant above, so its size does not depend on the data.
    """
    names = df.sparkSession.createDataFrame(
        list(METRIC_NAMES.items()), "metric_key string, fixed_name string"
    )
    return (
        df.join(F.broadcast(names), "metric_key", "left")
        .withColumn("metric_name", F.coalesce("fixed_name", split_camel_case(F.col("metric_key"))))
        .drop("fixed_name")
    )
