"""The match model bound to orders-like tables (FIXTURES §3), for tests, checks and the benchmark.

A match is an order, the home side is the customer's nation and a stat line is a line item.  Each
fact is one pass over the line items: the metric rows of a line are generated side by side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchstats.session import BYTES_EACH
from matchstats.sources import storage
from matchstats.sources.tables import StatsTables

#: The tables that the match model is bound to.
BOUND = ("region", "nation", "customer", "orders", "lineitem")


def bound_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Stored size of the tables that the match model is bound to."""
    return sum(storage.size(spark, f"{sf_dir}/{name}.parquet") for name in BOUND)


def bound_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    key, month = F.col("o_orderkey"), F.month("o_orderdate")
    region = F.col("n_regionkey")
    matches = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == nation.n_nationkey)
        .select(
            key.cast("bigint").alias("match_id"),
            F.when(key % 97 == 0, 99).otherwise(region).cast("bigint").alias("tournament_id"),
            (F.year("o_orderdate") * 10 + region).cast("bigint").alias("season_id"),
            F.when(month >= 11, month + 15).otherwise(month).cast("int").alias("round_id"),
            F.when(month == 11, "Semifinal").when(month == 12, "Final").alias("round_name"),
            F.col("c_nationkey").cast("bigint").alias("home_team_id"),
            ((F.col("c_nationkey") + 1 + key % 24) % 25).cast("bigint").alias("away_team_id"),
            F.col("o_orderdate").alias("match_date"),
            F.when(F.col("o_orderstatus") == "F", 100)
            .when(F.col("o_orderstatus") == "O", 110)
            .otherwise(60)
            .alias("status_code"),
        )
    )
    for side in ("home", "away"):
        names = nation.select(
            F.col("n_nationkey").cast("bigint").alias(f"{side}_team_id"),
            F.col("n_name").alias(f"{side}_team_name"),
        )
        matches = matches.join(names, f"{side}_team_id")
    return matches


def bound_lines(spark: SparkSession, sf_dir: str, matches: DataFrame) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    is_home = F.col("l_linenumber") % 2 == 1
    team = F.when(is_home, F.col("home_team_id")).otherwise(F.col("away_team_id"))
    supplier = F.col("l_suppkey")
    return lineitem.join(
        matches.select("match_id", "home_team_id", "away_team_id"),
        F.col("l_orderkey") == F.col("match_id"),
    ).select(
        "match_id",
        F.when(is_home, "home").otherwise("away").alias("side"),
        team.alias("team_id"),
        F.when(supplier % 10 == 0, supplier + 9000)
        .otherwise(team * 100 + supplier % 20)
        .alias("player_id"),
        F.col("l_quantity").alias("q"),
        F.col("l_discount").alias("disc"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_returnflag").alias("rf"),
        F.col("l_linestatus").alias("ls"),
    )


def _metric_rows(rows: dict[str, tuple]) -> Column:
    """Array of (metric_key, value) with NULL entries where a metric does not apply."""
    return F.array(
        *[
            F.when(
                applies, F.struct(F.lit(k).alias("metric_key"), v.cast("double").alias("value"))
            )
            for k, (applies, v) in rows.items()
        ]
    )


def bound_player_stats(lines: DataFrame) -> DataFrame:
    q, disc, always = F.col("q"), F.col("disc"), F.lit(True)
    rows = {
        "minutesPlayed": (always, F.least(q * 2, F.lit(90))),
        "goals": (F.col("rf") == "R", F.lit(1)),
        "totalShots": (always, F.floor(q / 5)),
        "onTargetScoringAttempt": (always, F.floor(q / 12)),
        "expectedGoals": (disc > 0, disc),
        "totalPass": (always, q),
        "accuratePass": (always, F.floor(q * (1 - disc))),
        "duelWon": (always, F.col("ln")),
        "duelLost": (always, 7 - F.col("ln")),
    }
    return (
        lines.select("match_id", "player_id", "team_id", F.explode(_metric_rows(rows)).alias("stat"))
        .filter(F.col("stat").isNotNull())
        .select("match_id", "player_id", "team_id", "stat.metric_key", "stat.value")
    )


def bound_match_stats(lines: DataFrame) -> DataFrame:
    q, disc = F.col("q"), F.col("disc")
    measures = {
        "shotsOnGoal": F.floor(q / 12),
        "passes": q,
        "accuratePasses": F.floor(q * (1 - disc)),
    }
    periods = {"ALL": F.lit(True), "1ST": F.col("ls") == "F", "2ND": F.col("ls") == "O"}
    side_sums = [
        F.sum(F.when(within & (F.col("side") == side), value.cast("double")).otherwise(0.0)).alias(
            f"{period}_{key}_{side}"
        )
        for period, within in periods.items()
        for key, value in measures.items()
        for side in ("home", "away")
    ]
    counts = [F.count(F.when(within, 1)).alias(f"{p}_lines") for p, within in periods.items()]
    wide = lines.groupBy("match_id").agg(*counts, *side_sums)
    rows = F.array(
        *[
            F.when(
                F.col(f"{period}_lines") > 0,
                F.struct(
                    F.lit(period).alias("period"),
                    F.lit(key).alias("metric_key"),
                    F.col(f"{period}_{key}_home").alias("home_value"),
                    F.col(f"{period}_{key}_away").alias("away_value"),
                ),
            )
            for period in periods
            for key in measures
        ]
    )
    return (
        wide.select("match_id", F.explode(rows).alias("stat"))
        .filter(F.col("stat").isNotNull())
        .select("match_id", "stat.*")
    )


def bound_players(lines: DataFrame) -> DataFrame:
    pid = F.col("player_id")
    position = (
        F.when(pid % 13 == 0, F.lit(None))
        .when(pid % 4 == 0, "G")
        .when(pid % 4 == 1, "D")
        .when(pid % 4 == 2, "M")
        .otherwise("F")
    )
    return (
        lines.filter(~((pid >= 9000) & (F.col("team_id") % 5 == 0)))
        .select("player_id", "team_id")
        .distinct()
        .select(
            "player_id",
            "team_id",
            F.concat(F.lit("PLAYER_"), pid.cast("string")).alias("name"),
            position.alias("position"),
        )
    )


def bind(spark: SparkSession, sf_dir: str) -> StatsTables:
    """All six tables over the whole of the given data."""
    matches = bound_matches(spark, sf_dir)
    lines = bound_lines(spark, sf_dir, matches)
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    seasons = matches.select("tournament_id", "season_id", F.year("match_date").alias("year")).distinct()
    return StatsTables(
        tournaments=seasons.join(region, F.col("r_regionkey") == F.col("tournament_id")).select(
            F.col("tournament_id").alias("unique_tournament_id"),
            "season_id",
            F.col("r_name").alias("name"),
            F.col("year").cast("string").alias("season_year"),
        ),
        clubs=nation.filter("n_nationkey <> 24").select(
            F.col("n_nationkey").cast("bigint").alias("team_id"), F.col("n_name").alias("name")
        ),
        matches=matches,
        players=bound_players(lines),
        match_stats=bound_match_stats(lines),
        player_stats=bound_player_stats(lines),
    )


def lineup_payloads(lines: DataFrame) -> DataFrame:
    """A lineups payload (JSON text) per match: the player of each line item on its side, with statistics."""
    q, disc = F.col("q"), F.col("disc")
    statistics = F.struct(
        F.least(q * 2, F.lit(90)).alias("minutesPlayed"),
        F.when(F.col("rf") == "R", 1).alias("goals"),
        F.floor(q / 5).alias("totalShots"),
        F.floor(q / 12).alias("onTargetScoringAttempt"),
        F.when(disc > 0, disc).alias("expectedGoals"),
        q.alias("totalPass"),
        F.floor(q * (1 - disc)).alias("accuratePass"),
        F.col("ln").alias("duelWon"),
        (7 - F.col("ln")).alias("duelLost"),
        (F.col("ln") == 1).alias("captain"),
        F.struct(q.alias("original")).alias("ratingVersions"),
    )
    name = F.concat(F.lit("PLAYER_"), F.col("player_id").cast("string"))
    player = F.struct(
        F.col("player_id").alias("id"),
        name.alias("name"),
        F.struct(F.lit(7500000.0).alias("value")).alias("proposedMarketValueRaw"),
    )
    listed = F.struct(F.lit("M").alias("position"), player.alias("player"), statistics.alias("statistics"))

    def side(name: str) -> Column:
        """The players on a side; none where the match has no line of it."""
        players = F.collect_list(F.when(F.col("side") == name, listed))
        return F.when(F.size(players) > 0, F.struct(players.alias("players"))).alias(name)

    documents = lines.groupBy("match_id").agg(side("home"), side("away"))
    return documents.select(F.to_json(F.struct("match_id", "home", "away")).alias("body"))


def statistics_payloads(match_stats: DataFrame) -> DataFrame:
    """A statistics payload per match: its periods, in each a group of passing and one of other items;
    percentages for one metric, totals for another."""
    key, home, away = F.col("metric_key"), F.col("home_value"), F.col("away_value")
    is_percent = key == "accuratePasses"

    def text(value: Column) -> Column:
        percent = F.concat(value.cast("int").cast("string"), F.lit("%"))
        return F.when(is_percent, percent).otherwise(value.cast("string"))

    item = F.struct(
        key.alias("key"),
        text(home).alias("homeValue"),
        text(away).alias("awayValue"),
        F.when(key == "passes", home + away).alias("homeTotal"),
    )
    passing = key.isin("passes", "accuratePasses")
    groups = F.array(
        F.struct(F.collect_list(F.when(passing, item)).alias("statisticsItems")),
        F.struct(F.collect_list(F.when(~passing, item)).alias("statisticsItems")),
    )
    periods = match_stats.groupBy("match_id", "period").agg(groups.alias("groups"))
    documents = periods.groupBy("match_id").agg(F.collect_list(F.struct("period", "groups")).alias("statistics"))
    return documents.select(F.to_json(F.struct("match_id", "statistics")).alias("body"))


def epoch_seconds() -> Column:
    """Seconds of ``match_date`` as UTC wall-clock time, whatever the session's time zone."""
    since = "match_date - TIMESTAMP_NTZ '1970-01-01 00:00:00'"
    return F.expr(f"CAST(CAST({since} AS INTERVAL SECOND) AS BIGINT)")


def event_payloads(matches: DataFrame, tournaments: DataFrame, files: int | None = None) -> DataFrame:
    """An events payload per match; with ``files``, the matches are dealt out before their texts are made."""
    names = tournaments.select(
        F.col("unique_tournament_id").alias("tournament_id"), "season_id", "name", "season_year"
    )

    def team(side: str) -> Column:
        return F.struct(
            F.col(f"{side}_team_id").alias("id"),
            F.col(f"{side}_team_name").alias("name"),
            F.lit(False).alias("disabled"),
            F.lit(True).alias("national"),
        )

    unique = F.struct(F.col("tournament_id").alias("id"), F.col("name").alias("name"))
    event = F.struct(
        F.col("match_id").alias("id"),
        epoch_seconds().alias("startTimestamp"),
        F.struct(unique.alias("uniqueTournament")).alias("tournament"),
        F.struct(F.col("season_id").alias("id"), F.col("season_year").alias("year")).alias("season"),
        F.struct(F.col("round_id").alias("round"), F.col("round_name").alias("name")).alias("roundInfo"),
        F.struct(F.col("status_code").alias("code")).alias("status"),
        team("home").alias("homeTeam"),
        team("away").alias("awayTeam"),
    )
    body = F.struct("tournament_id", "season_id", F.array(event).alias("events"))
    named = matches.join(names, ["tournament_id", "season_id"], "left")
    return (named.repartition(files, "match_id") if files else named).select(F.to_json(body).alias("body"))


def rounds_payloads(matches: DataFrame, tournaments: DataFrame) -> DataFrame:
    """A rounds payload per known competition season; made unique before they are gathered."""
    rounds = matches.select(
        "tournament_id", "season_id", F.col("round_id").alias("round"), F.col("round_name").alias("name")
    ).distinct()
    known = tournaments.select(F.col("unique_tournament_id").alias("tournament_id"), "season_id")
    listed = (
        rounds.join(known, ["tournament_id", "season_id"], "left_semi")
        .groupBy("tournament_id", "season_id")
        .agg(F.collect_list(F.struct("round", "name")).alias("rounds"))
    )
    return listed.select(F.to_json(F.struct("*")).alias("body"))


def land(spark: SparkSession, sf_dir: str, landing: str, cut_short: Column | None = None) -> StatsTables:
    """Write the payloads of all bound tables as landed JSON files, several of each kind, more of a larger
    input; they are compressed.  Lineups for which ``cut_short`` (of ``body``) holds lose their second half.

    Matches are dealt to files before their texts are made, so that no text is shuffled.
    """
    files = max(6, bound_bytes(spark, sf_dir) // BYTES_EACH)
    tables = bind(spark, sf_dir)
    lines = bound_lines(spark, sf_dir, tables.matches).repartition(files, "match_id")
    payloads = {
        "events": event_payloads(tables.matches, tables.tournaments, files),
        "lineups": lineup_payloads(lines),
        "statistics": statistics_payloads(bound_match_stats(lines)),
    }
    if cut_short is not None:
        half = F.expr("substring(body, 1, int(length(body) / 2))")
        payloads["lineups"] = payloads["lineups"].select(F.when(cut_short, half).otherwise(F.col("body")).alias("body"))
    for kind, rows in payloads.items():
        rows.write.option("compression", "gzip").text(f"{landing}/{kind}")
    return tables
