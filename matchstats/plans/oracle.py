"""The registered queries as SQL over the raw test tables, for an independent engine.

The SQL follows the question, not the Spark plan: a leaderboard is one grouping with filtered
aggregates, streaks use numbered islands.
"""

from __future__ import annotations

from matchstats.functions.labels import METRIC_NAMES
from matchstats.plans.queries import (
    CLUB_A,
    CLUB_B,
    CLUB_BOARDS,
    COMPARISONS,
    COMPETITIONS,
    IMPACTS,
    LAST_GAMES,
    PLAYER_A,
    PLAYER_BOARDS,
    RANKED,
    RECORDS,
    SEASONS,
    SHARED_PLAYER,
    STREAKS,
)
from matchstats.registry import BY_KEY, CATEGORIES, LOWER_IS_BETTER, RATIOS

_PERIOD_FILTERS = {"ALL": "", "1ST": " WHERE ls = 'F'", "2ND": " WHERE ls = 'O'"}
_MEASURES = {
    "shotsOnGoal": "floor(q / 12)",
    "passes": "q",
    "accuratePasses": "floor(q * (1 - disc))",
}


def _match_stats() -> str:
    return " UNION ALL ".join(
        f"SELECT match_id, '{period}' AS period, '{key}' AS metric_key, "
        f"sum(CASE WHEN side = 'home' THEN CAST({value} AS DOUBLE) ELSE 0 END) AS home_value, "
        f"sum(CASE WHEN side = 'away' THEN CAST({value} AS DOUBLE) ELSE 0 END) AS away_value "
        f"FROM b_lines{where} GROUP BY match_id"
        for key, value in _MEASURES.items()
        for period, where in _PERIOD_FILTERS.items()
    )


VIEWS = {
    "b_matches": """
SELECT x.*, hn.n_name AS home_team_name, an.n_name AS away_team_name
FROM (
  SELECT CAST(o_orderkey AS BIGINT) AS match_id,
    CAST(CASE WHEN o_orderkey % 97 = 0 THEN 99 ELSE n_regionkey END AS BIGINT) AS tournament_id,
    CAST(year(o_orderdate) * 10 + n_regionkey AS BIGINT) AS season_id,
    CAST(CASE WHEN month(o_orderdate) >= 11 THEN month(o_orderdate) + 15 ELSE month(o_orderdate) END AS INT) AS round_id,
    CASE month(o_orderdate) WHEN 11 THEN 'Semifinal' WHEN 12 THEN 'Final' END AS round_name,
    CAST(c_nationkey AS BIGINT) AS home_team_id,
    CAST((c_nationkey + 1 + o_orderkey % 24) % 25 AS BIGINT) AS away_team_id,
    o_orderdate AS match_date,
    CASE o_orderstatus WHEN 'F' THEN 100 WHEN 'O' THEN 110 ELSE 60 END AS status_code
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey) x
JOIN nation hn ON hn.n_nationkey = x.home_team_id
JOIN nation an ON an.n_nationkey = x.away_team_id""",
    "b_clubs": "SELECT CAST(n_nationkey AS BIGINT) AS team_id, n_name AS name FROM nation WHERE n_nationkey <> 24",
    "b_tournaments": """
SELECT DISTINCT tournament_id AS unique_tournament_id, season_id, r_name AS name, CAST(year(match_date) AS VARCHAR) AS season_year
FROM b_matches JOIN region ON r_regionkey = tournament_id""",
    "b_lines": """
SELECT match_id, side, team_id,
  CASE WHEN l_suppkey % 10 = 0 THEN 9000 + l_suppkey ELSE team_id * 100 + l_suppkey % 20 END AS player_id,
  l_quantity AS q, l_discount AS disc, l_linenumber AS ln, l_returnflag AS rf, l_linestatus AS ls
FROM (SELECT m.match_id, l.*,
    CASE WHEN l_linenumber % 2 = 1 THEN m.home_team_id ELSE m.away_team_id END AS team_id,
    CASE WHEN l_linenumber % 2 = 1 THEN 'home' ELSE 'away' END AS side
  FROM lineitem l JOIN b_matches m ON m.match_id = l.l_orderkey) x""",
    "b_players": """
SELECT DISTINCT player_id, team_id, concat('PLAYER_', CAST(player_id AS VARCHAR)) AS name,
  CASE WHEN player_id % 13 = 0 THEN NULL WHEN player_id % 4 = 0 THEN 'G' WHEN player_id % 4 = 1 THEN 'D' WHEN player_id % 4 = 2 THEN 'M' ELSE 'F' END AS position
FROM b_lines WHERE NOT (player_id >= 9000 AND team_id % 5 = 0)""",
    "b_player_stats_log": """
SELECT match_id, player_id, team_id, 'minutesPlayed' AS metric_key, CAST(least(q * 2, 90) AS DOUBLE) AS value FROM b_lines
UNION ALL SELECT match_id, player_id, team_id, 'goals' AS metric_key, CAST(1 AS DOUBLE) AS value FROM b_lines WHERE rf = 'R'
UNION ALL SELECT match_id, player_id, team_id, 'totalShots' AS metric_key, CAST(floor(q / 5) AS DOUBLE) AS value FROM b_lines
UNION ALL SELECT match_id, player_id, team_id, 'onTargetScoringAttempt' AS metric_key, CAST(floor(q / 12) AS DOUBLE) AS value FROM b_lines
UNION ALL SELECT match_id, player_id, team_id, 'expectedGoals' AS metric_key, CAST(disc AS DOUBLE) AS value FROM b_lines WHERE disc > 0
UNION ALL SELECT match_id, player_id, team_id, 'totalPass' AS metric_key, CAST(q AS DOUBLE) AS value FROM b_lines
UNION ALL SELECT match_id, player_id, team_id, 'accuratePass' AS metric_key, CAST(floor(q * (1 - disc)) AS DOUBLE) AS value FROM b_lines
UNION ALL SELECT match_id, player_id, team_id, 'duelWon' AS metric_key, CAST(ln AS DOUBLE) AS value FROM b_lines
UNION ALL SELECT match_id, player_id, team_id, 'duelLost' AS metric_key, CAST(7 - ln AS DOUBLE) AS value FROM b_lines""",
    "b_match_stats_log": _match_stats(),
}


def over_tables(body: str, **ctes: str) -> str:
    """A query with the bound tables, and further named steps, in front."""
    steps = {**VIEWS, **ctes}
    listed = ",\n".join(f"{name} AS ({text})" for name, text in steps.items())
    return f"WITH {listed}\n{body}"


def _in(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _rounded(expression: str) -> str:
    """Six places; exact decimals in between, so that a tie is the same tie in both engines."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38, 10)), 6) AS DOUBLE)"


def _r(expression: str, name: str) -> str:
    return f"{_rounded(f'CAST({expression} AS DOUBLE)')} AS {name}"


_COMPETITION = (
    "LEFT JOIN b_tournaments t ON m.tournament_id = t.unique_tournament_id AND m.season_id = t.season_id"
)
_GROUPS = {
    "cumulative": {},
    "by_competition_season": {"competition": "t.name", "season": "t.season_year"},
    "by_season": {"season": "t.season_year"},
    "by_competition": {"competition": "t.name"},
}


def _player_keys(category: str) -> dict[str, str]:
    return {
        m: BY_KEY[m].key
        for m in CATEGORIES[category]
        if m in BY_KEY and BY_KEY[m].source == "player"
    }


def _club_keys(category: str, prefer_match: bool, period: str = "ALL") -> dict[str, tuple[str, str]]:
    keys = {}
    for m in CATEGORIES[category]:
        if m not in BY_KEY:
            continue
        entry = BY_KEY[m]
        if prefer_match and entry.match_key:
            keys[m] = (entry.match_key, "match")
        elif entry.source == "match" or period == "ALL":
            keys[m] = (entry.key, entry.source)
    return keys


def _ratio(name: str, column=lambda c: c) -> str:
    numerator, terms = RATIOS[name]
    below = " + ".join(column(t) for t in terms)
    return f"CASE WHEN {below} > 0 THEN {column(numerator)} / ({below}) * 100 ELSE 0 END"


def _shown(category: str, metrics) -> list[str]:
    out = []
    for c in CATEGORIES[category]:
        if c in RATIOS:
            if {RATIOS[c][0], *RATIOS[c][1]} <= set(metrics):
                out.append(c)
        elif c in metrics:
            out.append(c)
    return out


def _scaled(expression: str, mode: str, games: str = "games", minutes: str = "minutes") -> str:
    if mode == "per_game":
        return f"CASE WHEN {games} > 0 THEN {expression} / {games} ELSE 0 END"
    if mode == "per_90":
        return f"CASE WHEN {minutes} > 0 THEN {expression} * 90 / {minutes} ELSE 0 END"
    return expression


def _values(category: str, metrics, mode: str = "total") -> str:
    return ", ".join(
        _r(_ratio(c) if c in RATIOS else _scaled(c, mode), c) for c in _shown(category, metrics)
    )


def _pivot(keys: dict[str, str]) -> str:
    return ", ".join(
        f"coalesce(sum(CASE WHEN metric_key = '{key}' THEN v END), 0) AS {metric}"
        for metric, key in keys.items()
    )


def _venue(venue: str, team: str) -> str:
    return {"both": "", "home": f" AND m.home_team_id = {team}", "away": f" AND m.away_team_id = {team}"}[venue]


def _summed(keys: dict[str, str]) -> str:
    """A column for each metric: the sum of its rows, 0 without any."""
    return ", ".join(
        f"coalesce(sum(value) FILTER (metric_key = '{key}' AND NOT game), 0) AS {metric}" for metric, key in keys.items()
    )


def _board(entity: str, rows: str, by: dict, keys: dict[str, str], minutes: str) -> str:
    """What a board is, said of rows (entity, match, group, metric, value, game): a group of an entity
    counts if it has a game and a value, and has all its names."""
    groups = "".join(f", {n}" for n in by)
    named = "".join(f" AND {n} IS NOT NULL" for n in by)
    return (
        f"SELECT {entity}{groups}, count(DISTINCT match_id) FILTER (game) AS games, {minutes} AS minutes, {_summed(keys)} "
        f"FROM ({rows}) r GROUP BY {entity}{groups} HAVING count(*) FILTER (game) > 0 AND count(*) FILTER (NOT game) > 0{named}"
    )


def _player_board_steps(category, group_mode="cumulative", venue="both", teams=None, players=None) -> dict:
    by = _GROUPS[group_mode]
    named = "".join(f", {e} AS {n}" for n, e in by.items())
    keys = _player_keys(category)
    of_game = {False: f"metric_key IN ({_in(keys.values())})", True: "metric_key = 'minutesPlayed'"}
    chosen = (f" AND f.team_id IN ({_in(teams)})" if teams else "") + (
        f" AND f.player_id IN ({_in(players)})" if players else ""
    )
    rows = " UNION ALL ".join(
        f"SELECT f.player_id, f.match_id{named}, metric_key, value, {str(game).lower()} AS game FROM b_player_stats_log f "
        f"JOIN b_matches m ON m.match_id = f.match_id {_COMPETITION} WHERE {wanted}{chosen}{_venue(venue, 'f.team_id')}"
        for game, wanted in of_game.items()
    )
    return {
        "wide": _board("player_id", rows, by, keys, "sum(value) FILTER (game)"),
        "pc": "SELECT f.player_id, string_agg(DISTINCT coalesce(c.name, 'Unknown'), ',' ORDER BY coalesce(c.name, 'Unknown')) AS club "
        "FROM b_player_stats_log f LEFT JOIN b_clubs c ON c.team_id = f.team_id "
        f"WHERE metric_key = 'minutesPlayed'{chosen} GROUP BY f.player_id",
    }


def _player_board(category, positions=None, calc_mode="total", min_games=1, min_minutes=0, **options) -> str:
    by = _GROUPS[options.get("group_mode", "cumulative")]
    where = f"WHERE position IN ({_in(positions)})" if positions else ""
    steps = _player_board_steps(category, **options)
    steps["names"] = (
        f"SELECT player_id, max(name) AS player, max(position) AS position FROM b_players {where} GROUP BY player_id"
    )
    groups = "".join(f"wide.{n}, " for n in by)
    body = (
        f"SELECT wide.player_id, player, coalesce(pc.club, 'Unknown') AS club, position, {groups}"
        f"CAST(games AS BIGINT) AS games, CAST(floor(minutes) AS BIGINT) AS minutes, "
        f"{_values(category, _player_keys(category), calc_mode)} "
        "FROM wide JOIN names ON names.player_id = wide.player_id LEFT JOIN pc ON pc.player_id = wide.player_id "
        f"WHERE position IS NOT NULL AND games >= {min_games} AND minutes >= {min_minutes}"
    )
    return over_tables(body, **steps)


def _club_rows(keys, perspective, period, venue, teams, extra="", source="") -> str:
    """Long club rows (team, match, metric, value) of both facts."""
    parts = []
    player_keys = [k for k, s in keys.values() if s == "player"]
    match_keys = [k for k, s in keys.values() if s == "match"]
    chosen = f" AND s.team_id IN ({_in(teams)})" if teams else ""
    tag = lambda s: f", '{s}' AS source" if source else ""
    if player_keys:
        if perspective == "against":
            parts.append(
                f"SELECT s.team_id, m.match_id, f.metric_key, f.value{extra}{tag('player')} "
                f"FROM b_player_stats_log f JOIN b_matches m ON m.match_id = f.match_id {_COMPETITION} "
                "JOIN (SELECT match_id, home_team_id AS team_id FROM b_matches UNION ALL SELECT match_id, away_team_id FROM b_matches) s "
                f"ON s.match_id = m.match_id WHERE f.metric_key IN ({_in(player_keys)}) AND s.team_id <> f.team_id"
                f"{chosen}{_venue(venue, 's.team_id')}"
            )
        else:
            parts.append(
                f"SELECT s.team_id, m.match_id, s.metric_key, s.value{extra}{tag('player')} "
                f"FROM b_player_stats_log s JOIN b_matches m ON m.match_id = s.match_id {_COMPETITION} "
                f"WHERE s.metric_key IN ({_in(player_keys)}){chosen}{_venue(venue, 's.team_id')}"
            )
    if match_keys:
        first, second = ("home_value", "away_value") if perspective == "for" else ("away_value", "home_value")
        parts.append(
            f"SELECT s.team_id, m.match_id, f.metric_key, CASE WHEN m.home_team_id = s.team_id THEN {first} ELSE {second} END AS value{extra}{tag('match')} "
            f"FROM b_match_stats_log f JOIN b_matches m ON m.match_id = f.match_id {_COMPETITION} "
            "JOIN (SELECT match_id, home_team_id AS team_id FROM b_matches UNION ALL SELECT match_id, away_team_id FROM b_matches) s "
            f"ON s.match_id = m.match_id WHERE f.metric_key IN ({_in(match_keys)}) AND f.period = '{period}'"
            f"{chosen}{_venue(venue, 's.team_id')}"
        )
    return " UNION ALL ".join(parts)


def _club_steps(category, group_mode="cumulative", perspective="for", period="ALL", venue="both", teams=None) -> dict:
    by = _GROUPS[group_mode]
    named = "".join(f", {e} AS {n}" for n, e in by.items())
    keys = _club_keys(category, True, period)
    chosen = f" AND f.team_id IN ({_in(teams)})" if teams else ""
    rows = (
        f"SELECT *, false AS game FROM ({_club_rows(keys, perspective, period, venue, teams, named)}) x UNION ALL "
        f"SELECT f.team_id, m.match_id, f.metric_key, f.value{named}, true AS game FROM b_player_stats_log f "
        f"JOIN b_matches m ON m.match_id = f.match_id {_COMPETITION} "
        f"WHERE metric_key = 'minutesPlayed'{chosen}{_venue(venue, 'f.team_id')}"
    )
    minutes = "90 * count(DISTINCT match_id) FILTER (game)"
    return {"wide": _board("team_id", rows, by, {m: k for m, (k, _) in keys.items()}, minutes)}


def _club_board(category, calc_mode="total", columns=None, **options) -> str:
    by = _GROUPS[options.get("group_mode", "cumulative")]
    keys = _club_keys(category, True, options.get("period", "ALL"))
    groups = "".join(f"{n}, " for n in by)
    body = (
        f"SELECT wide.team_id, coalesce(c.name, 'Unknown') AS club, {groups}CAST(games AS BIGINT) AS games, "
        f"CAST(minutes AS BIGINT) AS minutes, {_values(category, keys, calc_mode)} "
        "FROM wide LEFT JOIN b_clubs c ON c.team_id = wide.team_id"
    )
    if columns:
        body = f"SELECT {columns} FROM ({body}) b"
    return over_tables(body, **_club_steps(category, **options))


_DESCRIBABLE = (
    "SELECT m.match_id, m.match_date, t.name AS competition, t.season_year AS season, "
    f"m.home_team_name || ' vs ' || m.away_team_name AS title FROM b_matches m {_COMPETITION} "
    "WHERE t.name IS NOT NULL AND t.season_year IS NOT NULL AND m.match_date IS NOT NULL"
)


def _game_steps(target, category, venue="both", perspective="for", prefer_match=False) -> tuple[dict, list[str]]:
    """Wide per-game table ``game`` and its shown columns."""
    if target == "player":
        keys = {**_player_keys(category), "minutesPlayed": "minutesPlayed"}
        steps = {
            "dm": _DESCRIBABLE,
            "game": f"SELECT player_id, team_id, match_id, {_pivot(keys)} FROM ("
            "SELECT f.player_id, f.team_id, f.match_id, f.metric_key, f.value AS v FROM b_player_stats_log f "
            "JOIN b_matches m ON m.match_id = f.match_id JOIN dm ON dm.match_id = f.match_id "
            "JOIN b_players p ON p.player_id = f.player_id AND p.team_id = f.team_id "
            f"WHERE f.metric_key IN ({_in(keys.values())}){_venue(venue, 'f.team_id')}) x "
            "GROUP BY player_id, team_id, match_id",
        }
        shown = [*_shown(category, keys), "minutesPlayed"]
    else:
        keys = _club_keys(category, prefer_match)
        rows = _club_rows(keys, perspective, "ALL", venue, None)
        steps = {
            "dm": _DESCRIBABLE,
            "game": f"SELECT team_id, match_id, {_pivot({m: k for m, (k, _) in keys.items()})} FROM ("
            f"SELECT team_id, match_id, metric_key, value AS v FROM ({rows}) r WHERE match_id IN (SELECT match_id FROM dm)) x "
            "GROUP BY team_id, match_id",
        }
        shown = _shown(category, keys)
    return steps, shown


def _described(target: str, shown: list[str]) -> str:
    who = "g.player_id, g.team_id, p.name AS player, " if target == "player" else "g.team_id, "
    values = ", ".join(_r(_ratio(c) if c in RATIOS else c, c) for c in shown)
    people = "JOIN b_players p ON p.player_id = g.player_id AND p.team_id = g.team_id" if target == "player" else ""
    return (
        f"SELECT {who}coalesce(c.name, 'Unknown') AS club, competition, season, title, "
        "strftime(match_date, '%Y-%m-%d %H:%M:%S') AS match_date, strftime(match_date, '%d/%m/%Y') AS day, "
        f"g.match_id, {values} FROM game g JOIN dm ON dm.match_id = g.match_id {people} "
        "LEFT JOIN b_clubs c ON c.team_id = g.team_id"
    )


def _records(target, category, metric, options) -> str:
    options = dict(options)
    direction = "ASC" if options.pop("order", "highest") == "lowest" else "DESC"
    steps, shown = _game_steps(target, category, **options)
    ties = "match_id, player_id, team_id" if target == "player" else "match_id, team_id"
    return over_tables(
        f"SELECT * FROM ({_described(target, shown)}) d ORDER BY {metric} {direction}, {ties} LIMIT 100", **steps
    )


def _last_games(target, category, n, options) -> str:
    steps, shown = _game_steps(target, category, prefer_match=True, **options)
    entity = "player_id" if target == "player" else "team_id"
    ranked = (
        f"SELECT d.*, row_number() OVER (PARTITION BY {entity} ORDER BY match_date DESC, match_id DESC, team_id DESC) AS rn "
        f"FROM ({_described(target, shown)}) d"
    )
    return over_tables(f"SELECT * EXCLUDE (rn) FROM ({ranked}) r WHERE rn <= {n}", **steps)


def _streaks(target, category, metric, operator, threshold, limit) -> str:
    steps, _ = _game_steps(target, category)
    value = _ratio(metric) if metric in RATIOS else metric
    hit = f"CASE WHEN round(CAST({value} AS DOUBLE), 6) {operator} {threshold} THEN 1 ELSE 0 END"
    if target == "player":
        entity = "player_id"
        steps["h"] = f"SELECT player_id, team_id, g.match_id, match_date, {hit} AS hit FROM game g JOIN dm ON dm.match_id = g.match_id"
    else:
        entity = "team_id"
        steps["h"] = (
            "SELECT s.team_id, s.match_id, s.match_date, coalesce(g.hit, 0) AS hit FROM ("
            "SELECT match_id, match_date, home_team_id AS team_id FROM b_matches WHERE status_code IN (100, 110, 120) "
            "UNION SELECT match_id, match_date, away_team_id FROM b_matches WHERE status_code IN (100, 110, 120)) s "
            f"LEFT JOIN (SELECT team_id, match_id, {hit} AS hit FROM game) g ON g.team_id = s.team_id AND g.match_id = s.match_id "
            "WHERE s.team_id IN (SELECT team_id FROM game)"
        )
    order = "match_date, match_id, team_id"
    back = "match_date DESC, match_id DESC, team_id DESC"
    steps["n"] = (
        f"SELECT *, sum(1 - hit) OVER (PARTITION BY {entity} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS island, "
        f"sum(1 - hit) OVER (PARTITION BY {entity} ORDER BY {back} ROWS UNBOUNDED PRECEDING) AS misses_after, "
        f"row_number() OVER (PARTITION BY {entity} ORDER BY {back}) AS latest FROM h"
    )
    steps["best"] = (
        f"SELECT {entity}, max(run) AS best FROM (SELECT {entity}, island, sum(hit) AS run FROM n GROUP BY {entity}, island) i GROUP BY {entity}"
    )
    steps["s"] = (
        f"SELECT {entity}, count(*) AS games, sum(hit) AS hits, sum(CASE WHEN misses_after = 0 THEN hit ELSE 0 END) AS active, "
        f"max(CASE WHEN latest = 1 THEN team_id END) AS latest_team FROM n GROUP BY {entity}"
    )
    label = "p.name AS player, coalesce(c.name, 'Unknown') AS current_club" if target == "player" else "coalesce(c.name, 'Unknown') AS club"
    people = "JOIN b_players p ON p.player_id = s.player_id AND p.team_id = s.latest_team" if target == "player" else ""
    cut = f" ORDER BY active_streak DESC, success_pct DESC, {entity} LIMIT {limit}" if limit else ""
    return over_tables(
        f"SELECT s.{entity}, {label}, CAST(games AS BIGINT) AS games, CAST(hits AS BIGINT) AS hits, "
        f"{_r('hits * 100.0 / games', 'success_pct')}, CAST(active AS BIGINT) AS active_streak, CAST(best AS BIGINT) AS best_streak "
        f"FROM s JOIN best ON best.{entity} = s.{entity} {people} LEFT JOIN b_clubs c ON c.team_id = s.latest_team{cut}",
        **steps,
    )


def _two_sided(shown, metrics, mode, first, second) -> str:
    """One row per metric from a one-row table with columns a_*, b_*."""
    lines = []
    for name in shown:
        values = []
        for side in ("a", "b"):
            if name in RATIOS:
                ok = {RATIOS[name][0], *RATIOS[name][1]} <= set(metrics)
                value = _ratio(name, lambda c, s=side: f"{s}_{c}") if ok else "0"
            elif name in metrics:
                value = _scaled(f"{side}_{name}", mode, f"{side}_games", f"{side}_minutes")
            else:
                value = "0"
            values.append(f"CAST({value} AS DOUBLE)")
        less = name in LOWER_IS_BETTER
        a, b = values
        lines.append(
            f"SELECT '{name}' AS metric, {_rounded(a)} AS value_{first}, {_rounded(b)} AS value_{second}, "
            f"CAST(a_games AS BIGINT) AS games_{first}, CAST(a_minutes AS BIGINT) AS minutes_{first}, "
            f"CAST(b_games AS BIGINT) AS games_{second}, CAST(b_minutes AS BIGINT) AS minutes_{second}, "
            f"{a} {'<' if less else '>'} {b} AS {first}_best, {b} {'<' if less else '>'} {a} AS {second}_best FROM sides WHERE n > 0"
        )
    return " UNION ALL ".join(lines)


def _sides(metrics, a: str, b: str, source: str) -> str:
    sums = ", ".join(
        f"coalesce(sum(CASE WHEN {cond} THEN {c} END), 0) AS {side}_{c}"
        for side, cond in (("a", a), ("b", b))
        for c in [*metrics, "games", "minutes"]
    )
    return f"SELECT count(CASE WHEN ({a}) OR ({b}) THEN 1 END) AS n, {sums} FROM {source}"


def _within(prefix: str, options: dict) -> str:
    text = ""
    if options.get(f"{prefix}competitions"):
        text += f" AND competition IN ({_in(options[f'{prefix}competitions'])})"
    if options.get(f"{prefix}seasons"):
        text += f" AND season IN ({_in(options[f'{prefix}seasons'])})"
    return text


def _compare(target, a, b, category, mode, perspective, options) -> str:
    if target == "player":
        entity = "player_id"
        steps = _player_board_steps(category, "by_competition_season", players=[a, b])
        metrics = list(_player_keys(category))
        source = "wide WHERE player_id IN (SELECT player_id FROM b_players WHERE position IS NOT NULL)"
    else:
        entity = "team_id"
        steps = _club_steps(category, "by_competition_season", perspective, teams=[a, b])
        metrics = list(_club_keys(category, True))
        source = "wide"
    steps["sides"] = _sides(
        metrics, f"{entity} = {a}{_within('a_', options)}", f"{entity} = {b}{_within('b_', options)}", source
    )
    return over_tables(_two_sided(CATEGORIES[category], metrics, mode, "a", "b"), **steps)


def _impact(player, team, category, mode, perspective, options) -> str:
    keys = _club_keys(category, True)
    named = f"SELECT m.match_id, t.name AS competition, t.season_year AS season FROM b_matches m {_COMPETITION} WHERE (m.home_team_id = {team} OR m.away_team_id = {team})"
    steps = {
        "tm": f"SELECT match_id FROM ({named}) x WHERE true{_within('', options)}",
        "played": f"SELECT DISTINCT match_id FROM b_player_stats_log WHERE player_id = {player} AND metric_key = 'minutesPlayed' AND value > 0",
        "cr": _club_rows(keys, perspective, "ALL", "both", [team]),
    }
    for half, test in (("w", "IN"), ("o", "NOT IN")):
        steps[f"{half}m"] = f"SELECT match_id FROM tm WHERE match_id {test} (SELECT match_id FROM played)"
        steps[f"{half}g"] = (
            "SELECT count(DISTINCT match_id) AS games, count(DISTINCT match_id) * 90 AS minutes FROM b_player_stats_log "
            f"WHERE team_id = {team} AND metric_key = 'minutesPlayed' AND match_id IN (SELECT match_id FROM {half}m)"
        )
        steps[f"{half}x"] = (
            f"SELECT '{half}' AS half, {_pivot({m: k for m, (k, _) in keys.items()})}, max(games) AS games, max(minutes) AS minutes "
            f"FROM (SELECT metric_key, value AS v FROM cr WHERE match_id IN (SELECT match_id FROM {half}m)) r, {half}g WHERE games > 0"
        )
    steps["halves"] = "SELECT * FROM wx WHERE games IS NOT NULL UNION ALL SELECT * FROM ox WHERE games IS NOT NULL"
    steps["sides"] = _sides(list(keys), "half = 'w'", "half = 'o'", "halves")
    return over_tables(
        _two_sided(_shown(category, keys), list(keys), mode, "with", "without"), **steps
    )


def _totals(by: str, body: str, **steps) -> str:
    return over_tables(f"SELECT {by}, count(*) AS rows, {_r('sum(value)', 'total')} FROM ({body}) x GROUP BY {by}", **steps)


_LABELS = ", ".join(f"('{k}', '{v}')" for k, v in METRIC_NAMES.items())
_SPLIT = (
    "array_to_string(list_transform(string_split(regexp_replace(regexp_replace(metric_key, '(.)([A-Z][a-z]+)', '\\1 \\2', 'g'), "
    "'([a-z0-9])([A-Z])', '\\1 \\2', 'g'), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"
)
_LINEUP_FACTS = (
    "SELECT match_id, player_id, team_id, metric_key, value FROM b_player_stats_log UNION ALL "
    "SELECT match_id, player_id, team_id, 'captain' AS metric_key, CAST(CASE WHEN ln = 1 THEN 1 ELSE 0 END AS DOUBLE) AS value FROM b_lines"
)
_STATISTICS_FACTS = (
    "SELECT match_id, period, metric_key, round(home_value, 6) AS home_value, round(away_value, 6) AS away_value FROM b_match_stats_log "
    "UNION ALL SELECT match_id, period, 'passesTotal', round(home_value + away_value, 6), 0 FROM b_match_stats_log WHERE metric_key = 'passes'"
)
_PCT = "CAST(q AS INT)"


def _loaded_dimensions(finished: str) -> str:
    """Every column of the dimensions as text, with what the payloads leave out as a dash."""

    def row(*values: str) -> str:
        return " || '|' || ".join(f"coalesce(CAST({v} AS VARCHAR), '-')" if v != "-" else "'-'" for v in values)

    date = "strftime(match_date, '%Y-%m-%d %H:%M:%S')"
    return (
        f"SELECT DISTINCT 'tournaments' AS dimension, {row('m.tournament_id', 't.name', '-', '-', 'm.season_id', '-', 't.season_year')} AS row "
        f"FROM b_matches m {_COMPETITION} WHERE m.tournament_id <> 0 UNION ALL "
        f"SELECT 'clubs', {row('team_id', 'name', *['-'] * 4, 'false', 'true', *['-'] * 3)} FROM "
        "(SELECT home_team_id AS team_id, home_team_name AS name FROM b_matches UNION SELECT away_team_id, away_team_name FROM b_matches) c WHERE team_id <> 0 UNION ALL "
        f"SELECT 'matches', {row('match_id', 'tournament_id', 'season_id', 'round_id', 'home_team_id', 'away_team_id', 'home_team_name', 'away_team_name', date, 'status_code', '-', '-', 'round_name', '-')} "
        "FROM b_matches UNION ALL "
        f"SELECT 'players', {row('player_id', 'name', '-', '-', 'team_id', *['-'] * 5, 'market_value')} FROM "
        "(SELECT DISTINCT player_id, 'PLAYER_' || CAST(player_id AS VARCHAR) AS name, team_id, '7500000.0' AS market_value "
        f"FROM b_lines l JOIN b_matches m ON m.match_id = l.match_id WHERE {finished}) p"
    )


def _simple() -> dict[str, str]:
    minutes = "b_player_stats_log f JOIN b_matches m ON m.match_id = f.match_id"
    chosen = f"SELECT * FROM b_tournaments WHERE name IN ({_in(COMPETITIONS)}) AND season_year IN ({_in(SEASONS)})"
    in_ctx = "tournament_id IN (SELECT unique_tournament_id FROM chosen) AND season_id IN (SELECT season_id FROM chosen)"
    finished = "status_code IN (100, 110, 120)"
    loaded = (
        f"SELECT f.match_id, m.season_id, f.team_id, f.player_id, f.metric_key, f.value FROM lf f JOIN b_matches m ON m.match_id = f.match_id WHERE {finished}"
    )
    finishing = _club_rows(_club_keys("finishing", True), "for", "ALL", "both", None, source="yes")
    passing_games, _ = _game_steps("club", "passing", prefer_match=True)
    duel_games, _ = _game_steps("player", "duels")
    duels = _player_board_steps("duels")
    passing = _player_board_steps("passing")
    away_passing = _player_board_steps("passing", venue="away")
    phases = (
        "SELECT round_id, round_id = row_number() OVER (ORDER BY round_id) AS in_run FROM (SELECT DISTINCT round_id FROM b_matches WHERE round_id IS NOT NULL) r"
    )
    club_sum = lambda rows: over_tables(
        f"SELECT team_id, metric_key, {_r('sum(value)', 'value')} FROM ({rows}) x GROUP BY team_id, metric_key"
    )
    players = {"goals": ("goals", "player"), "totalShots": ("totalShots", "player")}
    official = {"passes": ("passes", "match"), "shots": ("shotsOnGoal", "match")}
    pivoted = ", ".join(_r(m, m) for m in _player_keys("passing"))
    return {
        "scan_dimensions": over_tables(
            "SELECT 'tournaments' AS dimension, unique_tournament_id AS id, season_id AS second_id, name FROM b_tournaments "
            "UNION ALL SELECT 'matches', match_id, -1, home_team_name FROM b_matches "
            "UNION ALL SELECT 'clubs', team_id, -1, name FROM b_clubs "
            "UNION ALL SELECT 'players', player_id, team_id, name FROM b_players"
        ),
        "scan_player_facts": over_tables(
            f"SELECT f.match_id, player_id, team_id, metric_key, {_r('value', 'value')} FROM {minutes} "
            f"WHERE metric_key IN ('goals', 'expectedGoals') AND {finished}"
        ),
        "scan_spatial": over_tables(
            " UNION ALL ".join(
                f"SELECT '{name}' AS table_name, match_id * 10 + ln AS id, match_id, player_id, {_r('disc', 'x')} FROM b_lines"
                for name in ("match_shots", "match_spatial_actions", "match_average_positions")
            )
        ),
        "ingest_rounds": over_tables(
            "SELECT DISTINCT tournament_id, season_id, CAST(round_id AS BIGINT) AS round_id, CAST(NULL AS VARCHAR) AS round_slug, "
            "coalesce(round_name, 'Round ' || CAST(round_id AS VARCHAR)) AS round_name FROM b_matches WHERE tournament_id <> 99 "
            "UNION ALL SELECT tournament_id, season_id, n, NULL, 'Round ' || CAST(n AS VARCHAR) FROM "
            "(SELECT DISTINCT tournament_id, season_id FROM b_matches WHERE tournament_id = 99) c, "
            "(SELECT unnest(range(1, 39)) AS n) r"
        ),
        "ingest_matches": over_tables(
            "SELECT match_id, tournament_id, season_id, CAST(round_id AS BIGINT) AS round_id, home_team_id, away_team_id, home_team_name, "
            "away_team_name, strftime(match_date, '%Y-%m-%d %H:%M:%S') AS match_date, CAST(status_code AS BIGINT) AS status_code, round_name FROM b_matches"
        ),
        "ingest_clubs": over_tables(
            "SELECT home_team_id AS team_id, home_team_name AS name, false AS disabled, true AS national FROM b_matches WHERE home_team_id <> 0 "
            "UNION SELECT away_team_id, away_team_name, false, true FROM b_matches WHERE away_team_id <> 0"
        ),
        "ingest_tournaments": over_tables(
            f"SELECT DISTINCT m.tournament_id AS unique_tournament_id, m.season_id, t.name, t.season_year FROM b_matches m {_COMPETITION} WHERE m.tournament_id <> 0"
        ),
        "ingest_match_stats": over_tables(
            "SELECT match_id, period, metric_key, label AS metric_name, round(home_value, 6) AS home_value, round(away_value, 6) AS away_value "
            "FROM b_match_stats_log JOIN labels_of ON key = metric_key "
            "UNION ALL SELECT match_id, period, 'passesTotal', 'Passes (Total)', round(home_value + away_value, 6), 0 FROM b_match_stats_log WHERE metric_key = 'passes'",
            labels_of=f"SELECT * FROM (VALUES {_LABELS}) v(key, label)",
        ),
        "ingest_player_stats": over_tables(
            "SELECT player_id, team_id, 'M' AS position, metric_key, coalesce(label, 'Captain') AS metric_name, count(*) AS rows, "
            f"{_r('sum(value)', 'total')} FROM lf LEFT JOIN labels_of ON key = metric_key GROUP BY ALL",
            lf=_LINEUP_FACTS,
            labels_of=f"SELECT * FROM (VALUES {_LABELS}) v(key, label)",
        ),
        "ingest_players": over_tables(
            "SELECT player_id, team_id, 'PLAYER_' || CAST(player_id AS VARCHAR) AS name, CAST(7500000 AS DOUBLE) AS market_value, "
            "min(match_id) AS last_updated_match_id FROM b_lines GROUP BY player_id, team_id"
        ),
        "upsert_last_wins": over_tables(
            "SELECT m.match_id, CAST(coalesce(n.status_code, m.status_code) AS BIGINT) AS status_code, "
            "CAST(CASE WHEN n.match_id IS NULL THEN m.round_id ELSE 0 END AS BIGINT) AS round_id FROM b_matches m LEFT JOIN "
            "(SELECT match_id, max(ln + 200) AS status_code FROM b_lines WHERE rf = 'R' GROUP BY match_id) n ON n.match_id = m.match_id"
        ),
        "append_facts": over_tables(
            "SELECT f.match_id, period, metric_key, round(home_value, 6) AS home_value, round(away_value, 6) AS away_value, season_id "
            "FROM b_match_stats_log f JOIN b_matches m ON m.match_id = f.match_id"
        ),
        "replace_by_match": over_tables(
            "SELECT f.match_id, period, metric_key, round(home_value + CASE WHEN status_code = 60 THEN 1 ELSE 0 END, 6) AS home_value, "
            "round(away_value, 6) AS away_value FROM b_match_stats_log f JOIN b_matches m ON m.match_id = f.match_id"
        ),
        "reprocess_team_attribution": _totals(
            "player_id, team_id, metric_key",
            f"SELECT f.player_id, f.team_id, metric_key, value FROM lf f JOIN b_matches m ON m.match_id = f.match_id WHERE {finished} "
            f"UNION ALL SELECT f.player_id, p.team_id, metric_key, value FROM {minutes} "
            f"JOIN (SELECT player_id, max(team_id) AS team_id FROM b_players GROUP BY player_id) p ON p.player_id = f.player_id WHERE NOT ({finished})",
            lf=_LINEUP_FACTS,
        ),
        "incremental_new_matches": over_tables(
            f"SELECT match_id, season_id FROM b_matches WHERE {finished} AND match_id NOT IN "
            "(SELECT f.match_id FROM b_match_stats_log f JOIN b_matches m ON m.match_id = f.match_id WHERE year(match_date) < 2000)"
        ),
        **{
            f"{way}{suffix}": sql
            for way in ("ingest_job", "stream_ingest")
            for suffix, sql in {
                "": _totals("match_id, season_id, team_id, player_id, metric_key", loaded, lf=_LINEUP_FACTS),
                "_match_facts": over_tables(
                    f"SELECT f.*, season_id FROM sf f JOIN b_matches m ON m.match_id = f.match_id WHERE {finished}", sf=_STATISTICS_FACTS
                ),
                "_dimensions": over_tables(_loaded_dimensions(finished)),
            }.items()
        },
        "ingest_quarantine": over_tables(
            f"SELECT DISTINCT CASE WHEN l.match_id % 10 = 3 THEN 'lineups' ELSE 'loaded' END AS state, l.match_id FROM b_lines l "
            f"JOIN b_matches m ON m.match_id = l.match_id WHERE l.match_id % 10 = 3 OR {finished}"
        ),
        "ingest_ledger": over_tables(
            "SELECT 'loaded' AS state, match_id FROM done UNION ALL "
            "SELECT DISTINCT 'lineups', match_id FROM b_lines WHERE match_id NOT IN (SELECT match_id FROM done) UNION ALL "
            "SELECT DISTINCT 'statistics', match_id FROM b_match_stats_log WHERE match_id NOT IN (SELECT match_id FROM done)",
            sf=_STATISTICS_FACTS,
            done=f"SELECT DISTINCT f.match_id FROM sf f JOIN b_matches m ON m.match_id = f.match_id WHERE {finished}",
        ),
        "ctx_competition_season": over_tables(
            f"SELECT match_id, tournament_id, season_id FROM b_matches WHERE {in_ctx}", chosen=chosen
        ),
        "ctx_competition_only": over_tables(
            f"SELECT match_id, tournament_id FROM b_matches WHERE tournament_id IN (SELECT unique_tournament_id FROM b_tournaments WHERE name IN ({_in(COMPETITIONS)}))"
        ),
        "ctx_season_only": over_tables(
            f"SELECT match_id, season_id FROM b_matches WHERE season_id IN (SELECT season_id FROM b_tournaments WHERE season_year IN ({_in(SEASONS)}))"
        ),
        "ctx_until_date": over_tables(
            "SELECT match_id, strftime(match_date, '%Y-%m-%d %H:%M:%S') AS match_date FROM b_matches WHERE match_date < TIMESTAMP '1996-02-11 00:00:00'"
        ),
        "ctx_seasons": over_tables(
            f"SELECT DISTINCT season_year FROM b_tournaments WHERE name IN ({_in(COMPETITIONS)}) ORDER BY 1 DESC"
        ),
        "ctx_default_season": over_tables(
            f"SELECT season_year FROM (SELECT DISTINCT season_year FROM b_tournaments WHERE name IN ({_in(COMPETITIONS)})) s "
            "ORDER BY CASE season_year WHEN '2026' THEN 0 WHEN '25/26' THEN 1 ELSE 2 END, season_year DESC LIMIT 1"
        ),
        "ctx_competitions": over_tables(
            "SELECT DISTINCT t.name AS competition, t.season_year AS season FROM b_matches m JOIN b_tournaments t "
            "ON m.tournament_id = t.unique_tournament_id AND m.season_id = t.season_id"
        ),
        "players_to_choose": over_tables(
            "SELECT DISTINCT f.player_id, p.name AS player, f.team_id, c.name AS club FROM b_player_stats_log f "
            "JOIN (SELECT player_id, max(name) AS name FROM b_players GROUP BY player_id) p ON p.player_id = f.player_id "
            "JOIN b_clubs c ON c.team_id = f.team_id JOIN b_matches m ON m.match_id = f.match_id "
            "JOIN b_tournaments t ON m.tournament_id = t.unique_tournament_id AND m.season_id = t.season_id "
            f"WHERE f.metric_key = 'minutesPlayed' AND t.name IN ({_in(COMPETITIONS)}) AND t.season_year IN ({_in(SEASONS)}) "
            f"AND f.team_id IN ({CLUB_A}, 3, 7)"
        ),
        "ctx_bounds": over_tables(
            "SELECT strftime(min(match_date), '%Y-%m-%d') AS min_date, strftime(max(match_date), '%Y-%m-%d') AS max_date, "
            "CAST(min(round_id) AS BIGINT) AS min_round, CAST(max(round_id) AS BIGINT) AS max_round FROM b_matches"
        ),
        "ctx_date_range": over_tables(
            "SELECT match_id, strftime(match_date, '%Y-%m-%d %H:%M:%S') AS match_date FROM b_matches "
            "WHERE match_date BETWEEN TIMESTAMP '1996-02-10 00:00:00' AND TIMESTAMP '1998-07-31 23:59:59'"
        ),
        "ctx_round_phases": over_tables(
            "SELECT CAST(round_id AS BIGINT) AS round_id, in_run AND (SELECT count(*) FROM ph WHERE in_run) > 1 AS is_continuous FROM ph", ph=phases
        ),
        "ctx_round_names": over_tables(
            "SELECT CAST(round_id AS BIGINT) AS round_id, coalesce(min(round_name), 'Phase ' || CAST(round_id AS VARCHAR)) AS display_name FROM b_matches "
            "WHERE round_id IN (SELECT round_id FROM ph WHERE NOT in_run) GROUP BY round_id", ph=phases
        ),
        "ctx_round_filter": over_tables(
            "SELECT match_id, CAST(round_id AS BIGINT) AS round_id, concat_ws(',', "
            "CASE WHEN round_id BETWEEN 2 AND 5 OR round_id = 27 THEN 'both' END, CASE WHEN round_id BETWEEN 2 AND 5 THEN 'range' END, "
            "CASE WHEN round_id IN (26, 27) THEN 'extra' END) AS kept_by FROM b_matches"
        ),
        "ctx_club_filter": over_tables(
            f"SELECT match_id, home_team_id, away_team_id FROM b_matches WHERE home_team_id IN ({CLUB_A}, {CLUB_B}) OR away_team_id IN ({CLUB_A}, {CLUB_B})"
        ),
        "ctx_clubs": over_tables(
            "SELECT team_id, name FROM b_clubs WHERE team_id IN (SELECT home_team_id FROM b_matches UNION SELECT away_team_id FROM b_matches)"
        ),
        "ctx_players": over_tables(
            f"SELECT player_id, team_id, name, name IN ('PLAYER_{PLAYER_A}', 'PLAYER_{SHARED_PLAYER}') AS named FROM b_players WHERE team_id IN ({CLUB_A}, 3)"
        ),
        "ctx_all_filters": over_tables(
            f"SELECT match_id FROM b_matches WHERE {in_ctx} AND match_date >= TIMESTAMP '1996-02-10' AND match_date < TIMESTAMP '1997-12-01' "
            f"AND (round_id BETWEEN 1 AND 10 OR round_id = 26) AND (home_team_id IN ({CLUB_A}, 7, {CLUB_B}) OR away_team_id IN ({CLUB_A}, 7, {CLUB_B}))",
            chosen=chosen,
        ),
        "finished_matches": over_tables(
            f"SELECT match_id, CAST(status_code AS BIGINT) AS status_code FROM b_matches WHERE {finished}"
        ),
        "filter_position": "SELECT player_id, position, games, goals FROM ("
        + _player_board("finishing", positions=["G", "F"])
        + ") b",
        "venue_semi_join": over_tables(
            f"SELECT f.match_id, player_id, team_id, metric_key, {_r('value', 'value')} FROM b_player_stats_log f WHERE metric_key = 'minutesPlayed' "
            "AND EXISTS (SELECT 1 FROM b_matches m WHERE m.match_id = f.match_id AND m.home_team_id = f.team_id)"
        ),
        "venue_club_home": _club_board(
            "passing", perspective="against", venue="home", columns="team_id, games, totalPass, accuratePass, pass_accuracy_pct"
        ),
        "join_fact_match": over_tables(
            f"SELECT f.match_id, player_id, team_id, metric_key, {_r('value', 'value')}, season_id, home_team_id, away_team_id FROM {minutes} WHERE metric_key = 'minutesPlayed'"
        ),
        "join_match_competition": over_tables(
            f"SELECT match_id, t.name AS competition, t.season_year AS season FROM b_matches m {_COMPETITION}"
        ),
        "join_club_name": over_tables(
            "SELECT f.team_id, count(*) AS rows, coalesce(max(c.name), 'Unknown') AS club FROM b_player_stats_log f "
            "LEFT JOIN b_clubs c ON c.team_id = f.team_id WHERE metric_key = 'minutesPlayed' GROUP BY f.team_id"
        ),
        "with_without_split": over_tables(
            f"SELECT match_id, match_id IN (SELECT match_id FROM b_player_stats_log WHERE player_id = {SHARED_PLAYER} AND metric_key = 'minutesPlayed' AND value > 0) AS played "
            "FROM b_matches WHERE home_team_id = 3 OR away_team_id = 3"
        ),
        "context_entities": over_tables(
            "SELECT f.team_id, f.player_id, t.name AS competition, t.season_year AS season, max(p.name) AS player, max(c.name) AS club "
            "FROM b_player_stats_log f JOIN b_players p ON p.player_id = f.player_id JOIN b_clubs c ON c.team_id = f.team_id "
            "JOIN b_matches m ON m.match_id = f.match_id JOIN b_tournaments t ON m.tournament_id = t.unique_tournament_id AND m.season_id = t.season_id "
            "WHERE f.metric_key = 'minutesPlayed' GROUP BY f.team_id, f.player_id, t.name, t.season_year"
        ),
        "player_games_minutes": over_tables(
            f"SELECT player_id, count(DISTINCT match_id) AS games, {_r('sum(value)', 'minutes')} FROM b_player_stats_log WHERE metric_key = 'minutesPlayed' GROUP BY player_id"
        ),
        "player_metric_totals": over_tables(
            f"SELECT player_id, metric_key, {_r('sum(value)', 'value')} FROM b_player_stats_log WHERE metric_key IN ('duelWon', 'duelLost') GROUP BY player_id, metric_key"
        ),
        "club_games_minutes": over_tables(
            "SELECT team_id, count(DISTINCT match_id) AS games, count(DISTINCT match_id) * 90 AS minutes FROM b_player_stats_log WHERE metric_key = 'minutesPlayed' GROUP BY team_id"
        ),
        "club_player_stats_for": club_sum(_club_rows(players, "for", "ALL", "both", None)),
        "club_player_stats_against": club_sum(_club_rows(players, "against", "ALL", "both", None)),
        "club_match_stats_for": club_sum(_club_rows(official, "for", "ALL", "both", None)),
        "club_match_stats_against": club_sum(_club_rows(official, "against", "ALL", "both", None)),
        "club_metrics_union": over_tables(
            f"SELECT team_id, source, metric_key, count(*) AS rows, {_r('sum(value)', 'value')} FROM ({finishing}) x GROUP BY team_id, source, metric_key"
        ),
        "player_club_list": over_tables("SELECT player_id, club FROM pc", pc=duels["pc"]),
        "pivot_player_category": over_tables(f"SELECT player_id, {pivoted} FROM wide", **passing),
        "game_totals_player": over_tables(
            f"SELECT player_id, team_id, match_id, {_r('duelWon', 'duelWon')}, {_r('duelLost', 'duelLost')}, {_r('minutesPlayed', 'minutesPlayed')} FROM game", **duel_games
        ),
        "game_totals_club": over_tables(
            f"SELECT team_id, match_id, {_r('totalPass', 'totalPass')}, {_r('accuratePass', 'accuratePass')} FROM game", **passing_games
        ),
        "ratio_metrics_player": over_tables(
            f"SELECT player_id, {_r('totalPass', 'totalPass')}, {_r('accuratePass', 'accuratePass')}, {_r(_ratio('pass_accuracy_pct'), 'pass_accuracy_pct')}, "
            f"{_r(_ratio('cross_pct'), 'cross_pct')} FROM wide", **away_passing
        ),
        "ratio_duels": over_tables(
            f"SELECT player_id, {_r('duelWon', 'duelWon')}, {_r('duelLost', 'duelLost')}, {_r(_ratio('duel_won_pct'), 'duel_won_pct')}, "
            f"{_r(_ratio('aerial_won_pct'), 'aerial_won_pct')} FROM wide", **duels
        ),
        "calc_modes": over_tables(
            " UNION ALL ".join(
                f"SELECT '{mode}' AS mode, player_id, {_r(_scaled('goals', mode), 'goals')}, {_r(_scaled('totalShots', mode), 'totalShots')} FROM wide"
                for mode in ("total", "per_game", "per_90")
            ),
            **_player_board_steps("finishing"),
        ),
        "dedup_dimensions": over_tables(
            "SELECT player_id, min(team_id) AS team_id, min(name) AS name FROM b_players GROUP BY player_id"
        ),
        "dedup_first_seen": over_tables(
            "SELECT player_id, team_id, match_id FROM (SELECT player_id, team_id, m.match_id, row_number() OVER "
            f"(PARTITION BY player_id, team_id ORDER BY match_date, m.match_id) AS rn FROM {minutes} WHERE metric_key = 'minutesPlayed') x WHERE rn = 1"
        ),
        "match_title": over_tables(
            "SELECT match_id, CASE WHEN status_code <> 60 THEN home_team_name || ' vs ' || away_team_name END AS title, "
            "strftime(match_date, '%d/%m/%Y') AS day FROM b_matches"
        ),
        "normalize_match_date": over_tables(
            "SELECT match_id, strftime(CASE WHEN status_code = 100 THEN match_date WHEN round_id = 27 THEN NULL "
            "WHEN round_id = 26 THEN date_trunc('day', match_date) + INTERVAL 26 HOUR + INTERVAL 30 MINUTE ELSE date_trunc('day', match_date) END, "
            "'%Y-%m-%d %H:%M:%S') AS match_date FROM b_matches"
        ),
        "parse_percent_values": over_tables(
            "SELECT match_id, CAST(ln AS BIGINT) AS line, round(CASE WHEN rf = 'R' THEN CAST(CAST(q AS INT) AS DOUBLE) WHEN rf = 'A' THEN 0 "
            "WHEN ln = 1 THEN NULL WHEN ln > 2 THEN q END, 6) AS value FROM b_lines"
        ),
        "metric_label_from_key": over_tables(
            f"SELECT metric_key, coalesce(label, {_SPLIT}) AS metric_name FROM v LEFT JOIN labels_of ON key = metric_key",
            k="SELECT DISTINCT metric_key FROM b_player_stats_log UNION SELECT metric_key FROM b_match_stats_log",
            v="SELECT metric_key FROM k UNION ALL SELECT metric_key || 'OnTargetX' FROM k UNION ALL SELECT metric_key || '2ndHalf' FROM k",
            labels_of=f"SELECT * FROM (VALUES {_LABELS}) v(key, label)",
        ),
    }


def registered_sql() -> dict[str, str]:
    queries = _simple()
    for name, (category, options) in PLAYER_BOARDS.items():
        queries[name] = _player_board(category, **options)
    for name, (category, options) in CLUB_BOARDS.items():
        queries[name] = _club_board(category, **options)
    for name, (target, category, metric, options) in RECORDS.items():
        queries[name] = _records(target, category, metric, options)
    for name, (target, category, n, options) in LAST_GAMES.items():
        queries[name] = _last_games(target, category, n, options)
    for name, arguments in STREAKS.items():
        queries[name] = _streaks(*arguments)
    for name, (base, keys, order) in RANKED.items():
        queries[name] = f"SELECT {', '.join(keys)}, row_number() OVER (ORDER BY {order}) AS rank FROM ({queries[base]}) b"
    for name, arguments in COMPARISONS.items():
        queries[name] = _compare(*arguments)
    for name, arguments in IMPACTS.items():
        queries[name] = _impact(*arguments)
    return queries
