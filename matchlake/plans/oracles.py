"""DuckDB SQL that states each query's result independently of the Spark code.

The texts share common table expressions; each query takes the ones it needs.
"""

from __future__ import annotations

PLAYERS = """
players AS (
  SELECT c_custkey AS id, c_name AS account_name, concat(c_name, '@mail.test') AS email,
         make_timestamp((1672531200 + c_custkey * 60) * 1000000) AS created_at,
         CASE WHEN c_custkey % 10 = 0 THEN 'closed' ELSE 'active' END AS account_status,
         CASE WHEN c_custkey % 10 = 0
              THEN make_timestamp((1672617600 + c_custkey * 60) * 1000000) END AS deleted_at
  FROM customer)"""

MATCHES = """
slots AS (
  SELECT CAST(floor(event_id / 12) AS BIGINT) AS match_id, CAST(event_id % 12 AS INT) AS slot,
         event_id, user_id, event_type, value, ts
  FROM events),
spans AS (
  SELECT match_id AS id, min(ts) AS lo, max(ts) AS ended_at FROM slots GROUP BY match_id),
match_events AS (
  SELECT a.id, concat('map_', a.id % 7) AS map_name,
         CAST(300 + (a.id * 7919) % 901 AS INT) AS match_duration_seconds,
         coalesce(b.ended_at, a.lo) AS started_at, a.ended_at,
         CAST(a.id % 2 AS INT) AS winning_team
  FROM spans a LEFT JOIN spans b ON b.id = a.id - 1),
match_participants AS (
  SELECT event_id AS id, match_id,
         CASE WHEN user_id % 11 = 0 THEN user_id + 1000000000 ELSE user_id END AS player_id,
         CASE WHEN slot < 6 THEN 0 ELSE 1 END AS team,
         concat(event_type, '_', event_id % 10) AS hero_played,
         CASE WHEN event_id % 17 = 0 THEN NULL
              ELSE CAST(floor(value) AS INT) % 41 END AS kills,
         CAST(event_id % 21 AS INT) AS deaths,
         CAST((event_id * 37) % 10001 AS INT) AS healing,
         CASE WHEN (CASE WHEN slot < 6 THEN 0 ELSE 1 END) = match_id % 2
              THEN 'win' ELSE 'loss' END AS result
  FROM slots)"""


def tier(points: str) -> str:
    return (
        f"CASE WHEN {points} < 400 THEN 'bronze' WHEN {points} < 800 THEN 'silver' "
        f"WHEN {points} < 1200 THEN 'gold' WHEN {points} < 1600 THEN 'platinum' "
        "ELSE 'diamond' END"
    )


def division(points: str) -> str:
    return f"CAST(4 - floor((greatest(0, least({points}, 1999)) % 400) / 100) AS INT)"


_UPTO = "PARTITION BY player_id ORDER BY t, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

RANKS = f"""
deltas AS (
  SELECT p.player_id, date_trunc('millisecond', e.ended_at) AS t, p.id AS seq,
         CASE WHEN p.result = 'win' THEN 30 ELSE -15 END AS d, p.result
  FROM match_participants p JOIN match_events e ON p.match_id = e.id),
cum AS (
  SELECT player_id, t, seq,
         CAST(sum(d) OVER ({_UPTO}) AS BIGINT) AS s,
         CAST(count(*) FILTER (result = 'win') OVER ({_UPTO}) AS INT) AS wins,
         CAST(count(*) FILTER (result <> 'win') OVER ({_UPTO}) AS INT) AS losses
  FROM deltas),
walk AS (
  SELECT player_id, t, seq, wins, losses, s - least(0, min(s) OVER ({_UPTO})) AS pts FROM cum),
updates AS (
  SELECT player_id, {tier('pts')} AS rank_tier, {division('pts')} AS rank_division,
         CAST(pts AS INT) AS rank_points, wins, losses, t AS updated_at, seq
  FROM walk),
ranks AS (SELECT player_id, t, max_by(pts, seq) AS pts FROM walk GROUP BY player_id, t)"""

FACTS = f"""
looked AS (
  SELECT p.*, pl.account_name FROM match_participants p JOIN players pl ON p.player_id = pl.id),
complete AS (SELECT match_id FROM looked GROUP BY match_id HAVING count(*) = 12),
rosters AS (
  SELECT l.id, l.match_id, e.map_name, e.match_duration_seconds, e.started_at, e.ended_at,
         e.winning_team, l.player_id, l.account_name, l.team, l.hero_played, l.kills, l.deaths,
         l.healing, l.result
  FROM looked l JOIN complete c ON l.match_id = c.match_id
  JOIN match_events e ON e.id = l.match_id),
picked AS (
  SELECT f.id, r.pts
  FROM (SELECT *, date_trunc('millisecond', started_at) AS t0 FROM rosters) f
  ASOF LEFT JOIN ranks r ON f.player_id = r.player_id AND f.t0 >= r.t),
match_facts AS (
  SELECT f.*,
         CASE WHEN a.pts IS NULL THEN 'bronze' ELSE {tier('a.pts')} END
           AS rank_tier_at_match_start,
         CASE WHEN a.pts IS NULL THEN 3 ELSE {division('a.pts')} END
           AS rank_division_at_match_start,
         CAST(coalesce(a.pts, 0) AS INT) AS rank_points_at_match_start,
         a.pts IS NOT NULL AS found
  FROM rosters f JOIN picked a ON f.id = a.id)"""

ALL_AS_OF = f"""
all_as_of AS (
  SELECT f.id, f.player_id,
         CASE WHEN r.pts IS NULL THEN 'bronze' ELSE {tier('r.pts')} END
           AS rank_tier_at_match_start,
         CASE WHEN r.pts IS NULL THEN 3 ELSE {division('r.pts')} END
           AS rank_division_at_match_start,
         CAST(coalesce(r.pts, 0) AS INT) AS rank_points_at_match_start,
         r.pts IS NOT NULL AS found
  FROM (SELECT p.id, p.player_id, date_trunc('millisecond', e.started_at) AS t0
        FROM match_participants p JOIN match_events e ON p.match_id = e.id) f
  ASOF LEFT JOIN ranks r ON f.player_id = r.player_id AND f.t0 >= r.t)"""

PREFIX = "dbserver1.public."
LOG = f"""
owners AS (
  SELECT '{PREFIX}players' AS topic, id AS k, id AS row_key FROM players
  UNION ALL SELECT '{PREFIX}ranks', seq, player_id FROM walk
  UNION ALL SELECT '{PREFIX}match_events', id, id FROM match_events
  UNION ALL SELECT '{PREFIX}match_participants', id, id FROM match_participants),
log AS (
  SELECT topic, 6 * k AS "offset", 'row' AS fate, row_key FROM owners
  UNION ALL SELECT topic, 6 * k + 1, 'delete', NULL FROM owners WHERE k % 50 = 0
  UNION ALL SELECT topic, 6 * k + 2, 'delete', NULL FROM owners WHERE k % 61 = 0
  UNION ALL SELECT topic, 6 * k + 3, 'malformed', NULL FROM owners WHERE k % 97 = 0
  UNION ALL SELECT topic, 6 * k + 4, 'missing_field', k FROM owners WHERE k % 89 = 0
  UNION ALL SELECT topic, 6 * k + 5, 'bad_value', row_key FROM owners WHERE k % 83 = 0)"""

ARRIVALS = """
player_log AS (
  SELECT players.*, (id * 7919) % 600000 AS arrival, 4 * id AS "offset" FROM players
  UNION ALL
  SELECT id, concat(account_name, '#1'), email, created_at, account_status, deleted_at,
         (id * 7919) % 600000, 4 * id + 1 FROM players WHERE id % 3 = 0
  UNION ALL
  SELECT id, concat(account_name, '#2'), email, created_at, account_status, deleted_at,
         9000000 + id, 4 * id + 2 FROM players WHERE id % 2 = 0),
player_versions AS (
  SELECT id, arrival, max_by(account_name, "offset") AS account_name
  FROM player_log GROUP BY id, arrival),
participant_log AS (
  SELECT *, match_id * 20000 + (id * id * 31 + id * 7919) % 9000 AS arrival
  FROM match_participants),
event_log AS (
  SELECT *, id * 20000 + 6000 AS arrival FROM match_events
  UNION ALL
  SELECT id, concat(map_name, '#1'), match_duration_seconds, started_at, ended_at, winning_team,
         id * 20000 + 6000 FROM match_events WHERE id % 5 = 0),
last_events AS (
  SELECT * REPLACE (CASE WHEN id % 5 = 0 THEN concat(map_name, '#1') ELSE map_name END AS map_name)
  FROM match_events),
rank_log AS (
  SELECT *, CAST(floor(seq / 12) AS BIGINT) * 20000 + 9000 + (seq % 23) * 2000 AS arrival
  FROM updates),
arrived AS (
  SELECT p.*, pl.account_name
  FROM participant_log p ASOF JOIN player_versions pl
    ON p.player_id = pl.id AND p.arrival >= pl.arrival)"""


def sessions(source: str) -> str:
    return f"""
buffered AS (
  SELECT match_id, arrival, id, 1 AS p, 0 AS e FROM {source}
  UNION ALL SELECT id, arrival, -1, 0, 1 FROM event_log),
gaps AS (
  SELECT *, CASE WHEN arrival - lag(arrival) OVER w > 3000 THEN 1 ELSE 0 END AS opens
  FROM buffered WINDOW w AS (PARTITION BY match_id ORDER BY arrival, id)),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY match_id ORDER BY arrival, id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s
  FROM gaps),
sessions AS (
  SELECT match_id, s, min(arrival) AS first_ms, max(arrival) + 3000 AS fire_ms,
         CAST(sum(p) AS BIGINT) AS participants, CAST(sum(e) AS BIGINT) AS events,
         sum(p) = 12 AND sum(e) > 0 AS complete
  FROM numbered GROUP BY match_id, s)"""


REPLAY = f"""
emitted AS (
  SELECT a.*, s.fire_ms
  FROM arrived a
  JOIN numbered n ON n.match_id = a.match_id AND n.id = a.id AND n.p = 1
  JOIN sessions s ON s.match_id = n.match_id AND s.s = n.s AND s.complete),
candidates AS (
  SELECT f.id, r.rank_points AS pts,
         row_number() OVER (PARTITION BY f.id
                            ORDER BY r.updated_at DESC, r.arrival DESC, r.seq DESC) AS rn
  FROM emitted f JOIN match_events e ON e.id = f.match_id
  JOIN rank_log r ON r.player_id = f.player_id AND r.arrival <= f.fire_ms
    AND r.updated_at <= date_trunc('millisecond', e.started_at)),
replayed AS (
  SELECT f.id, f.match_id, e.map_name, e.match_duration_seconds, e.started_at, e.ended_at,
         e.winning_team, f.player_id, f.account_name, f.team, f.hero_played, f.kills, f.deaths,
         f.healing, f.result,
         CASE WHEN c.pts IS NULL THEN 'bronze' ELSE {tier('c.pts')} END
           AS rank_tier_at_match_start,
         CASE WHEN c.pts IS NULL THEN 3 ELSE {division('c.pts')} END
           AS rank_division_at_match_start,
         CAST(coalesce(c.pts, 0) AS INT) AS rank_points_at_match_start
  FROM emitted f JOIN last_events e ON e.id = f.match_id
  LEFT JOIN candidates c ON c.id = f.id AND c.rn = 1)"""

SAMPLES = """
numbered_events AS (
  SELECT event_type, CAST(user_id % 5 AS VARCHAR) AS shard, ts, value AS gauge,
         CAST((row_number() OVER (PARTITION BY event_type, user_id % 5 ORDER BY event_id) - 1)
              % 50 AS DOUBLE) AS counter
  FROM events),
steps AS (
  SELECT *, lag(ts) OVER w AS since,
         CASE WHEN counter < lag(counter) OVER w THEN counter
              ELSE counter - lag(counter) OVER w END AS step
  FROM numbered_events WINDOW w AS (PARTITION BY event_type, shard ORDER BY ts)),
hours AS (
  SELECT unnest(generate_series(date_trunc('hour', min(ts)), max(ts) + INTERVAL 7 HOURS,
                                INTERVAL 1 HOUR)) AS tick FROM events),
asked AS (
  SELECT event_type, shard, tick
  FROM (SELECT DISTINCT event_type, shard FROM numbered_events) CROSS JOIN hours),
hourly AS (
  SELECT a.event_type, a.shard, a.tick AS ts, e.gauge, e.counter
  FROM asked a ASOF JOIN numbered_events e
    ON a.event_type = e.event_type AND a.shard = e.shard AND a.tick >= e.ts
  WHERE a.tick - e.ts <= INTERVAL 6 HOURS),
hourly_sums AS (
  SELECT event_type, ts, sum(gauge) AS value, max(gauge) AS highest, count(*) AS series_count
  FROM hourly GROUP BY event_type, ts)"""

# Series number, metric, all labels, the label an alert groups by, sample value by scrape s
# and noise n.
_J = '{{"key":"{}","value":"{}"}}'


def _labels(*pairs: tuple[str, str]) -> str:
    return "[" + ",".join(_J.format(k, v) for k, v in sorted(pairs)) + "]"


def _turn(length: int, value: str, rest: str) -> str:
    return f"CASE WHEN (s // {length}) % 2 = 1 THEN {value} ELSE {rest} END"


_EVENTS_TOPIC = ("topic", "dbserver1.public.match_events")
_RANKS_TOPIC = ("topic", "dbserver1.public.ranks")
_SERIES = [
    # number, alert, role, group, value
    (0, "Offline partitions", "part", _labels(("name", "OfflinePartitionsCount")),
     "CASE WHEN n > 200 THEN 1 ELSE 0 END"),
    (1, "Consumer lag climbing", "part", _labels(_EVENTS_TOPIC), "s % 200 * 100 + n"),
    (2, "Consumer lag climbing", "part", _labels(_RANKS_TOPIC), "s % 200 * 50 + n"),
    (3, "Consumer lag climbing", "part", _labels(_EVENTS_TOPIC), "n"),
    (4, "Failed checkpoints", "part", _labels(("job", "facts")), "(s * s // 500) % 50"),
    (5, "Job restart loop", "part", _labels(("job", "facts")), "(s // 35) % 7"),
    (6, "CDC source stopped", "part", _labels(("slot", "lake")),
     "CASE WHEN s % 30 < 8 THEN 0 ELSE 1 END"),
    (7, "Under-replicated partitions", "part", _labels(("name", "UnderReplicatedPartitions")),
     "CASE WHEN n > 150 THEN 1 ELSE 0 END"),
    (8, "Checkpoint duration high", "part", _labels(("job", "facts")),
     _turn(40, "12000 + n", "n")),
    (9, "Operator backpressure", "part", _labels(("task_name", "MatchJoin")),
     _turn(100, "450 + n % 50", "n % 50")),
    (10, "Operator backpressure", "part", _labels(("task_name", "MatchJoin")),
     _turn(100, "100 + n", "n % 50")),
    (12, "TaskManager heap high", "part", _labels(("tm", "0")),
     _turn(60, "900 + n % 50", "600")),
    (13, "TaskManager heap high", "whole", _labels(("tm", "0")), "1000"),
    (14, "Streaming source lag high", "part", "[]", _turn(30, "6000 + n", "n")),
    (15, "Streaming source lag high", "part", "[]", "n * 20"),
    (16, "Incomplete join rate", "part", _labels(("subtask", "0")), "least(s % 150, 60)"),
]
# alert, severity, kind, window in scrapes, hold in seconds, breach test
_RULES = [
    ("Offline partitions", "page", "value", 0, 0, "value > 0"),
    ("Consumer lag climbing", "page", "value", 0, 0, "value > 200 AND slope > 5"),
    ("Failed checkpoints", "page", "increase", 900, 0, "value >= 3"),
    ("Job restart loop", "page", "increase", 600, 0, "value >= 2"),
    ("CDC source stopped", "page", "value", 0, 60, "value = 0"),
    ("Under-replicated partitions", "ticket", "value", 0, 0, "value > 0"),
    ("Checkpoint duration high", "ticket", "value", 0, 300, "value > 10000"),
    ("Operator backpressure", "ticket", "value", 0, 900, "value > 500"),
    ("TaskManager heap high", "ticket", "value", 0, 600, "value > 0.8"),
    ("Streaming source lag high", "ticket", "value", 0, 300, "value > 5000"),
    ("Incomplete join rate", "ticket", "rate", 300, 300, "value > 0"),
]


RAW_SAMPLES = """raw AS (
  SELECT event_id % 21 AS i, event_id // 21 AS s, CAST(floor(value) AS BIGINT) AS n,
         event_id // 21 * 15000 + event_id % 21 * 7 % 15 * 1000 + event_id * 137 % 900
           + CASE WHEN event_id % 21 = 8 AND event_id // 21 % 97 BETWEEN 50 AND 74
                  THEN 376000 ELSE 0 END AS ms
  FROM events)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _alerts_sql() -> str:
    value = " ".join(f"WHEN {i} THEN {v}" for i, _, _, _, v in _SERIES)
    table = ", ".join(
        f"({i}, {_quoted(a)}, {_quoted(r)}, {_quoted(g)})" for i, a, r, g, _ in _SERIES
    )
    breach = " ".join(f"WHEN alert = {_quoted(r[0])} THEN {r[5]}" for r in _RULES)
    severity = " ".join(f"WHEN {_quoted(r[0])} THEN {_quoted(r[1])}" for r in _RULES)
    holds = " ".join(f"WHEN {_quoted(r[0])} THEN {r[4]}" for r in _RULES)
    counters = ", ".join(
        f"({_quoted(alert)}, {w * 1000}, {w if kind == 'rate' else 1})"
        for alert, _, kind, w, _, _ in _RULES
        if kind != "value"
    )
    return f"""
WITH {RAW_SAMPLES},
uses(i, alert, role, grp) AS (VALUES {table}),
windows(alert, w, per) AS (VALUES {counters}),
sampled AS (SELECT i, ms, CAST(CASE i {value} END AS DOUBLE) AS v FROM raw),
ticks AS (SELECT unnest(range(0, max(ms) + 960000, 15000)) AS t FROM raw),
stepped AS (
  SELECT *, lag(ms) OVER w AS since,
         CASE WHEN v < lag(v) OVER w THEN v ELSE v - lag(v) OVER w END AS step
  FROM sampled WINDOW w AS (PARTITION BY i ORDER BY ms)),
asked AS (
  SELECT u.*, t.t FROM uses u CROSS JOIN ticks t
  WHERE u.alert NOT IN (SELECT alert FROM windows)),
measured AS (
  SELECT a.alert, a.role, a.grp, a.t, x.v AS m
  FROM asked a ASOF JOIN sampled x ON a.i = x.i AND a.t >= x.ms
  WHERE a.t - x.ms <= 300000
  UNION ALL
  SELECT u.alert, u.role, u.grp, t.t, sum(x.step) / any_value(d.per)
  FROM windows d JOIN uses u ON u.alert = d.alert JOIN stepped x ON x.i = u.i
  JOIN ticks t ON x.ms <= t.t AND x.since >= t.t - d.w
  GROUP BY u.alert, u.role, u.grp, u.i, t.t),
parts AS (
  SELECT alert, grp, t, sum(m) FILTER (role = 'part') AS part, max(m) AS highest,
         sum(m) FILTER (role = 'whole') AS whole
  FROM measured GROUP BY alert, grp, t),
grouped AS (
  SELECT alert, grp, t,
         CASE alert WHEN 'TaskManager heap high'
                    THEN CASE WHEN whole <> 0 THEN part / whole
                              WHEN whole = 0 AND part > 0 THEN CAST('inf' AS DOUBLE)
                              WHEN whole = 0 AND part < 0 THEN CAST('-inf' AS DOUBLE) END
                    WHEN 'Streaming source lag high' THEN highest ELSE part END AS value
  FROM parts),
sloped AS (
  SELECT *, regr_slope(value, t / 1000.0) OVER (PARTITION BY alert, grp ORDER BY t
              RANGE BETWEEN 600000 PRECEDING AND CURRENT ROW) AS slope
  FROM grouped WHERE value IS NOT NULL),
judged AS (
  SELECT *, coalesce(CASE {breach} END AND NOT (isnan(coalesce(slope, 0))
              AND alert = 'Consumer lag climbing'), false) AS breach
  FROM sloped),
marked AS (
  SELECT *, CASE WHEN breach AND NOT (coalesce(lag(breach) OVER w, false)
                                      AND t - lag(t) OVER w <= 15000) THEN t END AS opens
  FROM judged WINDOW w AS (PARTITION BY alert, grp ORDER BY t)),
held AS (
  SELECT *, breach AND t - max(opens) OVER (PARTITION BY alert, grp ORDER BY t)
                     >= (CASE alert {holds} END) * 1000 AS firing
  FROM marked)
SELECT alert, CASE alert {severity} END AS severity, grp AS "group", count(*) AS evaluations,
       count(*) FILTER (breach) AS breaches, count(*) FILTER (firing) AS firings,
       min(CASE WHEN firing THEN make_timestamp((1704067200000 + t) * 1000) END)
         AS first_firing
FROM held GROUP BY alert, grp"""


def _with(*parts: str, then: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + then


def _facts(then: str) -> str:
    return _with(PLAYERS, MATCHES, RANKS, FACTS, then=then)


def _log(then: str) -> str:
    return _with(PLAYERS, MATCHES, RANKS, LOG, then=then)


def _replay(source: str, *more: str, then: str) -> str:
    return _with(PLAYERS, MATCHES, RANKS, ARRIVALS, sessions(source), *more, then=then)


_MS = "make_timestamp({} * 1000)"
_BY_SERIES = (
    "PARTITION BY event_type, shard ORDER BY ts "
    "RANGE BETWEEN INTERVAL {} PRECEDING AND CURRENT ROW"
)
_SEC = "(epoch_us(ts) - 1704067200000000) / 1000000.0"

_FACT_COLUMNS = """match_id, map_name, match_duration_seconds, started_at, ended_at,
  winning_team, player_id, account_name, team, hero_played, kills, deaths, healing, result,
  rank_tier_at_match_start, rank_division_at_match_start, rank_points_at_match_start"""

def _growth(seconds: int, columns: str) -> str:
    return _with(
        SAMPLES,
        then=f"""SELECT event_type, shard, ts, {columns} FROM (
  SELECT a.event_type, a.shard, a.ts, a.counter, sum(b.step) AS increase
  FROM steps a LEFT JOIN steps b
    ON a.event_type = b.event_type AND a.shard = b.shard AND b.ts <= a.ts
    AND b.since >= a.ts - INTERVAL {seconds} SECONDS
  GROUP BY ALL)""",
    )


_HEROES = """SELECT hero_played,
  round(100 * avg(CASE WHEN result = 'win' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 1) AS win_rate,
  round(avg(kills::DOUBLE), 2) AS avg_kills, round(avg(deaths::DOUBLE), 2) AS avg_deaths
FROM match_facts GROUP BY hero_played"""
_LEADERS = """SELECT account_name, count(*) FILTER (result = 'win') AS wins,
  round(avg(kills::DOUBLE / nullif(deaths, 0)), 2) AS kd
FROM match_facts GROUP BY account_name"""

_CONSTRAINTS: list[tuple[str, str, str]] = []
_NO_FIGURES = """NULL::DOUBLE AS win_rate, NULL::DOUBLE AS avg_kills,
  NULL::DOUBLE AS avg_deaths, NULL::DOUBLE AS avg_duration_seconds, NULL::BIGINT AS matches,
  NULL::BIGINT AS wins, NULL::DOUBLE AS kd"""
_KEYS = {
    "players": "id",
    "current_ranks": "player_id",
    "match_events": "id",
    "match_participants": "id",
}
_REQUIRED = {
    "players": ["id", "account_name", "email", "created_at", "account_status"],
    "current_ranks": [
        "player_id", "rank_tier", "rank_division", "rank_points", "wins", "losses", "updated_at",
    ],
    "match_events": ["id", "match_duration_seconds", "started_at", "ended_at", "winning_team"],
    "match_participants": ["id", "match_id", "player_id", "team", "hero_played"],
}
_REFERENCES = [
    ("current_ranks", "player_id", "players"),
    ("match_participants", "match_id", "match_events"),
    ("match_participants", "player_id", "players"),
]
CURRENT = """
current_ranks AS (
  SELECT * EXCLUDE (seq, rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY updated_at DESC, seq DESC) AS rn
    FROM updates) WHERE rn = 1)"""


def _shown(table: str) -> str:
    return "ranks" if table == "current_ranks" else table


def _constraints_sql() -> str:
    def row(table: str, rule: str, count: str) -> str:
        return (
            f"SELECT '{_shown(table)}' AS table_name, '{rule}' AS rule, "
            f"CAST(({count}) AS BIGINT) AS violations"
        )

    def repeats(table: str, column: str) -> str:
        return (
            f"SELECT count(*) FROM (SELECT {column} FROM {table} GROUP BY {column} "
            "HAVING count(*) > 1)"
        )

    rows = []
    for table, key in _KEYS.items():
        rows.append(row(table, f"primary key {key}", repeats(table, key)))
        if table == "players":
            rows.append(row(table, "unique email", repeats(table, "email")))
        for column in _REQUIRED[table]:
            rows.append(
                row(
                    table,
                    f"not null {column}",
                    f"SELECT count(*) FROM {table} WHERE {column} IS NULL",
                )
            )
    for child, column, parent in _REFERENCES:
        rows.append(
            row(
                child,
                f"foreign key {column} to {parent}",
                f"SELECT count(*) FROM {child} c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {parent} p WHERE p.{_KEYS[parent]} = c.{column})",
            )
        )
    return _with(PLAYERS, MATCHES, RANKS, CURRENT, then="\nUNION ALL ".join(rows))


def _references_sql() -> str:
    rows = [
        f"SELECT '{_shown(child)}' AS table_name, '{column}' AS column_name, "
        f"c.{column} AS missing_key, count(*) AS violations FROM {child} c "
        f"LEFT JOIN {parent} p ON p.{_KEYS[parent]} = c.{column} "
        f"WHERE p.{_KEYS[parent]} IS NULL AND c.{column} IS NOT NULL GROUP BY c.{column}"
        for child, column, parent in _REFERENCES
    ]
    return _with(PLAYERS, MATCHES, RANKS, CURRENT, then="\nUNION ALL ".join(rows))


_LOOKUPS = """SELECT count(pl.id) AS player_lookup_hits,
  count(*) - count(pl.id) AS player_lookup_misses
FROM match_participants p LEFT JOIN players pl ON pl.id = p.player_id"""

ORACLES: dict[str, str] = {
    "cdc_source_counts": _log(
        'SELECT topic, count(*) AS messages, min("offset") AS first_offset, '
        'max("offset") AS last_offset FROM log GROUP BY topic'
    ),
    "cdc_unwrap": _log(
        'SELECT topic, "offset", row_key AS key, row_key IS NOT NULL AS has_row FROM log'
    ),
    "cdc_drop_deletes": _log("SELECT topic, \"offset\", fate FROM log WHERE fate <> 'delete'"),
    "cdc_rejects": _log(
        'SELECT topic, "offset", fate AS reason FROM log '
        "WHERE fate IN ('malformed', 'missing_field', 'bad_value')"
    ),
    "decode_after_rejects": _log(
        "SELECT topic, count(*) FILTER (fate = 'row') AS decoded, "
        "count(*) FILTER (fate <> 'row') AS rejected "
        "FROM log WHERE fate <> 'delete' GROUP BY topic"
    ),
    "decode_match_event": _with(MATCHES, then="SELECT * FROM match_events"),
    "decode_participant": _with(MATCHES, then="SELECT * FROM match_participants"),
    "decode_player": _with(PLAYERS, then="SELECT * FROM players"),
    "decode_rank": _with(MATCHES, RANKS, then="SELECT * EXCLUDE (seq) FROM updates"),
    "player_lookup": _facts("SELECT * FROM looked"),
    "lookup_misses": _with(
        PLAYERS,
        MATCHES,
        then="SELECT * FROM match_participants p WHERE NOT EXISTS "
        "(SELECT 1 FROM players pl WHERE pl.id = p.player_id)",
    ),
    "roster_join": _facts("SELECT * FROM rosters"),
    "rank_as_of": _with(MATCHES, RANKS, ALL_AS_OF, then="SELECT * FROM all_as_of"),
    "rank_as_of_broadcast": _with(MATCHES, RANKS, ALL_AS_OF, then="SELECT * FROM all_as_of"),
    "rank_defaulted": _with(
        MATCHES, RANKS, ALL_AS_OF, then="SELECT id, player_id FROM all_as_of WHERE NOT found"
    ),
    "match_facts": _facts(f"SELECT {_FACT_COLUMNS} FROM match_facts"),
    "latest_player": _with(
        PLAYERS,
        MATCHES,
        RANKS,
        ARRIVALS,
        then=f"SELECT * EXCLUDE (arrival, \"offset\", rn), {_MS.format('arrival')} AS arrival_ts "
        'FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY arrival DESC, "offset" DESC) '
        "AS rn FROM player_log) WHERE rn = 1",
    ),
    "rank_history": _with(
        PLAYERS,
        MATCHES,
        RANKS,
        ARRIVALS,
        then=f"SELECT * EXCLUDE (arrival, rn), {_MS.format('arrival')} AS arrival_ts FROM ("
        "SELECT *, row_number() OVER (PARTITION BY player_id, updated_at "
        "ORDER BY arrival DESC, seq DESC) AS rn FROM rank_log) WHERE rn = 1",
    ),
    "quiet_sessions": _replay(
        "arrived",
        then=f"SELECT match_id, {_MS.format('first_ms')} AS session_start, "
        f"{_MS.format('fire_ms')} AS fired_at, participants, events, complete FROM sessions",
    ),
    "buffered_at": _replay(
        "arrived",
        then="""SELECT make_timestamp(scrape * 15000000) AS scraped_at,
  CAST(sum(change) OVER (ORDER BY scrape) AS BIGINT) AS buffered_participants
FROM (
  SELECT scrape, sum(change) AS change FROM (
    SELECT CAST(ceil(arrival / 15000.0) AS BIGINT) AS scrape, 1 AS change FROM arrived
    UNION ALL
    SELECT CAST(ceil(fire_ms / 15000.0) AS BIGINT), -participants FROM sessions)
  GROUP BY scrape)""",
    ),
    "arrival_replay": _replay(
        "arrived", REPLAY, then=f"SELECT id, {_FACT_COLUMNS} FROM replayed"
    ),
    "facts_landed": _facts("SELECT count(*) AS facts FROM match_facts"),
    "hero_win_rate": _facts(_HEROES),
    "map_results": _facts(
        "SELECT map_name, round(avg(match_duration_seconds::DOUBLE), 2) AS avg_duration_seconds, "
        "count(DISTINCT match_id) AS matches FROM match_facts GROUP BY map_name"
    ),
    "player_leaderboard": _facts(_LEADERS),
    "rank_as_of_mix": _facts(
        "SELECT rank_tier_at_match_start, rank_division_at_match_start, count(*) AS facts "
        "FROM match_facts GROUP BY ALL"
    ),
    "rank_vs_result": _facts(
        "SELECT rank_tier_at_match_start, result, count(*) AS facts "
        "FROM match_facts GROUP BY ALL"
    ),
    "player_timeline": _facts(
        "SELECT player_id, started_at, result, rank_tier_at_match_start, "
        "rank_division_at_match_start, rank_points_at_match_start FROM match_facts "
        "ORDER BY player_id, started_at, match_id, id LIMIT 20"
    ),
    "hero_top": _facts(f"{_HEROES} ORDER BY win_rate DESC, hero_played LIMIT 100"),
    "leaderboard_top": _facts(f"{_LEADERS} ORDER BY wins DESC, account_name LIMIT 100"),
    "dataset_row_counts": _facts(
        """SELECT 'hero_win_rate' AS dataset, count(*) AS rows
  FROM (SELECT DISTINCT hero_played FROM match_facts)
UNION ALL SELECT 'map_results', count(*) FROM (SELECT DISTINCT map_name FROM match_facts)
UNION ALL SELECT 'player_leaderboard', count(*)
  FROM (SELECT DISTINCT account_name FROM match_facts)
UNION ALL SELECT 'rank_as_of_mix', count(*)
  FROM (SELECT DISTINCT rank_tier_at_match_start, rank_division_at_match_start
        FROM match_facts)
UNION ALL SELECT 'rank_vs_result', count(*)
  FROM (SELECT DISTINCT rank_tier_at_match_start, result FROM match_facts)"""
    ),
    "dashboard_reports": _facts(
        f"""SELECT 'facts_landed' AS report, NULL AS key_1, NULL AS key_2, count(*) AS facts,
  {_NO_FIGURES} FROM match_facts
UNION ALL SELECT 'hero_win_rate', hero_played, NULL, facts, win_rate, avg_kills, avg_deaths,
  NULL, NULL, NULL, NULL
  FROM ({_HEROES}) JOIN (SELECT hero_played, count(*) AS facts FROM match_facts GROUP BY ALL)
  USING (hero_played)
UNION ALL SELECT 'map_results', map_name, NULL, count(*), NULL, NULL, NULL,
  round(avg(match_duration_seconds::DOUBLE), 2), count(DISTINCT match_id), NULL, NULL
  FROM match_facts GROUP BY map_name
UNION ALL SELECT 'player_leaderboard', account_name, NULL, facts, NULL, NULL, NULL, NULL, NULL,
  wins, kd
  FROM ({_LEADERS}) JOIN (SELECT account_name, count(*) AS facts FROM match_facts GROUP BY ALL)
  USING (account_name)
UNION ALL SELECT 'rank_as_of_mix', rank_tier_at_match_start,
  CAST(rank_division_at_match_start AS VARCHAR), count(*), {_NO_FIGURES}
  FROM match_facts GROUP BY rank_tier_at_match_start, rank_division_at_match_start
UNION ALL SELECT 'rank_vs_result', rank_tier_at_match_start, result, count(*), {_NO_FIGURES}
  FROM match_facts GROUP BY rank_tier_at_match_start, result"""
    ),
    "derive_rank": _with(
        MATCHES,
        then=f"SELECT id, points, {tier('points')} AS rank_tier, "
        f"{division('points')} AS rank_division "
        "FROM (SELECT id, healing % 2600 - 100 AS points FROM match_participants)",
    ),
    "rank_points_history": _with(
        MATCHES,
        RANKS,
        then="SELECT player_id, t AS updated_at, seq, CAST(pts AS INT) AS rank_points FROM walk",
    ),
    "wins_losses_history": _with(
        MATCHES,
        RANKS,
        then="SELECT player_id, t AS updated_at, seq, CAST(wins AS BIGINT) AS wins, "
        "CAST(losses AS BIGINT) AS losses FROM walk",
    ),
    "current_rank": _with(MATCHES, RANKS, CURRENT, then="SELECT * FROM current_ranks"),
    "match_quality": _with(
        MATCHES,
        then="""SELECT e.id AS match_id,
  CASE WHEN p.n <> 12 THEN 1 ELSE 0 END AS roster,
  CASE WHEN p.t0 <> 6 OR p.t1 <> 6 THEN 1 ELSE 0 END AS teams,
  p.wrong AS results,
  CASE WHEN CAST(floor(epoch(e.ended_at)) AS BIGINT) - CAST(floor(epoch(e.started_at)) AS BIGINT)
            <> e.match_duration_seconds THEN 1 ELSE 0 END AS end_time,
  CASE WHEN e.match_duration_seconds NOT BETWEEN 300 AND 1200 THEN 1 ELSE 0 END AS duration
FROM match_events e JOIN (
  SELECT match_id, count(*) AS n, count(*) FILTER (team = 0) AS t0,
         count(*) FILTER (team = 1) AS t1,
         count(*) FILTER (result <> CASE WHEN team = m.winning_team THEN 'win' ELSE 'loss' END)
           AS wrong
  FROM match_participants JOIN match_events m ON m.id = match_id GROUP BY match_id) p
ON p.match_id = e.id""",
    ),
    "constraint_report": _constraints_sql(),
    "fk_violations": _references_sql(),
    "roster_quality": _replay(
        "arrived",
        then="SELECT count(*) FILTER (complete) AS complete, "
        "count(*) FILTER (NOT complete) AS incomplete FROM sessions",
    ),
    "final_roster_quality": _facts(
        """SELECT count(*) FILTER (n = 12 AND has_event) AS complete,
  count(*) FILTER (NOT (n = 12 AND has_event)) AS incomplete
FROM (SELECT coalesce(r.n, 0) AS n, e.id IS NOT NULL AS has_event
      FROM (SELECT match_id, count(*) AS n FROM looked GROUP BY match_id) r
      FULL JOIN match_events e ON e.id = r.match_id)"""
    ),
    "lookup_quality": _with(PLAYERS, MATCHES, then=_LOOKUPS),
    "lookup_miss_rate": _with(
        PLAYERS,
        MATCHES,
        then="SELECT player_lookup_misses::DOUBLE / greatest(player_lookup_hits + "
        f"player_lookup_misses, 1) AS miss_rate FROM ({_LOOKUPS})",
    ),
    "rank_quality": _facts(
        "SELECT count(*) FILTER (found) AS rank_as_of_found, "
        "count(*) FILTER (NOT found) AS rank_as_of_defaulted FROM match_facts"
    ),
    "rank_default_rate": _facts(
        "SELECT count(*) FILTER (NOT found)::DOUBLE / greatest(count(*), 1) AS default_rate "
        "FROM match_facts"
    ),
    "metric_select": _with(
        SAMPLES,
        then="SELECT event_type, shard, ts, 'session_value' AS name, gauge AS value "
        "FROM numbered_events WHERE shard = '1' "
        "AND (event_type LIKE 'c%' OR event_type LIKE '%w')",
    ),
    "metric_increase": _growth(86400, "counter AS value, increase"),
    "metric_rate": _growth(3600, "round(increase / 3600, 9) AS rate"),
    "metric_deriv": _with(
        SAMPLES,
        then="SELECT event_type, shard, ts, CASE WHEN n >= 2 THEN round(m, 8) END AS slope FROM ("
        f"SELECT *, regr_slope(gauge, {_SEC}) OVER w AS m, count(*) OVER w AS n "
        f"FROM numbered_events WINDOW w AS ({_BY_SERIES.format('172800 SECONDS')}))",
    ),
    "metric_sum_by": _with(
        SAMPLES,
        then="SELECT event_type, ts, round(value, 4) AS value, highest, series_count "
        "FROM hourly_sums",
    ),
    "metric_ratio": _with(
        SAMPLES,
        then="""SELECT concat('[{"key":"event_type","value":"', event_type,
  '"},{"key":"shard","value":"', shard, '"}]') AS series, ts, round(ratio, 6) AS value
FROM (SELECT *, CASE WHEN gauge <> 0 THEN counter / gauge WHEN counter > 0
                     THEN CAST('inf' AS DOUBLE) END AS ratio FROM hourly) WHERE ratio > 0.8""",
    ),
    "metric_or_zero": f"""
WITH {RAW_SAMPLES},
sampled AS (SELECT ms, CAST({_turn(40, '12000 + n', 'n')} AS DOUBLE) AS v FROM raw WHERE i = 8),
ticks AS (SELECT unnest(range(0, max(ms) + 960000, 15000)) AS t FROM raw),
seen AS (
  SELECT t.t, x.v FROM ticks t ASOF JOIN sampled x ON t.t >= x.ms WHERE t.t - x.ms <= 300000)
SELECT make_timestamp((1704067200000 + t.t) * 1000) AS ts, coalesce(seen.v, 0) AS value
FROM ticks t LEFT JOIN seen ON seen.t = t.t
WHERE t.t BETWEEN (SELECT min(t) FROM seen) AND (SELECT max(t) FROM seen)""",
    "alert_lag_climbing": _with(
        SAMPLES,
        then="SELECT event_type, ts, round(value, 4) AS value, round(m, 8) AS slope FROM ("
        f"SELECT *, regr_slope(value, {_SEC}) OVER w AS m, count(*) OVER w AS n "
        "FROM hourly_sums WINDOW w AS (PARTITION BY event_type ORDER BY ts "
        "RANGE BETWEEN INTERVAL 21600 SECONDS PRECEDING AND CURRENT ROW)) "
        "WHERE n >= 2 AND value > 100 AND m > 0.002",
    ),
    "alert_hold": _with(
        SAMPLES,
        """marked AS (
  SELECT *, gauge > 5 AS high,
         CASE WHEN gauge > 5 AND NOT (coalesce(lag(gauge > 5) OVER w, false)
                                      AND ts - lag(ts) OVER w <= INTERVAL 1 HOUR)
              THEN ts END AS opens
  FROM hourly WINDOW w AS (PARTITION BY event_type, shard ORDER BY ts))""",
        then="""SELECT event_type, shard, ts, gauge AS value,
  CASE WHEN NOT high THEN 'inactive'
       WHEN ts - max(opens) OVER (PARTITION BY event_type, shard ORDER BY ts)
            >= INTERVAL 43200 SECONDS THEN 'firing'
       ELSE 'pending' END AS state
FROM marked""",
    ),
    "alert_report": _alerts_sql(),
}
