"""For each registered query, SQL that computes the same result independently.

The SQL follows the plain wording of each question, for instance a double outer
join with COUNT(DISTINCT) for station counts, so it does not share the rewrites
of the operators it checks.
"""

from __future__ import annotations

from tripweave.model import ERROR_VALUES, EVENT_TYPES, TRIP_DOCUMENT
from tripweave.operators import synth
from tripweave.plans.registry import (
    DELETED_COUNTRY,
    EVENTS_PER_TRIP,
    LARGE_STATION,
    LATEST_TRIPS,
    LOADED_FIRST,
    REACHABLE_FROM,
    REPEATED_BELOW,
    SEED,
)


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# The star-schema view.
VIEW = {
    "users": """
        SELECT c_custkey AS user_id, c_name AS name, c_mktsegment AS surname,
               CAST(DATE '2023-01-01' - CAST(18*365 + (c_custkey*7919) % 15331 AS INTEGER) AS DATE) AS birthdate,
               n_name AS country
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "stations": """
        SELECT s_suppkey AS station_id, s_name AS name, n_name AS city, 5 + s_suppkey % 46 AS capacity
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "lines": """
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) AS first_n,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_suppkey DESC) AS last_n
        FROM lineitem""",
    "trips_raw": """
        SELECT o_orderkey AS trip_id, o_custkey AS user_id, f.l_suppkey AS start_station, l.l_suppkey AS end_station,
               o_orderdate AS start_time, m.end_time, CAST(o_totalprice AS DECIMAL(8,2)) AS total_cost
        FROM orders
        LEFT JOIN lines f ON f.l_orderkey = o_orderkey AND f.first_n = 1
        LEFT JOIN lines l ON l.l_orderkey = o_orderkey AND l.last_n = 1
        LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS end_time FROM lineitem GROUP BY l_orderkey) m
               ON m.l_orderkey = o_orderkey""",
    "trips": """
        SELECT * FROM trips_raw
        WHERE start_station IS NOT NULL AND end_station IS NOT NULL AND end_time > start_time AND total_cost >= 0""",
    "mobility_events": f"""
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
                 || strftime(l_shipdate, '%Y%m%d') AS event_id,
               l_orderkey AS trip_id, l_shipdate AS "timestamp",
               CASE l_returnflag WHEN 'R' THEN 'ERROR' WHEN 'A' THEN 'GPS'
                    ELSE CASE l_linestatus WHEN 'O' THEN 'BATTERY' ELSE 'DELAY' END END AS event_type,
               CASE l_returnflag
                    WHEN 'R' THEN {_list(ERROR_VALUES)}[1 + l_partkey % 4]
                    WHEN 'A' THEN (37 + l_partkey % 10) || '.' || lpad(CAST(l_suppkey % 1000000 AS VARCHAR), 6, '0')
                         || ',' || (7 + l_partkey % 8) || '.' || lpad(CAST(l_partkey % 1000000 AS VARCHAR), 6, '0')
                    ELSE CASE l_linestatus WHEN 'O' THEN CAST(CAST(l_quantity*2 AS INTEGER) AS VARCHAR)
                                           ELSE CAST(1 + l_partkey % 60 AS VARCHAR) END END AS "value"
        FROM lineitem""",
}


def _with(body: str, recursive: str = "", extra: dict[str, str] | None = None) -> str:
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in {**VIEW, **(extra or {})}.items())
    if recursive:
        ctes += ",\n" + recursive
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}"


_COST = "CAST(total_cost AS DOUBLE) AS total_cost"
_MINUTES = "epoch(t.end_time - t.start_time) / 60.0"


def _user_stats(mean: str) -> str:
    return f"""
        SELECT u.user_id, u.name, u.surname, count(t.trip_id) AS num_trips, {mean} AS avg_duration_minutes
        FROM users u LEFT JOIN trips t ON u.user_id = t.user_id
        GROUP BY u.user_id, u.name, u.surname"""


_AVERAGE = f"round(avg({_MINUTES}), 2)"


def _active_counts(trips: str, stations: str) -> str:
    return f"""
        SELECT s.station_id, s.name AS station_name, s.city,
               CAST(sum(CASE WHEN role = 'start' THEN 1 ELSE 0 END) AS BIGINT) AS trips_starting,
               CAST(sum(CASE WHEN role = 'end' THEN 1 ELSE 0 END) AS BIGINT) AS trips_ending
        FROM (SELECT start_station AS station_id, 'start' AS role FROM {trips}
              UNION ALL SELECT end_station, 'end' FROM {trips}) r
        JOIN {stations} s ON s.station_id = r.station_id
        GROUP BY s.station_id, s.name, s.city"""


# Trips whose ends all exist, and their typed edges.
_EDGE_SET = {
    "joined": """
        SELECT * FROM trips WHERE user_id IN (SELECT user_id FROM users)
        AND start_station IN (SELECT station_id FROM stations) AND end_station IN (SELECT station_id FROM stations)""",
    "edge_set": """
        SELECT DISTINCT CASE k WHEN 0 THEN 'U:' || user_id ELSE 'T:' || trip_id END AS src,
               CASE k WHEN 0 THEN 'T:' || trip_id WHEN 1 THEN 'S:' || start_station ELSE 'S:' || end_station END AS dst,
               ['PERFORMED', 'STARTS_AT', 'ENDS_AT'][k + 1] AS type
        FROM range(3) kinds(k), joined""",
}

_DEGREES = """
        SELECT station_id, name AS station_name, city, outgoing_trips, incoming_trips,
               outgoing_trips + incoming_trips AS total_trips
        FROM (SELECT s.*, (SELECT count(*) FROM edge_set e WHERE e.dst = 'S:' || s.station_id AND e.type = 'STARTS_AT')
                     AS outgoing_trips,
                     (SELECT count(*) FROM edge_set e WHERE e.dst = 'S:' || s.station_id AND e.type = 'ENDS_AT')
                     AS incoming_trips FROM stations s)"""

# Stations at the far end of PERFORMED and then STARTS_AT or ENDS_AT.
_REACHED = """
        SELECT station_id, name, city FROM stations WHERE 'S:' || station_id IN (
            SELECT dst FROM edge_set WHERE type <> 'PERFORMED' AND src IN (
                SELECT dst FROM edge_set WHERE type = 'PERFORMED' AND src = {rider}))"""

_REACHABLE = "SELECT station_id, name AS station_name, city FROM (" + _REACHED.format(rider=f"'U:{REACHABLE_FROM}'") + ")"

_WITH_ERROR = "trip_id IN (SELECT trip_id FROM mobility_events WHERE event_type = 'ERROR' GROUP BY trip_id)"
_STATION_NAME = "(SELECT name FROM stations WHERE station_id = t.{}_station)"
_BOTH_STATIONS = f"{_STATION_NAME.format('start')} IS NOT NULL AND {_STATION_NAME.format('end')} IS NOT NULL"

# The stations as the upsert leaves them: every rider is a station too, and most of these have no trip.
_ALL_STATIONS = """
            SELECT station_id, name || ' (closed)' AS name, city, NULL::BIGINT AS capacity FROM stations
            UNION ALL
            SELECT user_id, name, NULL, length(surname) FROM users
            WHERE user_id NOT IN (SELECT station_id FROM stations)"""


def _pagerank() -> dict[str, str]:
    steps = {
        "degree": "SELECT start_station AS src, count(*) AS d FROM trips GROUP BY 1",
        "n": "SELECT count(*) AS n FROM stations",
        "r0": "SELECT station_id, 1.0::DOUBLE / n AS rank FROM stations, n",
    }
    for i in range(1, 21):
        steps[f"r{i}"] = f"""
            SELECT s.station_id, 0.15::DOUBLE / n.n + 0.85::DOUBLE * coalesce(c.share, 0) AS rank
            FROM stations s CROSS JOIN n LEFT JOIN (
                SELECT t.end_station AS station_id, sum(p.rank / d.d) AS share
                FROM trips t JOIN degree d ON d.src = t.start_station JOIN r{i - 1} p ON p.station_id = t.start_station
                GROUP BY t.end_station) c ON c.station_id = s.station_id"""
    steps["ranked"] = """
        SELECT s.station_id, s.name, round(r.rank, 8) AS rank
        FROM stations s JOIN r20 r ON r.station_id = s.station_id"""
    return steps


def _components(body: str) -> str:
    reach = """
        link AS (SELECT DISTINCT start_station AS a, end_station AS b FROM trips
                 UNION SELECT DISTINCT end_station, start_station FROM trips),
        reach(station_id, reached) AS (
            SELECT station_id, station_id FROM stations
            UNION
            SELECT r.station_id, link.b FROM reach r JOIN link ON link.a = r.reached),
        comp AS (SELECT station_id, min(reached) AS component FROM reach GROUP BY station_id)"""
    return _with(body, reach)


def _spread(rounds: int = 24) -> dict[str, str]:
    """The least node of each component of the raw property graph, by passing the least label on along
    the edges; more rounds than any shortest path has edges."""
    steps = {
        "raw_joined": _EDGE_SET["joined"].replace("FROM trips ", "FROM trips_raw "),
        "raw_edges": _EDGE_SET["edge_set"].replace("kinds(k), joined", "kinds(k), raw_joined"),
        "nodes": """
            SELECT 'U:' || user_id AS id, name FROM users UNION ALL SELECT 'T:' || trip_id, NULL FROM trips_raw
            UNION ALL SELECT 'S:' || station_id, name FROM stations""",
        "l0": "SELECT id, id AS component FROM nodes",
        "both_ways": """
            SELECT src AS a, dst AS b FROM raw_edges UNION ALL SELECT dst, src FROM raw_edges
            UNION ALL SELECT id, id FROM nodes""",
    }
    for i in range(1, rounds + 1):
        steps[f"l{i}"] = f"SELECT a AS id, min(component) AS component FROM both_ways JOIN l{i - 1} ON id = b GROUP BY a"
    steps["settled"] = f"SELECT id, component FROM l{rounds}"
    return steps


_SIZES = """
        SELECT c.component, s.name AS root_name, count(*) AS size
        FROM comp c JOIN stations s ON s.station_id = c.component GROUP BY c.component, s.name"""


def _count(rule: str, table: str, condition: str) -> str:
    return f"SELECT '{rule}' AS rule, count(*) AS n_violations FROM {table} WHERE {condition}"


_TABLES = {"users": "users", "stations": "stations", "trips": "trips_raw", "events": "mobility_events"}
_COLUMNS = {
    "users": ["user_id", "name", "surname", "birthdate", "country"],
    "stations": ["station_id", "name", "city", "capacity"],
    "trips": ["trip_id", "user_id", "start_station", "end_station", "start_time", "end_time", "total_cost"],
    "events": ["event_id", "trip_id", "timestamp", "event_type", "value"],
}
_KINDS = "(" + ", ".join(f"'{k}'" for k in EVENT_TYPES) + ")"

_NOT_NULL = [
    _count(f"{t}.{c}.not_null", _TABLES[t], f'"{c}" IS NULL') for t, columns in _COLUMNS.items() for c in columns
]
_VALUES = [
    _count("stations.capacity_positive", "stations", "NOT capacity > 0"),
    _count("trips.cost_not_negative", "trips_raw", "NOT total_cost >= 0"),
    _count("trips.ends_after_start", "trips_raw", "NOT end_time > start_time"),
]
_ENUM = [_count("events.event_type.enum", "mobility_events", f"event_type NOT IN {_KINDS}")]
_LENGTHS = [
    _count(f"{t}.{c}.length", _TABLES[t], f"length({c}) > {n}")
    for t, c, n in [
        ("users", "name", 100),
        ("users", "surname", 100),
        ("users", "country", 100),
        ("stations", "name", 150),
        ("stations", "city", 100),
        ("events", "event_type", 10),
    ]
]
_UNIQUE = [
    f"SELECT '{t}.{columns[0]}.unique' AS rule, count({columns[0]}) - count(DISTINCT {columns[0]}) AS n_violations "
    f"FROM {_TABLES[t]}"
    for t, columns in _COLUMNS.items()
]


def _orphans(rule: str, child: str, column: str, parent: str, key: str) -> str:
    missing = f"NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column})"
    return _count(rule, f"{child} c", f"c.{column} IS NOT NULL AND {missing}")


_FOREIGN = [
    _orphans("trips.user_id.foreign_key", "trips_raw", "user_id", "users", "user_id"),
    _orphans("trips.start_station.foreign_key", "trips_raw", "start_station", "stations", "station_id"),
    _orphans("trips.end_station.foreign_key", "trips_raw", "end_station", "stations", "station_id"),
    _orphans("events.trip_id.foreign_key", "mobility_events", "trip_id", "trips_raw", "trip_id"),
]

# Documents: a rule about events counts the trips that have an offending event.
_DOC_EVENTS = "(SELECT DISTINCT e.trip_id FROM mobility_events e JOIN trips_raw t ON t.trip_id = e.trip_id WHERE {}) d"
_LEVEL = """CASE WHEN event_type = 'BATTERY' THEN CAST("value" AS BIGINT) END"""
_DOCUMENTS = (
    [
        _count(f"trips.{name}.required", "trips_raw", f"{column} IS NULL")
        for name, column in [
            ("user_id", "user_id"),
            ("start_station_id", "start_station"),
            ("end_station_id", "end_station"),
            ("start_time", "start_time"),
            ("end_time", "end_time"),
            ("total_cost", "total_cost"),
        ]
    ]
    + [_count("trips.events.required", "trips_raw", "false")]
    + [
        _count(f"trips.events.{c}.required", _DOC_EVENTS.format(f'"{c}" IS NULL'), "true")
        for c in ("timestamp", "event_type", "value")
    ]
    + [
        _count("trips.events.event_type.enum", _DOC_EVENTS.format(f"event_type NOT IN {_KINDS}"), "true"),
        _count("trips.events.battery_level.range", _DOC_EVENTS.format(f"NOT ({_LEVEL}) BETWEEN 0 AND 100"), "true"),
    ]
    + [_count(f"users.{c}.required", "users", f"{c} IS NULL") for c in _COLUMNS["users"][1:]]
    + [_count(f"stations.{c}.required", "stations", f"{c} IS NULL") for c in _COLUMNS["stations"][1:]]
    + [_count("stations.capacity.minimum", "stations", "capacity < 1")]
)
def _types(collection: str, fields: list[str], broken: dict[str, str] | None = None) -> list[str]:
    return [
        (broken or {}).get(f) or _count(f"{collection}.{f}" if f == "json" else f"{collection}.{f}.type", "stations", "false")
        for f in ["json", *fields]
    ]


_TRIP_FIELDS = [f.name for f in TRIP_DOCUMENT.fields]
_NUMBER_OR_RANGE = "TRY_CAST(\"value\" AS INTEGER) IS NULL"
_DOCUMENT_TYPES = (
    _types("trips", _TRIP_FIELDS, {"events": _count("trips.events.type", _DOC_EVENTS.format(_NUMBER_OR_RANGE), "true")})
    + _types("users", _COLUMNS["users"], {"user_id": _count("users.user_id.type", "users", f"country = '{DELETED_COUNTRY}'")})
    + _types("stations", _COLUMNS["stations"], {"capacity": _count("stations.capacity.type", "stations", f"capacity > {LARGE_STATION}")})
)


def _rules(parts: list[str]) -> str:
    return _with("\nUNION ALL ".join(parts))


_TRIP_RULES = [
    (f"trips.{c}.not_null", f"{c} IS NULL") for c in _COLUMNS["trips"]
] + [
    ("trips.cost_not_negative", "NOT total_cost >= 0"),
    ("trips.ends_after_start", "NOT end_time > start_time"),
    ("trips.user_id.foreign_key", "user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM users)"),
    (
        "trips.start_station.foreign_key",
        "start_station IS NOT NULL AND start_station NOT IN (SELECT station_id FROM stations)",
    ),
    (
        "trips.end_station.foreign_key",
        "end_station IS NOT NULL AND end_station NOT IN (SELECT station_id FROM stations)",
    ),
    ("trips.trip_id.unique", "trip_id IN (SELECT trip_id FROM trips_raw GROUP BY trip_id HAVING count(*) > 1)"),
]
_REJECTED = "\nUNION ALL ".join(
    f"SELECT trip_id, '{rule}' AS rule FROM trips_raw WHERE {broken}" for rule, broken in _TRIP_RULES
)

_EVENT_COLUMNS = 'event_id, trip_id, event_type, "value"'


def _battery(rule: str, broken: str) -> str:
    before = broken.format(level="CAST(NULL AS BIGINT)")
    after = broken.format(level=f"({_LEVEL})")
    return _rules(
        [_count(f"{rule}.before", "mobility_events", before), _count(f"{rule}.after", "mobility_events", after)]
    )


_DAMAGED = _with(f"""
    SELECT trip_id, CASE WHEN total_cost <= {2 * REPEATED_BELOW} THEN 'damaged' ELSE 'accepted' END AS state FROM trips""")

# Documents of two versions in one folder.
_VERSIONED = {
    "versioned": f"SELECT *, CASE WHEN total_cost < {LOADED_FIRST} THEN 1::BIGINT ELSE 2 END AS version FROM trips_raw",
    "with_level": "SELECT DISTINCT trip_id FROM mobility_events WHERE event_type = 'BATTERY'",
}
_VERSION_RULES = [
    *[(f"trips.{c}.required", f"{c.replace('station_id', 'station')} IS NULL")
      for c in ("user_id", "start_station_id", "end_station_id", "start_time", "end_time", "total_cost")],
    ("trips.events.required", "false"),
    *[(f"trips.events.{c}.required", f'trip_id IN (SELECT trip_id FROM mobility_events WHERE "{c}" IS NULL)')
      for c in ("timestamp", "event_type", "value")],
    ("trips.events.event_type.enum", f"trip_id IN (SELECT trip_id FROM mobility_events WHERE event_type NOT IN {_KINDS})"),
    ("trips.events.battery_level.range",
     f"version = 2 AND trip_id IN (SELECT trip_id FROM mobility_events WHERE NOT ({_LEVEL}) BETWEEN 0 AND 100)"),
    ("trips.events.battery_level.absent", f"version = 1 AND total_cost < {REPEATED_BELOW} AND trip_id IN (SELECT trip_id FROM with_level)"),
]
_VERSIONS = _with(
    "\nUNION ALL ".join(
        f"SELECT {v}::BIGINT AS version, '{rule}' AS rule, count(*) AS n_violations FROM versioned WHERE version = {v} AND {broken}"
        for v in (1, 2)
        for rule, broken in _VERSION_RULES
    ),
    extra=_VERSIONED,
)

# Departures and arrivals of every station.
_STATION_COUNTS = _with("""
    SELECT station_id, name, city,
           coalesce((SELECT n FROM leaving WHERE k = station_id), 0) AS trips_starting,
           coalesce((SELECT n FROM arriving WHERE k = station_id), 0) AS trips_ending
    FROM stations""",
    extra={"leaving": "SELECT start_station AS k, count(*) AS n FROM trips GROUP BY 1",
           "arriving": "SELECT end_station AS k, count(*) AS n FROM trips GROUP BY 1"})

# Riders of one country, their trips and their events are gone.
_DELETED_USERS = _with(f"""
    SELECT 'users' AS table_name, count(*) AS n_remaining, min(CAST(user_id AS VARCHAR)) AS min_id,
           max(CAST(user_id AS VARCHAR)) AS max_id FROM users WHERE country <> '{DELETED_COUNTRY}'
    UNION ALL
    SELECT 'trips', count(*), min(CAST(trip_id AS VARCHAR)), max(CAST(trip_id AS VARCHAR)) FROM trips_raw t
    WHERE NOT EXISTS (SELECT 1 FROM doomed d WHERE d.user_id = t.user_id)
    UNION ALL
    SELECT 'events', count(*), min(event_id), max(event_id) FROM mobility_events e
    WHERE NOT EXISTS (SELECT 1 FROM trips_raw t JOIN doomed d ON d.user_id = t.user_id
                      WHERE t.trip_id = e.trip_id)""",
    extra={"doomed": f"SELECT user_id FROM users WHERE country = '{DELETED_COUNTRY}'"})


# ---- Generator: the same draws --------------------------------------------------


def _draw(column: str, key: str) -> str:
    return f"CAST('0x' || substr(md5('{SEED}:{column}:' || ({key})), 1, 15) AS BIGINT)"


def _below(n: int | str, column: str, key: str) -> str:
    return f"({_draw(column, key)} % {n})"


def _from(values: list[str], column: str, key: str) -> str:
    return f"{_list(values)}[1 + {_below(len(values), column, key)}]"


def _in_year(column: str, key: str) -> str:
    return (
        f"(TIMESTAMP '2023-01-01' + to_days(CAST({_below(366, column + ':day', key)} AS INTEGER)) "
        f"+ to_seconds({_below(86400, column + ':second', key)}))"
    )


def _degrees(low: int, high: int, column: str, key: str) -> str:
    micro = f"({low * 1000000} + {_below((high - low) * 1000000 + 1, column, key)})"
    return f"({micro} // 1000000) || '.' || lpad(CAST({micro} % 1000000 AS VARCHAR), 6, '0')"


_CITY = _from(synth.CITIES, "station:city", "s_suppkey + 1")
_MADE_TRIPS = f"""
        SELECT id AS trip_id,
               1 + {_below("(SELECT count(*) FROM users)", "trip:user", "id")} AS user_id,
               1 + {_below("(SELECT count(*) FROM stations)", "trip:from", "id")} AS start_station,
               1 + {_below("(SELECT count(*) FROM stations)", "trip:to", "id")} AS end_station,
               {_in_year("trip:start", "id")} AS start_time,
               {_in_year("trip:start", "id")} + to_minutes(5 + {_below(176, "trip:minutes", "id")}) AS end_time,
               (50 + {_below(2451, "trip:cost", "id")}) / 100 AS total_cost
        FROM (SELECT o_orderkey + 1 AS id FROM orders)"""
_MADE_VALUE = f"""
               CASE event_type
                    WHEN 'GPS' THEN {_degrees(37, 47, "event:lat", "event_id")} || ','
                                    || {_degrees(7, 15, "event:lon", "event_id")}
                    WHEN 'ERROR' THEN {_from(ERROR_VALUES, "event:error", "event_id")}
                    WHEN 'BATTERY' THEN CAST({_below(101, "event:battery", "event_id")} AS VARCHAR)
                    ELSE CAST(1 + {_below(60, "event:delay", "event_id")} AS VARCHAR) END AS "value" """
_MADE_EVENTS = {
    "made_trips": _MADE_TRIPS,
    "made_keys": f"""
        SELECT trip_id, start_time, (trip_id - 1) * {EVENTS_PER_TRIP} + i AS event_id
        FROM made_trips, range(1, {EVENTS_PER_TRIP + 1}) r(i)""",
    "made_events": f"""
        SELECT *, {_from(EVENT_TYPES, "event:type", "event_id")} AS event_type FROM made_keys""",
}

_COST_TABLE = _with(f"SELECT trip_id, user_id, {_COST} FROM trips")


def oracle_sql() -> dict[str, str]:
    """name -> SQL over the star-schema tables."""
    ranks = _pagerank()
    return {
        "q1_trip_details": _with(f"""
            SELECT t.trip_id, u.user_id, u.name AS user_name, u.surname AS user_surname,
                   CAST(u.birthdate AS VARCHAR) AS birthdate, u.country,
                   {_STATION_NAME.format("start")} AS start_station, {_STATION_NAME.format("end")} AS end_station,
                   t.start_time, t.end_time, {_COST}
            FROM users u, trips t WHERE t.user_id = u.user_id AND {_BOTH_STATIONS}"""),
        "q1_trip_documents": _with(f"""
            SELECT t.trip_id AS _id, t.trip_id, u.user_id, u.name AS user_name, u.surname AS user_surname,
                   CAST(u.birthdate AS VARCHAR) AS user_birthdate, u.country AS user_country,
                   {_STATION_NAME.format("start")} AS start_station_name,
                   {_STATION_NAME.format("end")} AS end_station_name, t.start_time, t.end_time, {_COST}
            FROM users u, trips t WHERE t.user_id = u.user_id AND {_BOTH_STATIONS}"""),
        "io_documents_report": _with(f"""
            SELECT t.trip_id AS _id, t.trip_id, u.user_id, u.name AS user_name, u.surname AS user_surname,
                   CAST(u.birthdate AS VARCHAR) AS user_birthdate, u.country AS user_country,
                   {_STATION_NAME.format("start")} AS start_station_name,
                   {_STATION_NAME.format("end")} AS end_station_name, t.start_time, t.end_time, {_COST}
            FROM users u, trips t WHERE t.user_id = u.user_id AND {_BOTH_STATIONS}"""),
        "q2_user_stats": _with(_user_stats(_AVERAGE)),
        "q2_user_stats_merged": _with(_user_stats(_AVERAGE)),
        "q2_user_stats_zero": _with(_user_stats(f"coalesce({_AVERAGE}, 0)")),
        "q2_user_stats_nested": _with(_user_stats(f"coalesce({_AVERAGE}, 0)")),
        "q2_user_stats_staged": _with(f"""
            SELECT CAST(user_id AS VARCHAR) AS user_id, name, surname, num_trips, avg_duration_minutes
            FROM ({_user_stats(f"coalesce({_AVERAGE}, 0)")})"""),
        "q2_active_user_stats": _with(f"""
            SELECT user_id, count(*) AS num_trips, {_AVERAGE} AS avg_duration_minutes FROM trips t GROUP BY user_id"""),
        "q3_station_counts": _STATION_COUNTS,
        "q3_station_counts_merged": _STATION_COUNTS,
        "q3_active_station_counts": _with(_active_counts("trips", "all_stations"), extra={"all_stations": _ALL_STATIONS}),
        **{
            name: _with(f"SELECT trip_id, user_id, start_time, end_time, {_COST} FROM trips WHERE {_WITH_ERROR}")
            for name in ("q4_error_trips", "q4_error_trips_distinct", "q4_error_trips_embedded", "io_documents_q4")
        },
        "trips_sorted": _with("SELECT trip_id, user_id, start_time FROM trips ORDER BY trip_id"),
        "trips_latest": _with(f"""
            SELECT trip_id, user_id, start_time FROM trips ORDER BY trip_id DESC LIMIT {LATEST_TRIPS}"""),
        "doc_facet_station_roles": _with("""
            SELECT start_station AS station_id, 'start' AS role, count(*) AS n FROM trips GROUP BY 1
            UNION ALL SELECT end_station, 'end', count(*) FROM trips GROUP BY 1"""),
        "doc_embed_events": _with("""
            SELECT t.trip_id, count(e.event_id) AS n_events,
                   count(CASE WHEN e.event_type = 'ERROR' THEN 1 END) AS n_error,
                   min(e.event_id) AS first_event_id, max(e.event_id) AS last_event_id
            FROM trips t LEFT JOIN mobility_events e ON t.trip_id = e.trip_id GROUP BY t.trip_id"""),
        "doc_unwind_events": _with("""
            SELECT trip_id, event_id, "timestamp", event_type, "value" FROM mobility_events
            WHERE trip_id IN (SELECT trip_id FROM trips)"""),
        "doc_lookup_user_trips": _with("""
            SELECT u.user_id, count(t.trip_id) AS n_trips, CAST(coalesce(sum(t.total_cost), 0) AS DOUBLE) AS total_cost
            FROM users u LEFT JOIN trips t ON u.user_id = t.user_id GROUP BY u.user_id"""),
        "events_typed": _with("""
            SELECT event_id, event_type,
                   CASE WHEN event_type = 'GPS' THEN CAST(split_part("value", ',', 1) AS DOUBLE) END AS lat,
                   CASE WHEN event_type = 'GPS' THEN CAST(split_part("value", ',', 2) AS DOUBLE) END AS lon,
                   CASE WHEN event_type = 'ERROR' THEN split_part("value", ':', 1) END AS error_code,
                   CASE WHEN event_type = 'ERROR' THEN split_part("value", ':', 2) END AS error_name,
                   CASE WHEN event_type = 'BATTERY' THEN CAST("value" AS BIGINT) END AS battery,
                   CASE WHEN event_type = 'DELAY' THEN CAST("value" AS BIGINT) END AS delay_min
            FROM mobility_events"""),
        "graph_vertices": _with("""
            SELECT 'U:' || user_id AS id, 'USER' AS label, name, surname, country, NULL::VARCHAR AS city,
                   NULL::BIGINT AS capacity, NULL::DOUBLE AS total_cost FROM users
            UNION ALL SELECT 'T:' || trip_id, 'TRIP', NULL, NULL, NULL, NULL, NULL, CAST(total_cost AS DOUBLE)
            FROM trips_raw
            UNION ALL SELECT 'S:' || station_id, 'STATION', name, NULL, NULL, city, capacity, NULL FROM stations"""),
        "graph_edges": _with("SELECT src, dst, type FROM raw_edges", extra=_spread(0)),
        "graph_station_edges": _with("""
            SELECT start_station AS src, end_station AS dst, count(*) AS n_trips FROM trips GROUP BY 1, 2"""),
        "graph_out_degree": _with("""
            SELECT start_station AS src, count(*) AS out_degree FROM trips GROUP BY 1"""),
        "graph_reachable_stations": _with(_REACHABLE, extra=_EDGE_SET),
        "graph_path_stations": _with(
            "SELECT 'S:' || station_id AS id, name, city FROM ("
            + _REACHED.format(rider=f"'U:{REACHABLE_FROM}'") + ")", extra=_EDGE_SET),
        "graph_path_counts": _with("""
            SELECT p.src AS id, e.type, count(*) AS n_paths FROM edge_set p JOIN edge_set e ON e.src = p.dst
            WHERE p.type = 'PERFORMED' GROUP BY ALL""", extra=_EDGE_SET),
        "graph_first_user_stations": _with(
            "SELECT station_id AS sid, name FROM ("
            + _REACHED.format(rider="(SELECT 'U:' || min(user_id) FROM joined)") + ")", extra=_EDGE_SET),
        "graph_station_degrees": _with(_DEGREES, extra=_EDGE_SET),
        "graph_top_stations": _with(_DEGREES + " ORDER BY total_trips DESC, station_id LIMIT 3", extra=_EDGE_SET),
        "graph_pagerank": _with("SELECT station_id, name, rank FROM ranked", extra=ranks),
        "graph_pagerank_top3": _with(
            "SELECT station_id, name, rank FROM ranked ORDER BY rank DESC, station_id LIMIT 3", extra=ranks
        ),
        "graph_components": _components("SELECT station_id, component FROM comp"),
        "graph_component_sizes": _components(_SIZES),
        "graph_component_count": _components("SELECT count(DISTINCT component) AS num_components FROM comp"),
        "graph_vertex_components": _with("SELECT id, component FROM settled", extra=_spread()),
        "graph_vertex_component_sizes": _with("""
            SELECT component, v.name AS root_name, count(*) AS size
            FROM settled LEFT JOIN nodes v ON v.id = component GROUP BY component, v.name""", extra=_spread()),
        "graph_vertex_component_count": _with(
            "SELECT count(DISTINCT component) AS num_components FROM settled", extra=_spread()),
        "check_unique": _rules(_UNIQUE),
        "check_not_null": _rules(_NOT_NULL),
        "check_values": _rules(_VALUES),
        "check_enum": _rules(_ENUM),
        "check_lengths": _rules(_LENGTHS),
        "check_foreign_keys": _rules(
            _FOREIGN + [_orphans("events.trip_id.accepted_trip", "mobility_events", "trip_id", "trips", "trip_id")]
        ),
        "check_documents": _rules(_DOCUMENTS),
        "check_document_versions": _VERSIONS,
        "io_documents_versions": _with(f"""
            SELECT version, trip_id, event_id, event_type, "value",
                   CASE WHEN version = 2 OR total_cost < {REPEATED_BELOW} THEN {_LEVEL} END AS battery_level
            FROM mobility_events JOIN versioned USING (trip_id)""", extra=_VERSIONED),
        "io_json_damaged": _DAMAGED,
        "io_csv_damaged": _DAMAGED,
        "io_damaged_count": _with(f"""
            SELECT format, count(*) FILTER (total_cost > {2 * REPEATED_BELOW}) AS n_rows,
                   count(*) FILTER (total_cost <= {2 * REPEATED_BELOW}) AS n_damaged
            FROM trips, (VALUES ('json'), ('csv')) f(format) GROUP BY format"""),
        "graph_vertex_components_merged": _with("SELECT id, component FROM settled", extra=_spread()),
        "check_document_types": _rules(_DOCUMENT_TYPES),
        "check_summary": _rules(_NOT_NULL + _VALUES + _ENUM + _LENGTHS + _UNIQUE + _FOREIGN),
        "trips_accepted": _with(f"""
            SELECT trip_id FROM trips_raw WHERE trip_id NOT IN (SELECT trip_id FROM ({_REJECTED}))"""),
        "trips_rejected": _with(_REJECTED),
        "delete_users_cascade": _DELETED_USERS,
        "stored_delete_users": _DELETED_USERS,
        "delete_stations_blocked": _with("""
            SELECT station_id FROM all_stations s
            WHERE EXISTS (SELECT 1 FROM trips t WHERE t.start_station = s.station_id)
               OR EXISTS (SELECT 1 FROM trips t WHERE t.end_station = s.station_id)""",
            extra={"all_stations": _ALL_STATIONS}),
        "graph_upsert_stations": _with(_ALL_STATIONS),
        "stored_upsert_stations": _with(_ALL_STATIONS),
        "stored_merge_edges": _with("SELECT src, dst, type FROM raw_edges", extra=_spread(0)),
        "stored_delete_stations": _with("""
            SELECT * FROM all_stations WHERE station_id IN
                (SELECT start_station FROM trips UNION ALL SELECT end_station FROM trips)""",
            extra={"all_stations": _ALL_STATIONS}),
        "stored_backfill_events": _with(f"SELECT {_EVENT_COLUMNS}, {_LEVEL} AS battery_level FROM mobility_events"),
        "stored_backfill_documents": _with(f"""
            SELECT {_EVENT_COLUMNS}, {_LEVEL} AS battery_level FROM mobility_events
            WHERE trip_id IN (SELECT trip_id FROM trips)"""),
        "stored_backfill_count": _with("""
            SELECT count(DISTINCT trip_id) AS n_trips FROM mobility_events
            WHERE event_type = 'BATTERY' AND trip_id IN (SELECT trip_id FROM trips)"""),
        "stored_insert_trips": _with(f"""
            SELECT trip_id, rule, count(*) AS n FROM (
                SELECT trip_id, rule FROM rejected JOIN trips_raw USING (trip_id)
                UNION ALL SELECT trip_id, rule FROM rejected JOIN trips_raw USING (trip_id) WHERE total_cost < {REPEATED_BELOW}
                UNION ALL SELECT trip_id, 'accepted' FROM good
                UNION ALL SELECT trip_id, 'trips.trip_id.unique' FROM good WHERE total_cost < {REPEATED_BELOW})
            GROUP BY trip_id, rule""",
            extra={"rejected": _REJECTED, "good": "SELECT * FROM trips_raw WHERE trip_id NOT IN (SELECT trip_id FROM rejected)"}),
        "stored_check_keys": _with("""
            SELECT 'trips.trip_id.unique' AS rule,
                   (SELECT count(*) FROM batch JOIN base USING (trip_id)) AS n_violations
            UNION ALL SELECT 'trips.user_id.foreign_key',
                   (SELECT count(*) FROM batch WHERE user_id NOT IN (SELECT user_id FROM users))
            UNION ALL SELECT 'trips.start_station.foreign_key',
                   (SELECT count(*) FROM batch WHERE start_station NOT IN (SELECT station_id FROM stations))
            UNION ALL SELECT 'trips.end_station.foreign_key',
                   (SELECT count(*) FROM batch WHERE end_station NOT IN (SELECT station_id FROM stations))
            UNION ALL SELECT 'events.trip_id.foreign_key',
                   (SELECT count(*) FROM mobility_events WHERE trip_id NOT IN (SELECT trip_id FROM base))""",
            extra={"base": f"SELECT * FROM trips_raw WHERE total_cost < {LOADED_FIRST}",
                   "batch": f"SELECT * FROM trips_raw WHERE total_cost >= {LOADED_FIRST} OR total_cost < {REPEATED_BELOW}"}),
        "stored_reachable_stations": _with(_REACHABLE, extra=_EDGE_SET),
        "evolve_add_column": _with(f"""
            SELECT {_EVENT_COLUMNS}, NULL::BIGINT AS battery_level FROM mobility_events"""),
        "evolve_backfill_table": _with(f"SELECT {_EVENT_COLUMNS}, {_LEVEL} AS battery_level FROM mobility_events"),
        "evolve_backfill_nested": _with(f"""
            SELECT {_EVENT_COLUMNS}, {_LEVEL} AS battery_level FROM mobility_events
            WHERE trip_id IN (SELECT trip_id FROM trips)"""),
        "evolve_modified_count": _with("""
            SELECT count(DISTINCT trip_id) AS n_trips FROM mobility_events
            WHERE event_type = 'BATTERY' AND trip_id IN (SELECT trip_id FROM trips)"""),
        "evolve_sample_event": _with(f"""
            SELECT event_id, "value", {_LEVEL} AS battery_level FROM mobility_events
            WHERE event_type = 'BATTERY' ORDER BY event_id LIMIT 1"""),
        "check_battery_range": _battery("events.battery_level.range", "NOT ({level} BETWEEN 0 AND 100)"),
        "check_battery_only": _battery(
            "events.battery_level.only_battery", "(event_type = 'BATTERY') <> ({level} IS NOT NULL)"
        ),
        "gen_users": f"""
            SELECT c_custkey + 1 AS user_id, {_from(synth.NAMES, "user:name", "c_custkey + 1")} AS name,
                   {_from(synth.SURNAMES, "user:surname", "c_custkey + 1")} AS surname,
                   CAST(CAST(DATE '2023-01-01' - CAST(6570 + {_below(15331, "user:birthdate", "c_custkey + 1")}
                        AS INTEGER) AS DATE) AS VARCHAR) AS birthdate,
                   {_from(synth.COUNTRIES, "user:country", "c_custkey + 1")} AS country
            FROM customer""",
        "gen_stations": f"""
            SELECT s_suppkey + 1 AS station_id,
                   'Station_' || {_CITY} || '_' || CASE WHEN s_suppkey < 10000
                        THEN lpad(CAST(s_suppkey AS VARCHAR), 4, '0') ELSE CAST(s_suppkey AS VARCHAR) END AS name,
                   {_CITY} AS city, 5 + {_below(46, "station:capacity", "s_suppkey + 1")} AS capacity
            FROM supplier""",
        "gen_options": _with(f"""
            SELECT table_name, n AS n_rows, CASE WHEN n > 0 THEN 1::BIGINT END AS least, CASE WHEN n > 0 THEN n END AS greatest FROM (
                SELECT 'users' AS table_name, count(*) AS n FROM users
                UNION ALL SELECT 'stations', greatest({synth.MIN_STATIONS}, count(*) // {synth.USERS_PER_STATION}) FROM users
                UNION ALL SELECT 'trips', count(*) FROM trips
                UNION ALL SELECT 'events', {EVENTS_PER_TRIP + 1} * count(*) FROM trips)"""),
        "gen_trips": _with(_MADE_TRIPS),
        "gen_events": _with(
            f"""
            SELECT CAST(event_id AS VARCHAR) AS event_id, trip_id,
                   {_in_year("event:time", "event_id")} AS "timestamp", event_type, {_MADE_VALUE}
            FROM made_events""",
            extra=_MADE_EVENTS,
        ),
        "gen_events_in_trip": _with(
            f"""
            SELECT *, {_LEVEL} AS battery_level FROM (
                SELECT CAST(event_id AS VARCHAR) AS event_id, trip_id,
                       start_time + to_seconds({_below(86400, "event:offset", "event_id")}) AS "timestamp",
                       event_type, {_MADE_VALUE}
                FROM made_events)""",
            extra=_MADE_EVENTS,
        ),
        "io_documents_types": _rules(_types("trips", _TRIP_FIELDS)),
        "io_documents_modified": _with("""
            SELECT count(DISTINCT trip_id) AS n_trips FROM mobility_events
            WHERE event_type = 'BATTERY' AND trip_id IN (SELECT trip_id FROM trips)"""),
        "io_json_roundtrip": _COST_TABLE,
        "io_csv_roundtrip": _COST_TABLE,
        "io_append_overwrite": _COST_TABLE,
        "io_documents_roundtrip": _with("""
            SELECT trip_id, event_id, "timestamp", event_type, "value" FROM mobility_events
            WHERE trip_id IN (SELECT trip_id FROM trips)"""),
    }
