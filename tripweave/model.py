"""Table schemas and the rules that the rows of each table must keep.

The rules are data: predicates as SQL text, enumerations, lengths and keys.
``operators.quality`` turns them into columns and counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _required(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, nullable=False)


USERS = T.StructType(
    [
        _required("user_id", T.LongType()),
        _required("name", T.StringType()),
        _required("surname", T.StringType()),
        _required("birthdate", T.DateType()),
        _required("country", T.StringType()),
    ]
)

STATIONS = T.StructType(
    [
        _required("station_id", T.LongType()),
        _required("name", T.StringType()),
        _required("city", T.StringType()),
        _required("capacity", T.IntegerType()),
    ]
)

TRIPS = T.StructType(
    [
        _required("trip_id", T.LongType()),
        _required("user_id", T.LongType()),
        _required("start_station", T.LongType()),
        _required("end_station", T.LongType()),
        _required("start_time", T.TimestampNTZType()),
        _required("end_time", T.TimestampNTZType()),
        _required("total_cost", T.DecimalType(8, 2)),
    ]
)

# Event keys are text, because the star-schema view builds them from several
# columns; nothing in the operators depends on the type of a key.
EVENTS = T.StructType(
    [
        _required("event_id", T.StringType()),
        _required("trip_id", T.LongType()),
        _required("timestamp", T.TimestampNTZType()),
        _required("event_type", T.StringType()),
        _required("value", T.StringType()),
    ]
)

SCHEMAS = {"users": USERS, "stations": STATIONS, "trips": TRIPS, "events": EVENTS}

# ---- Fixed values of the domain ------------------------------------------
EVENT_TYPES = ["GPS", "ERROR", "BATTERY", "DELAY"]
ERROR_VALUES = ["E001:BrakeFailure", "E002:MotorOverheat", "E003:BatteryLow", "E004:ConnectionLost"]
BATTERY_MIN, BATTERY_MAX = 0, 100
# --------------------------------------------------------------------------

KEYS = {"users": "user_id", "stations": "station_id", "trips": "trip_id", "events": "event_id"}


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    on_delete: str

    @property
    def parent_key(self) -> str:
        return KEYS[self.parent]

    @property
    def rule(self) -> str:
        return f"{self.child}.{self.column}.foreign_key"


FOREIGN_KEYS = [
    ForeignKey("trips", "user_id", "users", "cascade"),
    ForeignKey("trips", "start_station", "stations", "restrict"),
    ForeignKey("trips", "end_station", "stations", "restrict"),
    ForeignKey("events", "trip_id", "trips", "cascade"),
]

# Row predicates.  As in SQL, a predicate that is null counts as kept.
VALUE_CHECKS = {
    "stations": {"capacity_positive": "capacity > 0"},
    "trips": {"cost_not_negative": "total_cost >= 0", "ends_after_start": "end_time > start_time"},
}

ENUMS = {"events": {"event_type": EVENT_TYPES}}

LENGTHS = {
    "users": {"name": 100, "surname": 100, "country": 100},
    "stations": {"name": 150, "city": 100},
    "events": {"event_type": 10},
}

# ---- Fixed predicates of the evolved events table ------------------------
BATTERY_RANGE = f"battery_level IS NULL OR battery_level BETWEEN {BATTERY_MIN} AND {BATTERY_MAX}"
BATTERY_ONLY = "(event_type = 'BATTERY') = (battery_level IS NOT NULL)"

# ---- Rider statistics staged as JSON lines, with text keys ---------------------
STAGED_USERS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("surname", T.StringType()),
    ]
)
STAGED_DURATIONS = T.StructType(
    [T.StructField("user_id", T.StringType()), T.StructField("minutes", T.LongType()), T.StructField("micros", T.LongType())]
)

# ---- Document shape: events are embedded in their trip ---------------------
# A trip with very many events is stored as several documents, numbered by ``part``
# of ``parts``; both fields are always there, 0 and 1 for a whole document.
EMBEDDED_EVENT = T.StructType([f for f in EVENTS.fields if f.name != "trip_id"])

TRIP_DOCUMENT = T.StructType(
    [
        _required("trip_id", T.LongType()),
        _required("user_id", T.LongType()),
        _required("start_station_id", T.LongType()),
        _required("end_station_id", T.LongType()),
        _required("start_time", T.TimestampNTZType()),
        _required("end_time", T.TimestampNTZType()),
        _required("total_cost", T.DecimalType(8, 2)),
        _required("part", T.IntegerType()),
        _required("parts", T.IntegerType()),
        _required("events", T.ArrayType(EMBEDDED_EVENT, containsNull=False)),
    ]
)

# The second version of the document schema: one more optional event field, so
# that every document of the first version stays valid.
EMBEDDED_EVENT_V2 = T.StructType(
    EMBEDDED_EVENT.fields + [T.StructField("battery_level", T.IntegerType(), nullable=True)]
)

TRIP_DOCUMENT_V2 = T.StructType(
    [f for f in TRIP_DOCUMENT.fields if f.name != "events"]
    + [_required("events", T.ArrayType(EMBEDDED_EVENT_V2, containsNull=False))]
)
