"""Column expressions; all of them run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Col = Column | str


def _col(c: Col) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minutes_between(start: Col, end: Col) -> Column:
    """Minutes from ``start`` to ``end`` as a double, fractions of a second kept.

    Subtracting zone-less timestamps gives an interval without a detour over the
    session time zone, so a change to summer time does not alter a duration.
    """
    span = _col(end) - _col(start)
    whole = F.extract(F.lit("DAY"), span) * 1440 + F.extract(F.lit("HOUR"), span) * 60
    whole = whole + F.extract(F.lit("MINUTE"), span)
    return whole.cast("double") + F.extract(F.lit("SECOND"), span).cast("double") / 60.0


def minutes_and_micros(start: Col, end: Col) -> tuple[Column, Column]:
    """Whole minutes from ``start`` to ``end`` and the microseconds left over, as two bigints.

    Both add up exactly in any order, and the microseconds of a minute, unlike those of a
    whole duration, leave room for 150 billion of them in a sum.
    """
    span = _col(end) - _col(start)
    hours = F.extract(F.lit("DAY"), span) * 24 + F.extract(F.lit("HOUR"), span)
    minutes = hours * 60 + F.extract(F.lit("MINUTE"), span)
    return minutes.cast("bigint"), (F.extract(F.lit("SECOND"), span) * 1_000_000).cast("bigint")


def mean_minutes(minutes: Col, micros: Col, n: Col) -> Column:
    """The mean in minutes of ``n`` durations that add up to so much; put together exactly, divided once, then rounded."""
    whole = _col(minutes).cast("decimal(30,0)") * F.lit(60_000_000).cast("decimal(8,0)") + _col(micros).cast("decimal(30,0)")
    return round_half_up(whole.cast("double") / (_col(n).cast("double") * 60_000_000.0))


def round_half_up(value: Col, digits: int = 2) -> Column:
    return F.round(_col(value), digits)


def null_as(value: Col, default: object) -> Column:
    return F.coalesce(_col(value), F.lit(default))


def typed_event_value(event_type: Col, value: Col) -> Column:
    """The text of an event value as a struct with one group of fields per type.

    Text that does not have the shape of its type gives nulls, not an error.
    """
    kind, text = _col(event_type), _col(value)

    def only(name: str, typed: Column) -> Column:
        return F.when(kind == name, typed)

    place = F.split(text, ",")
    fault = F.split(text, ":", 2)
    return F.struct(
        only("GPS", F.get(place, F.lit(0)).try_cast("double")).alias("lat"),
        only("GPS", F.get(place, F.lit(1)).try_cast("double")).alias("lon"),
        only("ERROR", F.get(fault, F.lit(0))).alias("error_code"),
        only("ERROR", F.get(fault, F.lit(1))).alias("error_name"),
        only("BATTERY", text.try_cast("int")).alias("battery"),
        only("DELAY", text.try_cast("int")).alias("delay_min"),
    )


def draw(seed: int, column: str, key: Col) -> Column:
    """A reproducible draw: a bigint in [0, 2**60) fixed by seed, column and key.

    It does not depend on partitions or on the order of rows, and two columns
    with different names draw independently.
    """
    text = F.concat(F.lit(f"{seed}:{column}:"), _col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def draw_below(n: int | Column, seed: int, column: str, key: Col) -> Column:
    """A draw in [0, n)."""
    return draw(seed, column, key) % (n if isinstance(n, Column) else F.lit(n))


def draw_from(values: list[str], seed: int, column: str, key: Col) -> Column:
    """A draw from a list of texts."""
    choices = F.array(*[F.lit(v) for v in values])
    return F.get(choices, draw_below(len(values), seed, column, key).cast("int"))
