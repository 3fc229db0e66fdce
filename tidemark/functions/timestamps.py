"""Time helpers: ISO-8601 text, relative windows, ages and uptime text."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY, _SECONDS, _ZONE = r"\d{4}-\d{2}-\d{2}", r"\d{2}([.,]\d+)?", r"(Z|[+-]\d{2}(:?\d{2})?)"
_ZONED = rf"^{_DAY}[T ]\d{{2}}:\d{{2}}:{_SECONDS}{_ZONE}$"
_NAIVE = rf"^{_DAY}[T ]\d{{2}}:\d{{2}}:{_SECONDS}$"
_DATE = rf"^{_DAY}$"
# Rarer forms and how they look in the usual one.
_RARE = (
    (rf"^({_DAY})[T ](\d{{2}}:\d{{2}}){_ZONE}?$", "$1T$2:00$3"),
    (rf"^({_DAY})[T ](\d{{2}}){_ZONE}?$", "$1T$2:00:00$3"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})T(\d{{2}})(\d{{2}})({_SECONDS}){_ZONE}?$", "$1-$2-$3T$4:$5:$6$8"),
)


def parse_iso(text: Column | str) -> Column:
    """Read ISO-8601 text as a timestamp; text without an offset is UTC, other text is NULL.

    The shape is checked first because Spark's own cast also takes bare years and times of day.
    Week dates (``2026-W14-1``) are not read. The usual forms are tried first, each with one match.
    """
    c = F.col(text) if isinstance(text, str) else text

    def utc(value: Column) -> Column:
        return F.concat(value, F.lit("Z"))

    dotted = F.translate(c, ",", ".")
    parsed = (
        F.when(c.rlike(_ZONED), dotted.try_cast("timestamp"))
        .when(c.rlike(_NAIVE), utc(dotted).try_cast("timestamp"))
        .when(c.rlike(_DATE), F.concat(c, F.lit("T00:00:00Z")).try_cast("timestamp"))
    )
    for pattern, usual in _RARE:
        full = F.regexp_replace(dotted, pattern, usual)
        zoned = F.when(full.rlike(f"{_ZONE}$"), full).otherwise(utc(full))
        parsed = parsed.when(c.rlike(pattern), zoned.try_cast("timestamp"))
    return parsed


def parse_since(text: str) -> timedelta | None:
    """``1h``, ``30m`` or ``2d`` as a time span; None for anything else."""
    unit = {"h": "hours", "m": "minutes", "d": "days"}.get(text[-1:])
    if unit is None:
        return None
    try:
        return timedelta(**{unit: float(text[:-1])})
    except (ValueError, OverflowError):
        return None


def uptime_text(seconds: Column) -> Column:
    """``3d 4h``, ``4h 5m`` or ``5m``."""
    s = seconds.cast("bigint")
    days, hours, minutes = F.floor(s / 86400), F.floor(s / 3600) % 24, F.floor(s / 60) % 60
    return (
        F.when(days > 0, F.concat(days, F.lit("d "), hours, F.lit("h")))
        .when(hours > 0, F.concat(hours, F.lit("h "), minutes, F.lit("m")))
        .otherwise(F.concat(minutes, F.lit("m")))
    )
