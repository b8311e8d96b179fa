"""Date patterns: which unit a pattern resolves to, parsing and formatting without a time zone.

A bound travels as text in the caller's pattern, so a bound can never be finer than the pattern.
`finest_unit` says what that unit is; `floor_to_unit` and `floor_column` cut a time down to it.
"""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Units from fine to coarse. "exact" means finer than a second: whole-second windows lose nothing.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
CALENDAR_MONTHS = {"month": 1, "year": 12}

# Pattern letters of Spark's datetime patterns, by the unit they stand for.
PATTERN_LETTERS = {
    "exact": "S",
    "second": "s",
    "minute": "m",
    "hour": "HkhK",
    "day": "dD",
    "month": "ML",
    "year": "y",
}


def _letters(pattern: str) -> set[str]:
    """Letters of the pattern outside quoted text."""
    return {c for piece in pattern.split("'")[::2] for c in piece if c.isalpha()}


def finest_unit(pattern: str) -> str:
    """Finest unit of a pattern; ValueError if texts in it would not sort the way times do."""
    letters = _letters(pattern)
    if not letters.isdisjoint("VzOXxZ"):
        raise ValueError(f"pattern {pattern!r} holds a zone; bounds are zone-free")

    def has(unit: str) -> bool:
        return not letters.isdisjoint(PATTERN_LETTERS[unit])

    finest = next((unit for unit in PATTERN_LETTERS if has(unit)), None)
    if finest is None or not has("year"):
        raise ValueError(f"pattern {pattern!r} must hold a year")
    needed = {
        "day": has("month") or "D" in letters,
        "hour": has("day") and ("a" in letters or not letters.isdisjoint("Hk")),
        "minute": has("hour"),
        "second": has("minute"),
        "exact": has("second"),
    }
    order = list(PATTERN_LETTERS)
    for unit, fine in needed.items():
        if order.index(unit) >= order.index(finest) and not fine:
            raise ValueError(f"pattern {pattern!r} leaves a gap above its {unit} field")
    return finest


def parse_texts(spark: SparkSession, texts: list[str], pattern: str) -> list[datetime]:
    """Parse bound texts strictly with Spark's own parser (a local relation, no data rows)."""
    if not texts:
        return []
    # The parser needs a mark between seconds and a fraction written right behind them.
    digits = len(pattern) - len(pattern.rstrip("S"))
    if digits and pattern[:-digits].endswith("s"):
        pattern = f"{pattern[:-digits]}.{pattern[-digits:]}"
        texts = [f"{text[:-digits]}.{text[-digits:]}" for text in texts]
    rows = spark.createDataFrame(pa.table({"text": pa.array(texts, pa.string())}))
    try:
        parsed = rows.select(F.to_timestamp_ntz("text", F.lit(pattern)).alias("value")).collect()
    except Exception as error:
        raise ValueError(f"cannot parse {texts} with pattern {pattern!r}") from error
    values = [row.value for row in parsed]
    for text, value in zip(texts, values):
        if value is None:
            raise ValueError(f"cannot parse {text!r} with pattern {pattern!r}")
    return values


def format_column(ts: Column, pattern: str) -> Column:
    """Text of a TIMESTAMP_NTZ in the pattern.

    `date_format` goes through the session zone and moves times that fall into a clock change;
    the CSV writer has an NTZ pattern of its own.
    """
    options = {"timestampNTZFormat": pattern, "sep": "\u0001"}
    return F.when(ts.isNotNull(), F.to_csv(F.struct(ts.alias("t")), options))


def ntz_literal(value: datetime) -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{value.isoformat(sep=' ')}'")


def floor_to_unit(value: datetime, unit: str) -> datetime:
    """Largest unit boundary at or before a time."""
    if unit == "exact":
        return value
    value = value.replace(microsecond=0)
    if unit == "second":
        return value
    value = value.replace(second=0)
    if unit == "minute":
        return value
    value = value.replace(minute=0)
    if unit == "hour":
        return value
    value = value.replace(hour=0)
    if unit == "day":
        return value
    month = value.month - (value.month - 1) % CALENDAR_MONTHS[unit]
    return value.replace(day=1, month=month)


def floor_column(ts: Column, unit: str) -> Column:
    """`floor_to_unit` on a TIMESTAMP_NTZ column, through DATE so that no zone is involved."""
    if unit == "exact":
        return ts
    if unit in CALENDAR_MONTHS:
        return F.trunc(ts.cast("date"), unit).cast("timestamp_ntz")
    midnight = ts.cast("date").cast("timestamp_ntz")
    width = F.expr(f"INTERVAL '{UNIT_SECONDS[unit]}' SECOND")
    return midnight + F.call_function("div", ts - midnight, width) * width
