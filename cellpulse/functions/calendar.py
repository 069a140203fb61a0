"""Calendar expressions: windows, parts, slots, cycles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cellpulse.config import SLOT_LABELS, SLOT_UPPER_HOURS


def window_start(ts: str, hours: int) -> Column:
    """Start of the epoch-aligned window of `hours` hours that holds `ts`."""
    return F.window(F.col(ts), f"{hours} hours").getField("start")


def monday_weekday(ts: str | Column) -> Column:
    """0 for Monday up to 6 for Sunday."""
    return F.weekday(ts)


def weekend_flag(weekday: Column) -> Column:
    return (weekday >= 5).cast("int")


def slot_code(hour: Column) -> Column:
    """Position of the day slot of an hour; slots are closed on the right."""
    code = F.when(hour < 0, None)
    for position, upper in enumerate(SLOT_UPPER_HOURS):
        code = code.when(hour <= upper, position)
    return code


def slot_label(code: Column) -> Column:
    label = None
    for position, name in enumerate(SLOT_LABELS):
        label = F.when(code == position, name) if label is None else label.when(code == position, name)
    return label


def cycle(value: Column, period: float, harmonic: int = 1) -> tuple[Column, Column]:
    """(sin, cos) of a value on a cycle."""
    angle = F.lit(2.0 * harmonic) * F.pi() * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def hour_between(hour: Column, first: float, last: float) -> Column:
    return hour.between(first, last)
