"""Column functions: clocks, geometry, recodes, one-hots, windows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

GAME = ["season", "game_id"]
PERIOD = [*GAME, "period"]


def of_game(*more: str):
    return Window.partitionBy(*GAME, *more).orderBy("event_idx")


def whole(*keys: str):
    """The frame of all rows of a group, in event order."""
    return Window.partitionBy(*keys).orderBy("event_idx").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def clock_seconds(clock: Column) -> Column:
    """'M:SS' or 'MM:SS' to seconds; null for anything else."""
    part = lambda k: F.regexp_extract(clock, "^([0-9]{1,2}):([0-9]{2})$", k).try_cast("int")
    return part(1) * 60 + part(2)


def padded(clock: Column) -> Column:
    """'M:SS' becomes '0M:SS'."""
    return F.when(F.octet_length(clock) == 4, F.lpad(clock, 5, "0")).otherwise(clock)


def recode(c: Column, table: Mapping[str, str]) -> Column:
    """Values named in the table are replaced, others stay."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c), c)


def flag(condition: Column) -> Column:
    """1 or 0; an unknown condition is 0."""
    return F.when(condition, 1).otherwise(0)


def one_hots(table: Mapping[str, Column]) -> dict[str, Column]:
    return {name: flag(c) for name, c in table.items()}


def distance(x: Column, y: Column, goal: float) -> Column:
    return F.sqrt((F.lit(goal) - x) * (F.lit(goal) - x) + y * y)


def angle(x: Column, y: Column, goal: float) -> Column:
    """Degrees from the line to the goal's middle: 0 in front, 180 behind."""
    return F.degrees(F.atan2(F.abs(y), F.lit(goal) - x))


def joined_ids(ids: Column) -> Column:
    return F.array_join(F.sort_array(ids), ",")


def any_of(c: Column, values: Iterable[str]) -> Column:
    return c.isin(*values)


def clip(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))
