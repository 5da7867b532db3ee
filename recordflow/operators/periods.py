"""Periods as few aligned blocks of days, so that dates meet them by equality.

Blocks of level k are ``8**k`` days long and aligned. A period is covered, without overlap, by the largest blocks
inside it: at most ``2 * 7`` a level, so a period that is open to year 9999 costs a handful of rows, as one
that is open to next month does. A date lies in one block of each level. Seven days and five levels of a decade are
compared by five lookups a date, on the levels that the periods really use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Days of a block are ``2 ** (BITS * level)``.
BITS = 3
LEVELS = 8
_ORIGIN = "0001-01-01"
_LEVEL_SHIFT = 32


def day_number(date: Column) -> Column:
    """Days since the first day of the calendar, never negative."""
    return F.datediff(date.cast("date"), F.lit(_ORIGIN).cast("date")).cast("bigint")


def _node(level: int, index: Column) -> Column:
    return index + F.lit(level << _LEVEL_SHIFT).cast("bigint")


def _run(first: Column, end: Column, half: Column, bits: int, levels: int) -> tuple[Column, Column]:
    """The ``half``-th run of blocks of a period up to, but without, day ``end``: its first block and the one after its last.

    A level has two runs, left (even) and right (odd) of what the next level covers. Plain arithmetic on columns, so
    that a run costs no interpreted lambda a period.
    """
    level = F.shiftright(half, 1).cast("bigint")
    size, up = (level * bits).cast("int"), (level * bits + bits).cast("int")

    def index(day: Column, shift: Column) -> Column:
        return F.call_function("shiftright", day, shift)

    def up_to_block(day: Column, shift: Column) -> Column:
        return index(day + F.call_function("shiftleft", F.lit(1).cast("bigint"), shift) - 1, shift)

    # What the next level covers lies in the middle.
    inner, outer = up_to_block(first, up) * (1 << bits), index(end, up) * (1 << bits)
    both = (level < levels - 1) & (inner < outer)
    right = F.shiftright(half, 1) * 2 < half
    start = F.when(right, F.when(both, outer).otherwise(index(end, size))).otherwise(up_to_block(first, size))
    stop = F.when(both & ~right, inner).otherwise(index(end, size))
    node = F.call_function("shiftleft", level, F.lit(_LEVEL_SHIFT))
    return node + start, node + stop


def cover(first_day: Column, last_day: Column, bits: int = BITS, levels: int = LEVELS) -> Column:
    """The blocks that make up the days from ``first_day`` to ``last_day`` (day numbers), none if there are none."""
    none = F.array().cast("array<bigint>")
    runs = [_run(first_day, last_day + 1, F.lit(half), bits, levels) for half in range(2 * levels)]
    return F.concat(*[F.when(a < b, F.sequence(a, F.greatest(a, b - 1))).otherwise(none) for a, b in runs])


def with_runs(df: DataFrame, first_day: Column, last_day: Column) -> DataFrame:
    """``df`` with the runs of blocks that ``cover`` lists: ``_level``, ``_from`` and ``_to``, one row a run that has blocks."""
    days = df.withColumns({"_first": first_day, "_end": last_day + 1}).where(F.col("_first") < F.col("_end"))
    length = F.col("_end") - F.col("_first")
    # Higher levels have blocks that are longer than the period.
    top = sum(((length >= (1 << BITS * level)).cast("int") for level in range(1, LEVELS)), F.lit(0))
    halves = days.withColumn("_half", F.explode(F.sequence(F.lit(0), top * 2 + 1)))
    start, stop = _run(F.col("_first"), F.col("_end"), F.col("_half"), BITS, LEVELS)
    runs = halves.withColumns({"_from": start, "_to": stop - 1, "_level": F.shiftright("_half", 1)})
    return runs.where(F.col("_from") <= F.col("_to")).drop("_first", "_end", "_half")


def blocks_of(day: Column, bits: int = BITS, levels: int = LEVELS) -> Column:
    """The block of each level that holds a day number."""
    return F.array(*[_node(level, F.shiftright(day, bits * level)) for level in range(levels)])
