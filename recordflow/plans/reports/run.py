"""What a report run covers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.operators.latest import latest_per_key


@dataclass(frozen=True)
class Run:
    """Inclusive days of a run; a daily run starts and ends on the same day (ISO text)."""

    low: str
    high: str

    @classmethod
    def day(cls, day: str) -> Run:
        return cls(day, day)

    @property
    def start(self) -> Column:
        return F.lit(self.low).cast("date")

    @property
    def end(self) -> Column:
        return F.lit(self.high).cast("date")

    @property
    def year(self) -> int:
        return int(self.high[:4])

    def holds(self, day: str) -> Column:
        return F.col(day).between(self.start, self.end)

    def newest(self, df: DataFrame, day: str, keys: Sequence[str], tie: Sequence[Column] = ()) -> DataFrame:
        """The key's newest row inside the run; on a daily run that is the row of the day."""
        return latest_per_key(df, keys, [F.col(day).desc(), *tie], where=self.holds(day))

    def before(self, df: DataFrame, day: str, keys: Sequence[str], tie: Sequence[Column] = ()) -> DataFrame:
        """The key's newest row from before the run."""
        return latest_per_key(df, keys, [F.col(day).desc(), *tie], where=F.col(day) < self.start)

    def up_to(self, df: DataFrame, day: str, keys: Sequence[str], tie: Sequence[Column] = ()) -> DataFrame:
        """The key's newest row on or before the end of the run."""
        return latest_per_key(df, keys, [F.col(day).desc(), *tie], where=F.col(day) <= self.end)
