"""The half-open date window of a run, and the guard that widens it for late rows of child tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def add_months(day: date, months: int) -> date:
    """The first day of the month so many months away."""
    index = day.year * 12 + day.month - 1 + months
    return date(index // 12, index % 12 + 1, 1)


@dataclass(frozen=True)
class DateWindow:
    start: date
    end: date

    def __post_init__(self):
        if self.end <= self.start:
            raise ValueError("a window ends after it starts")

    @classmethod
    def resolve(cls, config: dict, today: date | None = None) -> DateWindow:
        """mode `explicit`: start and end; mode `relative`: `months` from the anchor month (this month if none is given)."""
        if config.get("mode", "relative") == "explicit":
            return cls(date.fromisoformat(str(config["start"])), date.fromisoformat(str(config["end"])))
        anchor = config.get("anchor")
        first = date.fromisoformat(f"{anchor}-01") if anchor else (today or date.today()).replace(day=1)
        return cls(first, add_months(first, int(config.get("months", 1))))

    def label(self) -> str:
        return f"window_start={self.start}/window_end={self.end}"

    def contains(self, c: Column) -> Column:
        return (c >= F.lit(self.start)) & (c < F.lit(self.end))

    def guarded(self, c: Column, back: int = 0, ahead: int = 30) -> Column:
        """Rows of child tables may be `ahead` days late (and `back` days early)."""
        return (c >= F.lit(self.start - timedelta(days=back))) & (c < F.lit(self.end + timedelta(days=ahead)))
