"""Report parameters: the closing date, the opening date and the site."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, functions as F


def midnight(day: date) -> str:
    """A parameter date compared with a timestamp means 00:00 of that day."""
    return f"timestamp_ntz'{day.isoformat()} 00:00:00'"


@dataclass(frozen=True)
class ReportParams:
    """``location=None`` means all sites. The ``*_sql`` forms are literals for
    use inside SQL expressions."""

    end_date: date
    start_date: date | None = None
    location: int | None = None

    @property
    def end_sql(self) -> str:
        return midnight(self.end_date)

    @property
    def start_sql(self) -> str:
        if self.start_date is None:
            raise ValueError("this report needs a start date")
        return midnight(self.start_date)

    @property
    def end(self) -> Column:
        return F.expr(self.end_sql)

    @property
    def start(self) -> Column:
        return F.expr(self.start_sql)

    @property
    def site_sql(self) -> str:
        """A test of ``location_id``."""
        return "true" if self.location is None else f"location_id = {self.location}"

    def end_minus_months_sql(self, months: int, plus_days: int = 0) -> str:
        """The closing date moved back by calendar months (the day is clamped
        to the length of the month) and then forward by days."""
        moved = f"date_add(add_months(date'{self.end_date.isoformat()}', {-months}), {plus_days})"
        return f"cast({moved} as timestamp_ntz)"

    def end_minus_months(self, months: int, plus_days: int = 0) -> Column:
        return F.expr(self.end_minus_months_sql(months, plus_days))
