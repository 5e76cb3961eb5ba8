"""Run parameters, so that no operator reads the wall clock by itself."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def _utc_now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass(frozen=True)
class RunContext:
    """One batch run: its batch date, its time stamp and the name of the store.

    ``store`` is the prefix that some source columns carry (``<store>_purchase``,
    ``<store>_deck``, ...); set it to the store whose export is loaded.
    """

    batch_date: str
    processed_at: datetime = field(default_factory=_utc_now)
    as_of: date | None = None
    store: str = "store"

    @property
    def today(self) -> date:
        return self.as_of or self.processed_at.date()

    def stamp(self) -> Column:
        """The run's processing time; one value for every row of the run."""
        return F.lit(self.processed_at).cast("timestamp")

    def batch(self) -> Column:
        return F.lit(self.batch_date)
