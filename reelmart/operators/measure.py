"""Measurements taken while a relation is written.

A writer passes its rows through ``Measure.on`` as the last step before the files. Spark's
observed metrics then count the rows and, for every declared row-level and accepted-values
check of the relation, the failing rows, in the same job: no relation is read again to be
counted or checked. The last step is in the result stage of the write, whose tasks are
counted once each however often a task is run again.

``Measure.result`` gives plain numbers, which the store keeps with the published part
(``note``), so that a later report, also in another session, needs no scan for them. The
number of failing rows answers every row-level check; an accepted-values check counts
distinct bad values, so it is only answered by a measurement of zero.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from reelmart.operators.marts import as_of
from reelmart.operators.quality import DECLARED_CHECKS, IN_ROWS, effective_year

ROWS = "rows"
YEAR = "as_of_year"


class Measure:
    """Row count and check failures of one relation, from the job that writes it."""

    def __init__(self, relation: str, as_of_year: int | None = None) -> None:
        self.relation, self.year = relation, effective_year(as_of_year)
        self.checks = [c for c in DECLARED_CHECKS if c.relation == relation and c.kind in IN_ROWS]
        self._observation = Observation()

    def _metrics(self) -> list[Column]:
        now = as_of(self.year)
        return [F.count(F.lit(1)).alias(ROWS), *[F.count_if(c.violation(now)).alias(c.check_id) for c in self.checks]]

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(self._observation, *self._metrics())

    @property
    def result(self) -> dict[str, int]:
        """Numbers by name, after the write."""
        return {**self._observation.get, YEAR: self.year}

    @property
    def note(self) -> str:
        return json.dumps(self.result)


class StoredTables(dict):
    """Stored relations by name, with what was measured while they were written (``measured``)."""

    def __init__(self, frames: dict[str, DataFrame], measured: dict[str, dict[str, int]]) -> None:
        super().__init__(frames)
        self.measured = measured
