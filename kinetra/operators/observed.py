"""Row-wise checks as metrics of the stage that writes a model.

``Observed.watch(model)`` puts the not_null and between checks of a model on top of its
plan as observed aggregates, so they are counted while its rows are written and no
second scan is needed.  Views that are row for row a projection of a written table
(``VIEWS``) are checked there too.

The metrics belong in the last stage of the write, above any shuffle
(``replace_table`` puts them there): a result task that runs again after a lost executor
is counted once, a shuffle task could be counted twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kinetra.operators import staging
from kinetra.operators.quality import CHECKS, ROW_WISE, Check, _bad, _status

#: Written table -> its views, with the columns that they add to the table's own.
VIEWS: dict[str, dict[str, Callable[[], dict[str, Column]]]] = {
    "raw_tracks": {"stg_tracks": staging.track_columns},
    "raw_trajectory_points": {"stg_points": staging.point_columns},
    "fct_trajectory_points": {"points_with_deltas": dict},
}


class Observed:
    """Counts the row-wise checks of the models that are written under its watch."""

    def __init__(self, checks: list[Check] = CHECKS, tests: set[str] | None = None):
        self.checks = [c for c in checks if c.test in ROW_WISE and (tests is None or c.test in tests)]
        self._metrics: dict[str, tuple[Observation, list[Check]]] = {}

    def watch(self, model: str) -> Callable[[DataFrame], DataFrame]:
        """The step that adds the metrics of ``model`` and its views to its plan; it has
        to be the last one before the write.  A model written again counts anew."""
        views = VIEWS.get(model, {})
        own = [c for c in self.checks if c.model in (model, *views)]

        def step(df: DataFrame) -> DataFrame:
            if not own:
                return df
            seen = Observation()
            self._metrics[model] = seen, own
            added = {n: c for view in views.values() for n, c in view().items() if n not in df.columns}
            wide = df.withColumns(added) if added else df
            return wide.observe(seen, *[F.count_if(_bad(c)).alias(f"c{i}") for i, c in enumerate(own)]
                                ).select(*df.columns)

        return step

    def results(self, spark: SparkSession) -> DataFrame:
        """One row per check of the models written so far, as ``quality.evaluate``
        gives them."""
        rows = []
        for seen, own in self._metrics.values():
            counts = seen.get
            rows += [(c.model, c.column, c.test, int(counts.get(f"c{i}") or 0), c.severity)
                     for i, c in enumerate(own)]
        out = spark.createDataFrame(
            rows, "model string, column_name string, test_name string, failures long, severity string")
        return out.withColumn("status", _status(F.col("failures"), F.col("severity")))
