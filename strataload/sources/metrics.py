"""Counts taken while a plan is written, and guards that read them before the swap.

A frame is observed where its rows pass; the write that runs the plan delivers the
numbers.  Nothing is computed a second time to be counted.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Metrics:
    """Named observations of one write."""

    def __init__(self, wait: float = 20.0):
        """``wait``: seconds after the write until an observation counts as not run."""
        self.wait, self._seen, self._known = wait, {}, {}

    def count(self, name: str, df: DataFrame, **aggregates: Column) -> DataFrame:
        """``df``, whose rows and ``aggregates`` are known under ``name`` after the write.

        Observe a frame where it enters the plan once: the branch that carries its rows.
        """
        if name in self._seen:
            raise KeyError(f"metrics {name!r} are taken twice")
        seen = self._seen[name] = Observation(f"{name}-{uuid.uuid4().hex}")
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in aggregates.items()])

    def of(self, name: str) -> dict[str, object]:
        """The numbers of ``name``, after the write.

        A branch that Spark left out, because the other side of a join or the frame itself
        turned out empty, passed no rows: it gives ``rows`` = 0.
        """
        if name not in self._known:
            answer: list[dict] = []
            waiter = threading.Thread(target=lambda: answer.append(self._seen[name].get), daemon=True)
            waiter.start()
            waiter.join(self.wait)
            self._known[name] = answer[0] if answer else {"rows": 0}
        return self._known[name]

    def rows(self, name: str) -> int:
        return self.of(name)["rows"] or 0

    def frame(self, spark: SparkSession) -> DataFrame:
        """name, n: the counted rows, one line per name."""
        return spark.createDataFrame([(name, self.rows(name)) for name in self._seen], "name string, n long")

    # --- guards: ``publish`` calls them with the written rows; raising refuses these --------

    def not_empty(self, name: str, message: str) -> Callable[[DataFrame], None]:
        def guard(_: DataFrame) -> None:
            if not self.rows(name):
                raise ValueError(message)

        return guard

    def same_rows(self, before: str, after: str) -> Callable[[DataFrame], None]:
        """A join or step that must neither add nor lose rows."""

        def guard(_: DataFrame) -> None:
            if self.rows(before) != self.rows(after):
                raise ValueError(f"{self.rows(before)} rows of {before} became {self.rows(after)} of {after}")

        return guard
