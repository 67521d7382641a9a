"""Row counters: how many rows pass a point of a plan, taken while the plan runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def counted(rows: DataFrame, name: str, **more: Column) -> tuple[DataFrame, Observation]:
    """`rows`, and an observation whose `get` has n_rows and `more` (aggregates by name) once an action over them has ended."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("n_rows"), *[c.alias(k) for k, c in more.items()]), seen
