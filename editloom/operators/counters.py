"""How many rows a step keeps and drops, observed while it runs: no second pass, and one row at the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def kept_and_skipped(rows: DataFrame, keep: Column, name: str = "rows", **missing: Column) -> tuple[DataFrame, Observation]:
    """The rows to keep, and an observation that has `read`, `kept`, `skipped` and each of `missing`, a count of the rows where
    it holds, once an action has run."""
    ok = F.coalesce(keep, F.lit(False))
    seen = Observation(name)
    count = lambda c: F.coalesce(F.sum(F.coalesce(c, F.lit(False)).cast("long")), F.lit(0).cast("long"))
    watched = rows.observe(seen, F.count(F.lit(1)).alias("read"), count(ok).alias("kept"), count(~ok).alias("skipped"), *(count(c).alias(k) for k, c in missing.items()))
    return watched.filter(ok), seen
