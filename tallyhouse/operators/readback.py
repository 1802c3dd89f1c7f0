"""First rows of a table in key order, to look at after a load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def first_rows(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``keys``, then by the other columns so that the result is fixed.

    Planned as a top-n per task and a merge, not as a full sort.
    """
    ties = [name for name in df.columns if name not in keys]
    return df.orderBy(*keys, *ties).limit(n)
