"""Top-N per group with deterministic ties.

``row_number() <= n`` over a window lets Catalyst insert WindowGroupLimit:
each map task keeps at most n rows per group before the shuffle, so even a
group holding a third of all rows reaches the final window as n rows per
input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank_col: str | None = None) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    if rank_col:
        return ranked.withColumnRenamed("_rn", rank_col)
    return ranked.drop("_rn")


def tie_breakers(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]
