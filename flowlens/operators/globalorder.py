"""Global order: every row with its consecutive place in the order of the whole
table.

A ``row_number`` over an unpartitioned window moves all rows into one task.
Here the rows are range partitioned by the order (Spark samples the bounds),
sorted inside each range and written once with their place in the range. The
rows per range -- one number per range -- are added up to offsets, and place plus
offset is the rank. The only thing the driver sees is that list of counts, whose
length is the number of shuffle partitions.

Equal keys lie in one range, so order by enough columns that no key is shared
by a large part of the table; rows equal in all of them get consecutive ranks in
any order."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import quoted, unused
from ..session import materialize

_PLACE_BITS = 33          # monotonically_increasing_id: the partition above, the place in it below


def range_ordered(df: DataFrame, order: Sequence[Column], part: str, place: str) -> DataFrame:
    """``df`` range partitioned and sorted by ``order``, written once, with
    ``part`` (number of the range, rising with the order) and ``place`` (0, 1, ...
    in the range)."""
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select(
        *[quoted(c) for c in df.columns], F.spark_partition_id().alias(part),
        F.monotonically_increasing_id().bitwiseAND((1 << _PLACE_BITS) - 1).alias(place))
    return materialize(placed, "ordered")


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """The rows of ``df`` plus bigint ``name``: 1, 2, ... in the order of
    ``order``. The result is read from a written table; its rows stand in order
    within each file, not across tasks."""
    part, place, before = unused([*df.columns, name], "part", "place", "before")
    placed = range_ordered(df, order, part, place)
    counts = sorted(tuple(r) for r in placed.groupBy(part).count().collect())      # one row per range
    offsets = list(zip([p for p, _ in counts], accumulate([n for _, n in counts], initial=0)))
    table = df.sparkSession.createDataFrame(offsets, f"{part} int, {before} long")
    return placed.join(F.broadcast(table), part).select(
        *[quoted(c) for c in df.columns], (F.col(place) + F.col(before) + 1).alias(name))
