"""Flattened interval tables: overlapping address ranges of several tables are cut
once into disjoint intervals that carry the winner of every table, and points
find their interval in one merge sweep.

``flatten`` clips every range to the address cells it covers (``CELL_BITS`` leading
bits: at most 4096 cells), reduces ranges of one cell with the same clipped bounds to the winner,
and sweeps each cell from left to right with one heap per table: between two
neighbouring bounds the smallest (width, order, payload) of the open ranges wins. A cell
holds a million addresses at most, which bounds both the sweep and the points that meet in it. A table
with ``by`` has a winner for every value of that column instead.

``sweep_lookup`` puts points and interval starts into one table, dealt by cell and
sorted by address; the interval last begun, if it reaches that far, is the
point's. One shuffle, each side read once, no candidate rows."""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

CELL_BITS = 12
SHIFT = 32 - CELL_BITS


@dataclass
class RangeTable:
    """Ranges [lo, hi] with payload columns; ``order`` breaks ties after the
    width, the payload (NULLs first) after that; ``by``: one winner per value."""
    name: str
    df: DataFrame
    lo: str
    hi: str
    payload: Sequence[str]
    order: Sequence[Column] = field(default_factory=tuple)
    by: str | None = None


def _clipped(table: RangeTable, at: int) -> DataFrame:
    """(cell, lo, hi, of, key, best<at>): the winner per clipped range. Rows that aren't
    IPv4 ranges are left out."""
    lo, hi = F.col(table.lo).try_cast("bigint"), F.col(table.hi).try_cast("bigint")
    order = F.struct((hi - lo).alias("width"), *[c.alias(f"o{k}") for k, c in enumerate(table.order)])
    rows = table.df.select(
        lo.alias("from"), hi.alias("to"), (F.col(table.by).cast("string") if table.by else F.lit(None).cast("string")).alias("key"),
        F.struct(order.alias("order"), F.struct(*table.payload).alias("payload")).alias("best"),
    ).where((F.col("from") >= 0) & (F.col("to") < F.lit(1 << 32)) & (F.col("from") <= F.col("to")))
    if table.by:
        rows = rows.where("key is not null")
    cells = rows.select("*", F.explode(F.sequence(F.shiftright("from", SHIFT), F.shiftright("to", SHIFT))).alias("cell"))
    first = F.shiftleft("cell", SHIFT)
    return cells.select(
        "cell", F.greatest("from", first).alias("lo"), F.least("to", first + ((1 << SHIFT) - 1)).alias("hi"), F.lit(at).alias("of"), "key", "best",
    ).groupBy("cell", "lo", "hi", "of", "key").agg(F.min("best").alias(f"best{at}"))


def _rank(value) -> tuple:
    """Order of Spark's structs: NULL first, field by field."""
    if isinstance(value, dict):
        return tuple(_rank(v) for v in value.values())
    return (value is not None, value)


def winners(ranges: list[tuple[int, int, object, tuple]]) -> list[tuple[int, int, tuple]]:
    """(lo, hi, slot, rank) -> disjoint (lo, hi, indexes of the winners, one per
    slot that has one); neighbours with the same winners are joined."""
    starts = sorted(range(len(ranges)), key=lambda k: ranges[k][0])
    bounds = sorted({r[0] for r in ranges} | {r[1] + 1 for r in ranges})
    open_: dict[object, list] = {}
    out: list[list] = []
    at = 0
    for here, after in zip(bounds, bounds[1:]):
        while at < len(starts) and ranges[starts[at]][0] == here:
            lo, hi, slot, rank = ranges[starts[at]]
            heapq.heappush(open_.setdefault(slot, []), (rank, starts[at], hi))
            at += 1
        best = []
        for slot in list(open_):
            heap = open_[slot]
            while heap and heap[0][2] < here:
                heapq.heappop(heap)
            if heap:
                best.append(heap[0][1])
            else:
                del open_[slot]
        best = tuple(sorted(best))
        if best and out and out[-1][1] == here - 1 and out[-1][2] == best:
            out[-1][1] = after - 1
        elif best:
            out.append([here, after - 1, best])
    return [tuple(x) for x in out]


def flatten(tables: Sequence[RangeTable]) -> DataFrame:
    """cell, lo, hi (disjoint), and per table its winner's payload as a struct
    named like the table (NULL: none), or with ``by`` a map value -> payload."""
    parts = [_clipped(t, k) for k, t in enumerate(tables)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    rows = rows.select("cell", "lo", "hi", "of", "key", *[f"best{k}" for k in range(len(tables))])
    kinds = [t.df.select(F.struct(*t.payload).alias("p")).schema["p"].dataType for t in tables]
    keyed = [bool(t.by) for t in tables]
    names = [t.name for t in tables]
    arrow = [to_arrow_type(k) for k in kinds]
    schema = pa.schema([("cell", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())] + [
        (n, pa.list_(pa.struct([("key", pa.string()), ("value", a)])) if b else a) for n, a, b in zip(names, arrow, keyed)])

    def sweep(_, group):
        held = group.to_pylist()
        found = winners([(r["lo"], r["hi"], (r["of"], r["key"]), _rank(r[f"best{r['of']}"])) for r in held])
        out = []
        for lo, hi, best in found:
            row = {"cell": held[0]["cell"], "lo": lo, "hi": hi} | {n: [] if b else None for n, b in zip(names, keyed)}
            for k in best:
                of = held[k]["of"]
                payload = held[k][f"best{of}"]["payload"]
                if keyed[of]:
                    row[names[of]].append({"key": held[k]["key"], "value": payload})
                else:
                    row[names[of]] = payload
            out.append(row)
        return pa.Table.from_pylist(out, schema)

    ddl = ", ".join(f"{n} array<struct<key:string,value:{k.simpleString()}>>" if b else f"{n} {k.simpleString()}" for n, k, b in zip(names, kinds, keyed))
    flat = rows.groupBy("cell").applyInArrow(sweep, f"cell long, lo long, hi long, {ddl}")
    return flat.select("cell", "lo", "hi", *[F.map_from_entries(n).alias(n) if b else n for n, b in zip(names, keyed)])


def sweep_lookup(points: DataFrame, ip: str, intervals: DataFrame) -> DataFrame:
    """``points`` plus the winner columns of ``intervals`` (NULL where no range
    holds the address, or where it is NULL)."""
    names = [c for c in intervals.columns if c not in ("cell", "lo", "hi")]
    kept = points.columns
    given = points.where(F.col(ip).isNotNull()).select(
        F.struct(*kept).alias("point"), F.shiftright(ip, SHIFT).cast("bigint").alias("cell"), F.col(ip).cast("bigint").alias("at"), F.lit(1).alias("kind"))
    begun = intervals.select("cell", F.col("lo").alias("at"), F.lit(0).alias("kind"), F.struct("hi", *names).alias("interval"))
    along = Window.partitionBy("cell").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last("interval", ignorenulls=True).over(along)
    met = given.unionByName(begun, allowMissingColumns=True).select("point", "at", "kind", last.alias("interval")).where("kind = 1")
    hit = lambda n: F.when(F.col("interval.hi") >= F.col("at"), F.col(f"interval.{n}")).alias(n)
    found = met.select("point.*", *[hit(n) for n in names])
    return found.unionByName(points.where(F.col(ip).isNull()), allowMissingColumns=True)
