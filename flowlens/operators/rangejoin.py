"""IP range join: attach range payload to points whose address lies in
[lo, hi].

A plain ``BETWEEN`` join has no equality key, so Spark can only run it as a
nested-loop join. This operator turns it into an equi-join:

1. Points are reduced to their distinct key set (address + equi keys) -- the
   "IP dictionary": a hot address that holds a third of all flows becomes one
   row here, and the partial aggregate collapses it before any shuffle.
2. Each range is exploded into every address bucket it covers (all of them,
   not only the bucket of its start). Ranges covering at most ``max_fanout``
   /``bits`` buckets use the fine level; wider ones use the /8 level, so no
   range ever expands to more than ``max_fanout`` rows.
3. Each point carries one key per level; equi-join on (level, bucket, equi
   keys) with the residual ``ip BETWEEN lo AND hi``.
4. ``resolve='most_specific'`` keeps one range per point (narrowest first,
   then the caller's order) with a partial+final aggregate; ``'all'`` keeps
   every match. Overlaps are always resolved: no property of the range table is
   assumed or remembered, so a result never depends on an earlier state of it.
5. The payload is left-joined back to the points on the key set; points with
   a NULL address or no match keep NULL payload.

The exploded range table is broadcast only when its estimated size in bytes (one
aggregate over the range table: exploded rows times fixed and payload width) is
at most ``broadcast_max_bytes``; otherwise the join is planned as a sort-merge
join on the bucket key and AQE may still convert it if the runtime size turns out
small. The estimate picks the strategy only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_MAX_BYTES = 100 * 1024 * 1024
ROW_BYTES = 80            # fixed part of an exploded row in a hash relation


def _fanout_rows(bits: int, max_fanout: int) -> Column:
    """Rows one range explodes into (fine level if it spans <= max_fanout
    buckets, else the /8 level)."""
    lo, hi = F.col("_lo"), F.col("_hi")
    span_fine = F.shiftright(hi, 32 - bits) - F.shiftright(lo, 32 - bits) + 1
    return F.when(span_fine <= max_fanout, span_fine).otherwise(
        F.shiftright(hi, 24) - F.shiftright(lo, 24) + 1)


def _explode_ranges(ranges: DataFrame, bits: int, max_fanout: int) -> tuple[DataFrame, Column]:
    fine_shift, coarse_shift = 32 - bits, 24
    lo, hi = F.col("_lo"), F.col("_hi")
    span_fine = F.shiftright(hi, fine_shift) - F.shiftright(lo, fine_shift) + 1
    is_fine = span_fine <= max_fanout
    level = F.when(is_fine, F.lit(bits)).otherwise(F.lit(8))
    first = F.when(is_fine, F.shiftright(lo, fine_shift)).otherwise(F.shiftright(lo, coarse_shift))
    last = F.when(is_fine, F.shiftright(hi, fine_shift)).otherwise(F.shiftright(hi, coarse_shift))
    rows = last - first + 1
    exploded = ranges.select(
        "*", level.alias("_lvl"), F.explode(F.sequence(first, last)).alias("_b")
    )
    return exploded, F.sum(rows)


def exploded_bytes(rng: DataFrame, payload: Sequence[str], bits: int = 16, max_fanout: int = 256) -> int:
    """Estimated size of the exploded range table (one small job)."""
    width = F.lit(ROW_BYTES)
    for c in payload:
        width = width + F.coalesce(F.length(F.col(c).cast("string")), F.lit(0))
    return int(rng.agg(F.sum(_fanout_rows(bits, max_fanout) * width).alias("n")).first()["n"] or 0)


def range_matches(
    keys: DataFrame,
    ranges: DataFrame,
    ip: str,
    lo: str,
    hi: str,
    payload: Sequence[str],
    equi: Sequence[tuple[str, str]] = (),
    resolve: str = "most_specific",
    order: Sequence[Column] = (),
    bits: int = 16,
    max_fanout: int = 256,
    broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """Matches for distinct, non-NULL point keys: (ip, equi keys...) ->
    payload columns. Keys without a match are absent."""
    rename = dict(rename or {})
    out_names = [rename.get(c, c) for c in payload]
    point_keys = [ip] + [p for p, _ in equi]

    fine_shift = 32 - bits
    keyed = keys.select(
        *point_keys,
        F.explode(
            F.array(
                F.struct(F.lit(bits).alias("l"), F.shiftright(F.col(ip), fine_shift).alias("b")),
                F.struct(F.lit(8).alias("l"), F.shiftright(F.col(ip), 24).alias("b")),
            )
        ).alias("_k"),
    ).select(*point_keys, F.col("_k.l").alias("_lvl"), F.col("_k.b").alias("_b"))

    order_fields = [c.alias(f"_ord{i}") for i, c in enumerate(order)]
    # IPv4 ranges only: IPv6 or malformed rows (too large for BIGINT, or outside
    # [0, 2^32)) are ignored rather than raising or exploding
    rng = ranges.select(
        F.col(lo).try_cast("bigint").alias("_lo"),
        F.col(hi).try_cast("bigint").alias("_hi"),
        *[F.col(r).alias(f"_eq{i}") for i, (_, r) in enumerate(equi)],
        *order_fields,
        *[F.col(c).alias(f"_pl{j}") for j, c in enumerate(payload)],
    ).where((F.col("_lo") >= 0) & (F.col("_hi") < F.lit(1 << 32)) & (F.col("_lo") <= F.col("_hi")))
    exploded, _ = _explode_ranges(rng, bits, max_fanout)

    if exploded_bytes(rng, [f"_pl{j}" for j in range(len(payload))], bits, max_fanout) <= broadcast_max_bytes:
        exploded = F.broadcast(exploded)
    else:
        exploded = exploded.hint("merge")

    cond = (keyed["_lvl"] == exploded["_lvl"]) & (keyed["_b"] == exploded["_b"])
    for i, (p, _) in enumerate(equi):
        cond = cond & (keyed[p] == exploded[f"_eq{i}"])
    cond = cond & keyed[ip].between(exploded["_lo"], exploded["_hi"])
    cand = keyed.join(exploded, cond, "inner").select(
        *[keyed[c] for c in point_keys],
        (exploded["_hi"] - exploded["_lo"]).alias("_width"),
        *[exploded[f"_ord{i}"] for i in range(len(order))],
        *[exploded[f"_pl{j}"] for j in range(len(payload))],
    )

    if resolve == "most_specific":
        best = F.min(F.struct(
            "_width",
            *[F.col(f"_ord{i}") for i in range(len(order))],
            *[F.col(f"_pl{j}") for j in range(len(payload))],
        )).alias("_best")
        return cand.groupBy(*point_keys).agg(best).select(
            *point_keys, *[F.col(f"_best._pl{j}").alias(out_names[j]) for j in range(len(payload))]
        )
    if resolve == "all":
        return cand.select(
            *point_keys, *[F.col(f"_pl{j}").alias(out_names[j]) for j in range(len(payload))]
        )
    raise ValueError(f"unknown resolve {resolve!r}")


def range_join(points: DataFrame, ranges: DataFrame, ip: str, lo: str, hi: str, payload: Sequence[str],
               equi: Sequence[tuple[str, str]] = (), points_distinct: bool = False, **kw) -> DataFrame:
    """Left-join ``payload`` columns of ``ranges`` onto ``points``.

    ``equi`` pairs (point column, range column) must also be equal.
    ``order`` (Columns over range columns) breaks ties after the range width
    when ``resolve='most_specific'``; ``rename`` maps payload names to output
    names. The join itself runs on the distinct key set only;
    ``points_distinct=True`` declares that ``points`` already has one row per
    key, so the key set and the join-back share one computation (exchange
    reuse) instead of aggregating the points twice.
    """
    point_keys = [ip] + [p for p, _ in equi]
    if points_distinct:
        # no filter here: it would be pushed below the caller's aggregate and
        # defeat exchange reuse; NULL addresses simply find no bucket
        keys = points.select(*point_keys)
    else:
        keys = points.select(*point_keys).where(F.col(ip).isNotNull()).distinct()
    matches = range_matches(keys, ranges, ip, lo, hi, payload, equi=equi, **kw)
    return points.join(matches, point_keys, "left")


def ip_dictionary(points: DataFrame, ip: str, ranges: DataFrame, lo: str, hi: str, payload: Sequence[str], **kw) -> DataFrame:
    """Distinct addresses of ``points`` with their range payload."""
    keys = [ip] + [p for p, _ in kw.get("equi", ())]
    return range_join(points.select(*keys).distinct(), ranges, ip, lo, hi, payload, **kw)
