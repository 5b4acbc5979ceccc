"""A lattice of grains: several aggregates of the same facts from one scan.

The facts are read once, into a pre-aggregate over the union of all keys. Every
coarser grain is a sum over a written grain that holds its keys -- the one with
the fewest rows. ``keep`` writes a grain that several others follow from. Sums of sums
are exact (integer measures; a sum over only NULLs stays NULL), so the
result of a grain doesn't depend on the way it was reached."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize


class Lattice:
    """``keys``: name -> expression over the facts; ``measures``: name ->
    aggregate over the facts that adds up (a sum or a count)."""

    def __init__(self, facts: DataFrame, keys: Mapping[str, Column], measures: Mapping[str, Column]):
        self.measures = list(measures)
        base = facts.groupBy(*[e.alias(k) for k, e in keys.items()]).agg(*[e.alias(m) for m, e in measures.items()])
        self.levels: list[tuple[frozenset[str], DataFrame, int]] = []
        self._write(list(keys), base)

    def _write(self, keys: Sequence[str], df: DataFrame) -> DataFrame:
        written = materialize(df, "grain")
        self.levels.append((frozenset(keys), written, written.count()))
        return written

    def parent(self, keys: Sequence[str]) -> DataFrame:
        """The smallest written grain that holds ``keys``."""
        fitting = [(rows, len(have), at) for at, (have, _, rows) in enumerate(self.levels) if have.issuperset(keys)]
        if not fitting:
            raise ValueError(f"no grain holds {sorted(keys)}")
        return self.levels[min(fitting)[2]][1]

    def grain(self, keys: Sequence[str], only: str | None = None) -> DataFrame:
        """``keys`` and the measures; ``only``: a boolean key that must be true."""
        rows = self.parent([*keys, *([only] if only else [])])
        if only:
            rows = rows.where(F.col(only))
        return rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in self.measures])

    def keep(self, keys: Sequence[str]) -> DataFrame:
        """Writes the grain, for coarser ones to follow from it."""
        return self._write(keys, self.grain(keys))
