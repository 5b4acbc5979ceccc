"""Column names for helpers that cannot meet the columns of a user's table."""

from __future__ import annotations

from collections.abc import Iterable


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """``names``, each with as many underscores in front as it takes to differ
    from every column (upper and lower case count as equal, as in Spark)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    """A column name as Spark reads it back, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"
