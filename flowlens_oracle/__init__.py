"""DuckDB oracle statements, one per registered query."""

from .daily import SQL as _DAILY
from .enriched import SQL as _ENRICHED

ORACLE_SQL: dict[str, str] = {}
ORACLE_SQL.update(_DAILY)
ORACLE_SQL.update(_ENRICHED)
