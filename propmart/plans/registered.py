"""All registered queries of the library's own operators, and their DuckDB SQL."""

from __future__ import annotations

from propmart.plans import analogs, zone_analogs

QUERIES = {**analogs.QUERIES, **zone_analogs.QUERIES}
ORACLE_SQL = {**analogs.ORACLE_SQL, **zone_analogs.ORACLE_SQL}
