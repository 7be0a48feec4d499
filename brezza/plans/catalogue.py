"""All registered queries of the core."""

from __future__ import annotations

from brezza.plans import problems, reference_queries, reference_sql

FLAGSHIP = "m12_exceedances_yearly"


def queries() -> dict[str, problems.Query]:
    return {**problems.QUERIES, **reference_queries.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**problems.ORACLES, **reference_sql.ORACLES}
