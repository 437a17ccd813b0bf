"""All registered queries."""

from energy_mart.checks import aggregates, inputs, loads, pages, profiling, projections, warehouse  # noqa: F401
from energy_mart.checks.registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
