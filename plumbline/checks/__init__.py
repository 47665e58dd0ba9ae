"""Registered queries on the given tables, each with the SQL that must agree with it."""

from plumbline.checks import registry


def _load() -> None:
    from plumbline.checks import analysis_queries, chain_queries, column_queries, increment_queries, metric_queries, plan_queries, rule_queries  # noqa: F401
    from plumbline.checks import selection_queries, series_queries, source_queries, state_queries  # noqa: F401


def queries() -> dict[str, registry.Query]:
    _load()
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(registry.ORACLES)
