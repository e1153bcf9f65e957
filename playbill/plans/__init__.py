"""Report compositions and the registered queries."""


def catalog_of_queries() -> dict:
    """All registered queries by name."""
    from playbill.plans import analysis_queries, model_queries, table_queries  # noqa: F401
    from playbill.plans.registry import QUERIES

    return QUERIES
