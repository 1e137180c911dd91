"""Queries over the test tables, shaped as bureau data."""


def load_registry():
    """Import all query modules and return the filled registry."""
    from bridge import document_queries, flat_queries, registry  # noqa: F401

    return registry
