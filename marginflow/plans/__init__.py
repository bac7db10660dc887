"""Feed builders, the end-to-end margin pipeline and the registry of named queries."""


def all_queries():
    """Import every query module and return (queries, oracle_sql)."""
    from . import queries_basic  # noqa: F401
    for mod in ("queries_arrival", "queries_bucketing", "queries_pipeline", "queries_run"):
        try:
            __import__(f"{__name__}.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"{__name__}.{mod}":
                raise
    from .registry import ORACLE, QUERIES
    return dict(QUERIES), dict(ORACLE)
