"""Registry of queries and their oracle SQL."""

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    """Register a query; without ``sql`` only its rows are checked."""
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add
