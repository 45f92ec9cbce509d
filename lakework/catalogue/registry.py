"""Name -> query and name -> oracle SQL."""

QUERIES = {}
ORACLES = {}


def query(sql=None, name=None):
    """Register a ``(spark, folder) -> DataFrame`` function, by default under its own name."""
    def register(function):
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function
    return register


def epoch_seconds(name):
    """Seconds since 1970 of a zone-free time column, as an expression in SQL text."""
    return (
        f"(datediff({name}, date'1970-01-01') * 86400L + hour({name}) * 3600L"
        f" + minute({name}) * 60L + second({name}))"
    )
