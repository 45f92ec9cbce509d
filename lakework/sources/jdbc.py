"""Relational tables over JDBC."""


def jdbc_options(url, table, user=None, password=None, driver=None, **extra):
    """Connection options; unset ones are left out."""
    options = {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}
    options.update(extra)
    return {name: str(value) for name, value in options.items() if value is not None}


def split_options(column, lower, upper, partitions):
    """Options that read a table in ``partitions`` ranges of a numeric or time column.

    Rows outside the bounds are read too, in the first and last range.
    """
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    return {
        "partitionColumn": column, "lowerBound": lower, "upperBound": upper,
        "numPartitions": partitions,
    }


def hash_predicates(column, partitions, hash_sql="abs(hashtext({column}))"):
    """Predicates that split a table on a text key, one task each.

    ``hash_sql`` is the database's own hash function; the NULL key goes to the first task.
    """
    expression = hash_sql.format(column=column)
    slices = [f"mod({expression}, {partitions}) = {i}" for i in range(partitions)]
    slices[0] = f"({slices[0]} or {column} is null)"
    return slices


def read_jdbc(spark, options, split=None, predicates=None, fetchsize=10_000):
    """A database table, in one task or split by a column range or by predicates.

    ``options`` come from ``jdbc_options``, ``split`` from ``split_options``.
    """
    if predicates:
        rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(
            options["url"], options["dbtable"], predicates=predicates,
            properties={**rest, "fetchsize": str(fetchsize)},
        )
    reader = spark.read.format("jdbc").options(**options).option("fetchsize", fetchsize)
    return reader.options(**(split or {})).load()
