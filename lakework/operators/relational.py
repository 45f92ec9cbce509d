"""Joins, aggregates, top-k and unions."""

from functools import reduce

from pyspark.sql import functions as F

from lakework.functions.columns import quoted


def enrich(fact, dimension, key, take, dimension_key=None):
    """Inner equi-join that keeps every fact column and adds ``take`` from the dimension.

    No broadcast is forced: Spark broadcasts the dimension when its size is under
    ``autoBroadcastJoinThreshold`` and otherwise shuffles both sides, where adaptive
    execution splits the partitions of hot keys.
    """
    right = dimension_key or key
    columns = list(dict.fromkeys([right, *take]))
    return (
        fact.alias("r")
        .join(dimension.select(*map(quoted, columns)).alias("m"), F.col(f"r.{quoted(key)}") == F.col(f"m.{quoted(right)}"))
        .select("r.*", *[F.col(f"m.{quoted(name)}") for name in take])
    )


def count_and_mean(df, by, counted, averaged, count_name="qty", mean_name="mean"):
    """Non-null count of one column and mean of another per group."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(
        F.count(counted).alias(count_name), F.mean(averaged).alias(mean_name)
    )


def joined_count_and_mean(fact, dimension, key, by, counted, averaged,
                          count_name="qty", mean_name="mean", dimension_key=None):
    """``count_and_mean`` of fact columns grouped by dimension columns.

    The facts are summed per join key before the join. The map-side half of that
    sum shrinks a hot key to one row per task, so the join sees one fact row per
    key and cannot be skewed; its shuffle also serves the join.
    """
    right = dimension_key or key
    by = [by] if isinstance(by, str) else list(by)
    per_key = (
        fact.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(
            F.count(counted).alias("_count"),
            F.sum(averaged).alias("_sum"),
            F.count(averaged).alias("_averaged"),
        )
    )
    names = dimension.select(F.col(right).alias("_right"), *by)
    return (
        per_key.join(names, F.col("_key") == F.col("_right"))
        .groupBy(*by)
        .agg(
            F.sum("_count").alias(count_name),
            F.try_divide(F.sum("_sum"), F.sum("_averaged")).alias(mean_name),
        )
    )


def top(df, n, descending, ties):
    """The ``n`` rows with the largest ``descending``; ``ties`` makes the cut repeatable."""
    ties = [ties] if isinstance(ties, str) else list(ties)
    return df.orderBy(F.desc(descending), *[F.asc(c) for c in ties]).limit(n)


def _newest(value, time):
    """Aggregate for the value with the largest time, as a struct of both; skips NULL values.

    A value without a time counts as oldest; of two with equal times the larger
    one is taken, so that the result does not depend on the order of the rows.
    """
    return F.max(F.when(value.isNotNull(), F.struct(time.alias("time"), value.alias("value"))))


def with_keys(df, keys):
    """Rows whose keys are all there."""
    return reduce(lambda d, k: d.where(F.col(quoted(k)).isNotNull()), keys, df)


def _time(order):
    columns = [F.col(quoted(c)) for c in order]
    return columns[0] if len(columns) == 1 else F.struct(*columns)


def last_per_key(df, keys, order, columns=None, sort=True):
    """The newest non-null value of every column per key.

    Each column looks for its own newest value, so a newer NULL does not hide an
    older value. Null keys are dropped. ``order`` is one column or several, later
    ones breaking ties.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    columns = columns or [c for c in df.columns if c not in keys]

    def newest(name):
        value = F.col(quoted(name))
        return F.max(value) if name == order[0] else _newest(value, _time(order))["value"]

    aggregates = [newest(c).alias(c) for c in columns]
    result = with_keys(df, keys).groupBy(*keys).agg(*aggregates)
    return result.orderBy(*keys) if sort else result


def dated_values(df, keys, order):
    """Rows ready for ``merge_newest``: ``as_of`` holds the time of each non-null value."""
    columns = [c for c in df.columns if c not in keys]
    times = [F.when(F.col(quoted(c)).isNotNull(), _time(order)).alias(c) for c in columns]
    return df.withColumn("as_of", F.struct(*times))


def merge_newest(frames, keys):
    """One row per key from frames with ``as_of``, which the result has too.

    Merging in steps gives what ``last_per_key`` gives over all rows at once, also
    when rows arrive late.
    """
    rows = with_keys(union_by_name(frames), keys)
    columns = [c for c in rows.columns if c not in keys and c != "as_of"]
    newest = rows.groupBy(*keys).agg(*[
        _newest(F.col(quoted(c)), F.col("as_of").getField(c)).alias(c) for c in columns
    ])
    values = [F.col(quoted(c)).getField("value").alias(c) for c in columns]
    times = [F.col(quoted(c)).getField("time").alias(c) for c in columns]
    return newest.select(*keys, *values, F.struct(*times).alias("as_of"))


def union_by_name(frames):
    """All rows of all frames, columns matched by name, missing ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def funnel(df, **predicates):
    """One row counting all rows and, per named predicate, those that pass it."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(predicate).alias(name) for name, predicate in predicates.items()],
    )


def members(df, column, values):
    """Rows whose ``column`` is in ``values``: a literal list, or a frame for long lists.

    The frame's first column holds the values; repeated ones are dropped first, in
    the shuffle that the join needs anyway.
    """
    if isinstance(values, (list, tuple, set, frozenset)):
        return df.where(F.col(quoted(column)).isin(list(values)))
    wanted = values.select(F.col(quoted(values.columns[0])).alias("_wanted")).distinct()
    return df.join(wanted, F.col(quoted(column)) == F.col("_wanted"), "left_semi")
