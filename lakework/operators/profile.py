"""Column profiles and row counts, exact and sampled."""

from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType,
)

from lakework.functions.columns import quoted


def row_count(df, name="n"):
    """One row with the number of rows."""
    return df.agg(F.count(F.lit(1)).alias(name))


def profile(df, columns=None):
    """Count, mean, standard deviation, minimum and maximum of numeric columns, by default all.

    One pass over the data; the result is long: ``(col, stat, value double)``. A frame
    without numeric columns gives no rows.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    columns = columns or numeric
    if not columns:
        return df.sparkSession.createDataFrame([], "col string, stat string, value double")
    stats = {
        "count": F.count, "mean": F.mean, "stddev": F.stddev, "min": F.min, "max": F.max,
    }
    wide = df.agg(*[
        stat(F.col(quoted(c))).cast("double").alias(f"_{i}_{s}")
        for i, c in enumerate(columns) for s, stat in stats.items()
    ])
    cells = F.array(*[
        F.struct(F.lit(c).alias("col"), F.lit(s).alias("stat"), F.col(f"_{i}_{s}").alias("value"))
        for i, c in enumerate(columns) for s in stats
    ])
    return wide.select(F.inline(cells))


def _described(column, kind):
    """The statistics of a column by the kind of its type: name, kind of value, aggregate."""
    counted = [("count", "number", F.count(column))]
    if isinstance(kind, BooleanType):
        column, kind = column.cast("int"), None
    if kind is None or isinstance(kind, NumericType):
        return counted + [(name, "number", stat(column)) for name, stat in (
            ("mean", F.mean), ("stddev", F.stddev), ("min", F.min), ("max", F.max))]
    if isinstance(kind, StringType):
        return counted + [
            ("min", "text", F.min(column)), ("max", "text", F.max(column)),
            ("shortest", "number", F.min(F.length(column))), ("longest", "number", F.max(F.length(column)))]
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return counted + [("min", "time", F.min(column)), ("max", "time", F.max(column))]
    return counted


def describe(df, columns=None):
    """Statistics of columns of any type, by default of all, in one pass over the data.

    The result is long: ``col, stat, number double, text string, time timestamp_ntz``, of which
    the one that fits the type is filled. Every column has its count; numbers and booleans
    (1 for true) have mean, standard deviation, minimum and maximum, texts the first and last in
    byte order and the shortest and longest length, dates and times the earliest and latest.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    found = [
        (name, *stat) for name in columns or df.columns
        for stat in _described(F.col(quoted(name)), kinds[name])]
    if not found:
        return df.sparkSession.createDataFrame(
            [], "col string, stat string, number double, text string, time timestamp_ntz")
    types = {"number": "double", "text": "string", "time": "timestamp_ntz"}
    wide = df.agg(*[
        value.cast(types[kind]).alias(f"_{i}") for i, (_, _, kind, value) in enumerate(found)])
    cells = F.array(*[
        F.struct(
            F.lit(name).alias("col"), F.lit(stat).alias("stat"),
            *[(F.col(f"_{i}") if kind == k else F.lit(None)).cast(t).alias(k) for k, t in types.items()])
        for i, (name, stat, kind, _) in enumerate(found)])
    return wide.select(F.inline(cells))


def sampled_count(df, fraction=0.01, seed=1, name="approx_n"):
    """Row count estimated from a seeded Bernoulli sample.

    The draw depends on the partitioning; ``hashed_count`` does not.
    """
    drawn = df.sample(fraction=fraction, seed=seed)
    estimate = F.round(F.count(F.lit(1)) / F.lit(fraction))
    return drawn.agg(estimate.cast("bigint").alias(name))


def hashed_count(df, keys, one_in=100, name="approx_n"):
    """Row count estimated from the rows whose key hash is in the lowest ``one_in``-th.

    The same rows are drawn on every run, cluster and partitioning.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    text = F.concat_ws("-", *[F.col(quoted(k)).cast("string") for k in keys])
    place = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    drawn = F.count_if(place < F.lit(2 ** 32 // one_in))
    return df.agg((drawn * one_in).alias(name))
