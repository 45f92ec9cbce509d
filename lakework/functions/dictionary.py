"""Helpers for key -> list dictionaries and maps."""

from pyspark.sql import functions as F


def dictionary_rows(df, column, key="pair", value="exchange"):
    """A ``map<string, array<string>>`` column as one row per key and element.

    A key with an empty list keeps a row with a NULL element.
    """
    entries = df.select(F.explode(column).alias(key, "_values"))
    return entries.select(key, F.explode_outer("_values").alias(value))


def dictionary_sizes(df, column, key="pair", size="n"):
    """One row per key with the length of its list; an empty list counts 0."""
    return df.select(F.explode(column).alias(key, "_values")).select(
        key, F.size("_values").cast("bigint").alias(size)
    )


def to_dictionary(rows, key, value, target, parts=1):
    """Rows to sorted arrays of distinct values per key.

    The duplicates go away in a partially aggregated ``distinct`` first, so an array
    is bounded by the number of *distinct* values of its key. Where that number may
    be large, ``parts`` spreads the values of a key over so many rows, each with a
    ``part`` number and a sorted array of its own, and no value in two of them.
    """
    pairs = rows.select(key, value).where(F.col(key).isNotNull()).distinct()
    by = [F.col(key)]
    if parts > 1:
        by.append(F.pmod(F.xxhash64(value), F.lit(parts)).alias("part"))
    return pairs.groupBy(*by).agg(F.array_sort(F.collect_list(value)).alias(target))


def last_wins(rows, key, value, order):
    """One value per key, the one that came last, as in building a map entry by entry.

    A last value that is NULL stays NULL: it overwrites what came before.
    """
    newest = F.max_by(F.struct(value), order)[value]
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(newest.alias(value))


def lookup(column, key):
    """The value of one map key, NULL when the key is missing."""
    return F.try_element_at(column, F.lit(key))
