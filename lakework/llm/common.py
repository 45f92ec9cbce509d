"""Small helpers that several operators share."""

import ctypes
import functools
import gc
import os

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakework.scratch import scratch_path

#: Rows up to which a table of a few short columns is broadcast; beyond it Spark shuffles.
BROADCAST_ROWS = 500_000


def cut(df, name):
    """Write ``df`` below the shared folder and read it back: one evaluation, no lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def if_small(df, rows=BROADCAST_ROWS):
    """``df`` with a broadcast hint if a count shows that it has at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def width(spark):
    """Partitions of a shuffle, as the session sets them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_order(df, order, ties=()):
    """Sort ``df`` over range partitions and number the rows inside each.

    Adds ``part`` (ascending with the order) and ``at`` (from 0 in each part).
    The sort key should be unique enough to split: a run of rows with one key
    stays in one part, in order of ``ties``, which are worked out there.
    """
    mid = F.monotonically_increasing_id()
    return (
        df.repartitionByRange(width(df.sparkSession), *order).sortWithinPartitions(*order, *ties)
        .withColumn("at", mid)
        .withColumns({"part": F.shiftright("at", 33), "at": F.col("at").bitwiseAND((1 << 33) - 1)})
    )


def part_offsets(df, **sums):
    """Per ``part``, the sum of each column over all earlier parts; a row per part.

    ``sums`` maps a new name to a column; ``<name>_total`` is the sum over all parts.
    """
    parts = df.groupBy("part").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    return parts.select(
        "part",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in sums],
        *[F.sum(n).over(everything).alias(f"{n}_total") for n in sums],
    )


def chunks(batch, column, size=4 << 20):
    """Slices of a record batch with about ``size`` bytes in a binary column each.

    A longer value makes a slice of its own.
    """
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(
        zero_copy_only=False)
    begin = held = 0
    for i, n in enumerate(lengths):
        if held and held + n > size:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += int(n) + 64
    if begin < len(lengths):
        yield batch.slice(begin)


def thrifty(function):
    """A function of Arrow batches whose worker gives back its unused memory behind the last one.

    Spark keeps workers for later tasks, and allocators what they have freed; without this an
    idle worker holds as much as its task did.
    """
    @functools.wraps(function)
    def run(batches):
        yield from function(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)
    return run


def share_code(spark):
    """Let Python workers import this package where they see the same folder.

    That is so for a local master and for a shared mount; otherwise the package
    is sent along with ``--py-files``, and the extra entry is without effect.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [root])
