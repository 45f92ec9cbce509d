"""File writers."""

from pyspark.sql import functions as F

from lakework.functions.columns import quoted
from lakework.sources.json import NTZ_FORMAT

# Doubled quotes, as other CSV programs write them, and blanks at the ends of text kept.
CSV_TEXT = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_report(df, path, order, limit):
    """The first ``limit`` rows as one CSV file with a header, replacing what is there.

    Taking the limit here bounds what the single writing task receives.
    """
    bounded = df.orderBy(*order).limit(limit)
    bounded.coalesce(1).write.mode("overwrite").options(header=True, **CSV_TEXT).csv(path)


def write_csv(df, path, header=False, mode="errorifexists"):
    """A CSV folder; by default without header and only where nothing is yet."""
    df.write.mode(mode).options(header=header, timestampNTZFormat=NTZ_FORMAT, **CSV_TEXT).csv(path)


def write_partitioned(df, path, by, mode="overwrite", fmt="parquet", gather=True, whole=False,
                      **options):
    """A dataset in one folder per value of ``by``.

    With ``overwrite`` only the partitions present in ``df`` are replaced, so a
    rerun gives the same result and other partitions stay; ``whole`` replaces the table,
    partitions that ``df`` no longer has included. The rebalance gathers
    small partitions into few files and spreads a hot value over many tasks, for which
    it needs adaptive execution (without it, asking to gather is an error); with
    ``gather=False`` there is no shuffle and each task writes a file per value it
    holds, which suits a handful of values. ``by`` must not have many distinct
    values: each is a folder.
    """
    by = [by] if isinstance(by, str) else list(by)
    if gather:
        if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
            raise ValueError("gathering needs adaptive execution, which splits hot values; pass gather=False")
        df = df.hint("rebalance", *[F.col(quoted(c)) for c in by])
    writer = df.write.mode(mode).partitionBy(*by)
    replaced = "static" if whole else "dynamic"
    writer.options(partitionOverwriteMode=replaced, **options).format(fmt).save(path)


def land_json(df, path, by):
    """JSON records, one current set of files per value of ``by``."""
    write_partitioned(df, path, by, fmt="json", timestampNTZFormat=NTZ_FORMAT)


def append_json(df, path, by):
    """JSON records beside those already there; no file that exists is touched."""
    write_partitioned(df, path, by, mode="append", fmt="json", timestampNTZFormat=NTZ_FORMAT)


def replace_table(df, path):
    """Replace a Parquet table; refuses to replace it by nothing."""
    if df.isEmpty():
        raise ValueError(f"refusing to overwrite {path} with an empty table")
    df.write.mode("overwrite").parquet(path)
