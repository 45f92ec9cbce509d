"""Parquet tables and partitions."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_table(spark, folder, name):
    """The Parquet table ``<folder>/<name>.parquet``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_partition(spark, path, **values):
    """The rows of one partition, e.g. ``ORIGIN="ABR"``.

    Filtering at the root prunes folders and keeps the partition column. Where a text is
    asked for the column is text, so that ``007`` does not become 7.
    """
    df = read_keyed(spark, path, [name for name, value in values.items() if isinstance(value, str)])
    for name, value in values.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def read_keyed(spark, path, keys, **options):
    """A partitioned Parquet folder, or several, whose columns ``keys``, taken from folder names,
    are text."""
    paths = [path] if isinstance(path, str) else list(path)
    found = spark.read.options(**options).parquet(*paths)
    if not keys:
        return found
    schema = StructType([
        StructField(f.name, StringType()) if f.name in keys else f for f in found.schema.fields])
    return spark.read.options(**options).schema(schema).parquet(*paths)


def read_if_present(spark, path, schema=None, **options):
    """A Parquet folder, or None when nothing has been written there yet."""
    reader = spark.read.options(**options)
    try:
        return (reader if schema is None else reader.schema(schema)).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
