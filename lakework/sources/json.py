"""JSON readers."""

from pyspark.sql import functions as F

# Microseconds survive a round trip only when both sides name this format.
NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

DICTIONARY_TYPE = "map<string,array<string>>"


def read_json(spark, path, schema=None, multiline=False, glob="*.json", **options):
    """JSON files below ``path``: a record per line, or with ``multiline`` a document per file.

    Files that do not match ``glob`` are left alone. Without a schema the types are
    inferred, which reads the data once more.
    """
    reader = spark.read.options(
        multiLine=multiline, pathGlobFilter=glob, timestampNTZFormat=NTZ_FORMAT, **options
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_dictionary(spark, path, glob="*.json", column="entries"):
    """One key -> list document per file as a map column."""
    text = spark.read.text(path, wholetext=True, pathGlobFilter=glob)
    return text.select(F.from_json("value", DICTIONARY_TYPE).alias(column))


def parse_payload(df, column, schema, into=None, **options):
    """Replace a JSON text column by the parsed value."""
    return df.withColumn(into or column, F.from_json(F.col(column), schema, options))
