"""The inferred schema of a CSV file."""

from lakework.sinks.display import schema_rows
from lakework.sources.csv import read_csv


def schema_report(spark, path):
    return schema_rows(read_csv(spark, path, infer=True))
