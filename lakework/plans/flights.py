"""Flight delays: raw CSV, Parquet per year, Parquet per origin."""

from pyspark.sql import functions as F

from lakework.functions.columns import with_types
from lakework.operators.profile import describe, hashed_count, profile, sampled_count
from lakework.sinks import versions
from lakework.sinks.files import write_partitioned
from lakework.sources.csv import read_csv

# Columns with a type of their own; the others stay text.
TYPES = {"FL_DATE": "date", "DEP_DELAY": "double"}


def raw_to_silver(spark, raw, silver):
    """CSV to Parquet, one folder per year; years already there are replaced."""
    flights = with_types(read_csv(spark, raw), TYPES)
    write_partitioned(flights.withColumn("year", F.year("FL_DATE")), silver, "year")


def silver_to_gold(spark, silver, gold):
    """All years to Parquet with one folder per origin; origins that are gone go."""
    write_partitioned(spark.read.parquet(silver), gold, "ORIGIN", whole=True)


def publish_gold(spark, silver, gold):
    """The same as a new version of gold, which replaces the one before in one step."""
    versions.replace(spark.read.parquet(silver), gold, by="ORIGIN")


def per_origin(spark, gold, by=("ORIGIN",)):
    return versions.read_current(spark, gold, ["ORIGIN"]).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def of_origin(spark, gold, origin):
    """The flights of one origin; only its folder is read."""
    return versions.read_current(spark, gold, ["ORIGIN"]).where(F.col("ORIGIN") == F.lit(origin))


def origin_summary(spark, gold, origin, columns=("DEP_DELAY",)):
    """Profile and sampled row count of one origin."""
    rows = of_origin(spark, gold, origin)
    return profile(rows, list(columns)), sampled_count(rows)


def origin_report(spark, gold, origin, keys, one_in=10):
    """All columns of one origin described, and its row count as estimated from hashed keys."""
    rows = of_origin(spark, gold, origin)
    estimate = hashed_count(rows, keys, one_in).select(
        F.lit("*").alias("col"), F.lit("approx_count").alias("stat"),
        F.col("approx_n").cast("double").alias("number"))
    return describe(rows).unionByName(estimate, allowMissingColumns=True)
