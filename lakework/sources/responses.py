"""Landed API responses: one envelope row per call.

``exchange_name, pair, url, status_code, body, fetched_at``; ``body`` is JSON text.
"""

from pyspark.sql import functions as F

ENVELOPE = (
    "exchange_name string, pair string, url string, status_code int, "
    "body string, fetched_at timestamp_ntz"
)

# Address patterns of a market summary (exchange, pair) and of a pair.
SUMMARY_URL = "https://api.cryptowat.ch/markets/%s/%s/summary"
PAIR_URL = "https://api.cryptowat.ch/pairs/%s"

# Shapes of the exchange, pair and pair detail responses.
EXCHANGES = "result array<struct<symbol:string, route:string>>"
PAIRS = (
    "result array<struct<symbol:string, "
    "base:struct<symbol:string, fiat:boolean>, quote:struct<symbol:string, fiat:boolean>>>"
)
PAIR_DETAIL = "result struct<symbol:string, markets:array<struct<exchange:string>>>"


def with_url(df, pattern, columns, into="url"):
    """Add the address to call for each row, ``columns`` filling the pattern in order."""
    return df.withColumn(into, F.format_string(pattern, *[F.col(c) for c in columns]))


def succeeded(responses):
    """Only the calls that returned 200."""
    return responses.where(F.col("status_code") == 200)


def response_counts(responses):
    """One row: all calls, successful calls, failed calls."""
    good = F.coalesce(F.col("status_code") == 200, F.lit(False))
    return responses.agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(good).alias("succeeded"),
        F.count_if(~good).alias("failed"),
    )


def with_data(responses, schema, into="data", body="body"):
    """Keep every call; ``into`` is the parsed body, NULL where the call failed."""
    return responses.withColumn(
        into, F.when(F.col("status_code") == 200, F.from_json(F.col(body), schema))
    )


def result_rows(responses, schema, body="body"):
    """The ``result`` list of successful responses as rows, one column per field."""
    parsed = succeeded(responses).select(F.from_json(F.col(body), schema).alias("data"))
    return parsed.select(F.explode("data.result").alias("item")).select("item.*")
