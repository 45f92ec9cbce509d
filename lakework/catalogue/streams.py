"""The streams, run over what has landed until nothing is left."""

from pyspark.sql import functions as F

from lakework.catalogue.jobs import (
    MARKET_COLUMNS, MARKET_KEYS, MARKET_SQL, market_responses, rounds,
)
from lakework.catalogue.registry import query
from lakework.layers import Lake
from lakework.plans import market
from lakework.scratch import scratch_path
from lakework.sources.tables import read_table
from lakework.streaming import market as streams


def _in_rounds(spark, folder, landing, run):
    """Land the events in overlapping rounds and call ``run(stream)`` after each of them."""
    events = read_table(spark, folder, "events")
    for rows in rounds(events, "event_id"):
        rows.write.mode("append").parquet(landing)
        run(streams.read_stream(spark, landing, events.schema, fmt="parquet")).awaitTermination()


@query("""
    select user_id, arg_max(event_type, ts) as event_type, arg_max(value, ts) as value, max(ts) as ts
    from events group by user_id
""")
def stream_latest(spark, folder):
    root = scratch_path(spark, "stream-latest")
    _in_rounds(spark, folder, f"{root}/landing", lambda events: streams.start_latest(
        events.select("user_id", "ts", "event_id", "event_type", "value"),
        ["user_id"], ["ts", "event_id"], f"{root}/changes", f"{root}/checkpoint",
    ))
    return streams.read_latest(spark, f"{root}/changes", ["user_id"]).drop("event_id")


@query("""
    select distinct user_id, event_type, date_trunc('hour', ts) as datetime from events
""")
def stream_history(spark, folder):
    root = scratch_path(spark, "stream-history")
    # Not date_trunc, which takes zone-free times through the session's zone.
    hour = F.to_date("ts").cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour("ts"))
    keys = ["user_id", "event_type", "datetime"]
    _in_rounds(spark, folder, f"{root}/landing", lambda events: streams.start_history(
        events.select("user_id", "event_type", hour.alias("datetime")),
        keys, F.to_date("datetime"), f"{root}/history", f"{root}/checkpoint",
    ))
    return spark.read.parquet(f"{root}/history").select(*keys)


@query(MARKET_SQL)
def stream_layers(spark, folder):
    lake = Lake(scratch_path(spark, "stream-layers"))
    for calls in rounds(market_responses(spark, folder), "fetched_at"):
        market.land(calls, lake.raw("exchanges"))
        landed = streams.read_stream(spark, lake.raw("exchanges"), market.ROUNDS).withColumn(
            "datetime", F.col("_metadata.file_modification_time")
        )
        run = streams.start_layers(
            landed, market.to_silver, MARKET_KEYS, ["datetime"],
            lake.silver("exchanges"), lake.gold("exchanges"), f"{lake.root}/checkpoint",
        )
        run.awaitTermination()
    return streams.read_gold(spark, lake.gold("exchanges")).select(*MARKET_COLUMNS)
