"""Whole jobs over the given tables."""

from pyspark.sql import functions as F

from lakework.catalogue.registry import epoch_seconds, query
from lakework.layers import Lake
from lakework.plans import flights, market, movies
from lakework.plans.schema_report import schema_report as report_schema
from lakework.scratch import scratch_path
from lakework.sinks.files import write_csv
from lakework.sources.json import NTZ_FORMAT, read_json
from lakework.sources.tables import read_table


# Values of ``k`` that stand for a failed call, a body cut short and a volume that is no number.
FAILED, CUT_SHORT, MISFIT = 13, 14, 15


def market_responses(spark, folder):
    """Events as market calls: the event type is the exchange, the user the pair."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    whole = F.to_json(F.struct(
        F.struct(
            F.struct(
                F.col("value").alias("last"), (F.col("value") + 1).alias("high"),
                (F.col("value") - 1).alias("low"),
                F.struct(
                    F.lit(0.5).alias("percentage"), (F.col("value") * 2).alias("absolute"),
                ).alias("change"),
            ).alias("price"),
            F.when(k == MISFIT, "n/a").when(k >= 10, k.cast("string")).alias("volume"),
            k.cast("double").alias("volumeQuote"),
        ).alias("result"),
        F.struct(F.lit(0.002).alias("cost"), F.lit(10.0).alias("remaining")).alias("allowance"),
    ))
    # Numbers of a body are not quoted; text that is no number is.
    whole = F.regexp_replace(whole, r'"volume":"([0-9]+)"', r'"volume":$1')
    body = F.when(k == FAILED, "<html>").when(k == CUT_SHORT, whole.substr(1, 25)).otherwise(whole)
    return read_table(spark, folder, "events").select(
        F.col("event_type").alias("exchange_name"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("pair"),
        F.when(k == FAILED, 500).otherwise(200).alias("status_code"),
        body.alias("body"),
        F.col("ts").alias("fetched_at"),
    )


def rounds(rows, by, n=3):
    """The rows dealt over ``n`` rounds by a hash; a share of them comes in every round."""
    share = F.pmod(F.xxhash64(by), n + 1)
    return [rows.where(share.isin(i, n)) for i in range(n)]


MARKET_SQL = """
    with calls as (
        select *, json_extract(props, '$.k')::bigint as k from events)
    select event_type as exchange_name, 'u' || user_id as pair,
           arg_max(value, ts) as result_price_last,
           arg_max(value + 1, ts) as result_price_high,
           arg_max(value - 1, ts) as result_price_low,
           arg_max(0.5::double, ts) as result_price_change_percentage,
           arg_max(value * 2, ts) as result_price_change_absolute,
           arg_max(case when k >= 10 and k <> 15 then k::double end, ts) as result_volume,
           arg_max(k::double, ts) as "result_volumeQuote",
           max(ts) as datetime
    from calls where k is null or k not in (13, 14)
    group by event_type, user_id
"""
MARKET_KEYS = ("exchange_name", "pair")
MARKET_COLUMNS = (
    *MARKET_KEYS, *["result_" + value.replace(".", "_") for value in market.VALUES], "datetime")


@query(MARKET_SQL)
def market_gold(spark, folder):
    """Three landed rounds, each with some pairs of an exchange and not others."""
    lake = Lake(scratch_path(spark, "market"))
    for calls in rounds(market_responses(spark, folder), "pair"):
        market.land(calls, lake.raw("exchanges"))
    gold = market.run(spark, lake)
    return market.latest(gold.select(*MARKET_COLUMNS), MARKET_KEYS)


@query("""
    select case json_extract(props, '$.k')::bigint
               when 13 then 'status' when 14 then 'unreadable' else 'misfit' end as reason,
           event_type as exchange_name, count(*)::bigint as n
    from events where json_extract(props, '$.k')::bigint in (13, 14, 15)
    group by 1, 2
""")
def market_rejects(spark, folder):
    """Calls that landed not at all or in part, counted from where landing puts them."""
    root = scratch_path(spark, "market-rejects")
    calls = market_responses(spark, folder)
    market.land(calls, f"{root}/raw", rejects_path=f"{root}/rejects")
    kept = read_json(spark, f"{root}/rejects", "exchange_name string, body string, reason string")
    return kept.groupBy("reason", "exchange_name").agg(F.count(F.lit(1)).alias("n"))


@query(MARKET_SQL)
def market_gold_legacy(spark, folder):
    """The same market from literal text, with dotted names and CSV silver."""
    lake = Lake(scratch_path(spark, "market-legacy"))
    raw, silver, gold = (lake.path(layer, "exchanges") for layer in ("raw", "silver", "gold"))
    k = F.get_json_object("props", "$.k").cast("bigint")
    # Not date_format, which takes zone-free times through the session's zone.
    time = F.to_csv(F.struct("ts"), {"timestampNTZFormat": NTZ_FORMAT})
    number = lambda column: F.coalesce(column.cast("string"), F.lit("None"))
    whole = F.concat(
        F.lit("{'result': {'price': {'last': "), number(F.col("value")),
        F.lit(", 'high': "), number(F.col("value") + 1), F.lit(", 'low': "), number(F.col("value") - 1),
        F.lit(", 'change': {'percentage': 0.5, 'absolute': "), number(F.col("value") * 2),
        F.lit("}}, 'volume': "),
        F.when(k == MISFIT, "'n/a'").when(k >= 10, k.cast("string")).otherwise("None"),
        F.lit(", 'volumeQuote': "), number(k),
        F.lit("}, 'allowance': {'cost': 0.002, 'upgrade': \"it's True\"}, 'exchange_name': '"),
        F.col("event_type"), F.lit("', 'pair': 'u"), F.col("user_id").cast("string"),
        F.lit("', 'fetched_at': '"), time, F.lit("'}"),
    )
    literal = F.when(k == FAILED, "<html>").when(k == CUT_SHORT, whole.substr(1, 25)).otherwise(whole)
    read_table(spark, folder, "events").select(literal.alias("value")).write.text(raw)
    documents = market.read_raw_literals(spark, raw, market.LANDED, glob="*.txt", whole_files=False)
    good = documents.where(market.has_values()).drop("file_path", "decode_failed")
    flat = market.to_silver(good, sep=".")
    market.write_silver_csv(flat, silver)
    # One writer, one header.
    market.csv_silver_to_gold(spark, silver, gold, schema=flat.schema, groups=[silver])
    names = {c: c.replace(".", "_") for c in flat.columns}
    rows = spark.read.parquet(gold).withColumnsRenamed(names).select(*MARKET_COLUMNS)
    return market.latest(rows, MARKET_KEYS)


@query("""
    select o_orderstatus as "ORIGIN", year(o_orderdate)::bigint as year, count(*)::bigint as n
    from orders group by 1, 2
""")
def flight_lake(spark, folder):
    """The lake run twice: an origin of the first run that is gone must not stay in gold."""
    lake = Lake(scratch_path(spark, "flights"))
    delays = read_table(spark, folder, "orders").select(
        F.to_date("o_orderdate").alias("FL_DATE"), F.col("o_orderstatus").alias("ORIGIN"),
        F.col("o_orderpriority").alias("DEST"), F.col("o_totalprice").alias("DEP_DELAY"),
    )
    raw, silver, gold = (lake.path(layer, "airplane-delay") for layer in ("raw", "silver", "gold"))
    gone = delays.withColumn("ORIGIN", F.concat(F.lit("0"), "ORIGIN"))
    for rows in (gone, delays):
        write_csv(rows, raw, header=True, mode="overwrite")
        flights.raw_to_silver(spark, raw, silver)
        flights.publish_gold(spark, silver, gold)
    counts = flights.per_origin(spark, gold, by=("ORIGIN", "year"))
    return counts.withColumn("year", F.col("year").cast("bigint"))


@query("""
    select p_name as title, count(case when l_tax > 0 then 1 end)::bigint as qty_ratings,
           round(avg(case when l_linenumber < 7 then l_quantity end), 6) as avg_rating
    from lineitem join part on l_partkey = p_partkey
    group by p_name order by qty_ratings desc, title limit 10
""")
def movies_top10(spark, folder):
    root = scratch_path(spark, "movies")
    part = read_table(spark, folder, "part")
    write_csv(
        part.select(
            F.col("p_partkey").alias("movieId"), F.col("p_name").alias("title"),
            F.col("p_type").alias("genres"),
        ),
        f"{root}/movies-csv", header=True,
    )
    rating = F.when(F.col("l_linenumber") < 7, F.col("l_quantity").cast("string")).otherwise("n/a")
    write_csv(
        read_table(spark, folder, "lineitem").select(
            F.col("l_orderkey").alias("userId"), F.col("l_partkey").alias("movieId"),
            rating.alias("rating"),
            F.when(F.col("l_tax") > 0, F.expr(epoch_seconds("l_shipdate"))).alias("timestamp"),
        ),
        f"{root}/ratings-csv", header=True,
    )
    # Parquet stands in for the database tables.
    movies.load(
        spark, f"{root}/movies-csv", f"{root}/ratings-csv",
        lambda name, frame: frame.write.parquet(f"{root}/{name}"),
    )
    rows = movies.report(spark.read.parquet(f"{root}/movies"), spark.read.parquet(f"{root}/ratings"))
    return rows.withColumn("avg_rating", F.round("avg_rating", 6))


def _inferred(position, name, sql_type):
    whole = f"case when max({name}) <= 2147483647 then 'int' else 'bigint' end"
    kind = whole if sql_type == "whole" else f"max('{sql_type}')"
    return f"select {position}::bigint as position, '{name}' as name, {kind} as type from lineitem"


_LINE_COLUMNS = (
    ("l_orderkey", "whole"), ("l_partkey", "whole"), ("l_suppkey", "whole"), ("l_linenumber", "whole"),
    ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
    ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp"),
)


@query(" union all ".join(_inferred(i, *column) for i, column in enumerate(_LINE_COLUMNS)))
def schema_report(spark, folder):
    path = scratch_path(spark, "lineitem-csv")
    lineitem = read_table(spark, folder, "lineitem").select(*[name for name, _ in _LINE_COLUMNS])
    write_csv(lineitem, path, header=True)
    return report_schema(spark, path).select("position", "name", "type")
