"""Descriptions of whole tables: every column, every nested field, every step of a job."""

from pyspark.sql import functions as F

from lakework.catalogue.files import python_string
from lakework.catalogue.registry import query
from lakework.layers import Lake
from lakework.operators import profile as profiles
from lakework.plans import flights, universe
from lakework.scratch import scratch_path
from lakework.sinks.display import nested_schema_rows, preview
from lakework.sinks.files import write_csv
from lakework.sources.csv import read_csv
from lakework.sources.json import read_json
from lakework.sources.literal import decode_literals
from lakework.sources.tables import read_table


def described_sql(table, columns):
    """``describe`` of a table: columns by the kind of their type."""
    rows = []
    for name, kind in columns.items():
        stats = [("count", "number", f"count({name})")]
        if kind == "number":
            stats += [(s, kind, f"round({f}({name})::double, 4) + 0") for s, f in (
                ("mean", "avg"), ("stddev", "stddev_samp"), ("min", "min"), ("max", "max"))]
        elif kind == "text":
            stats += [("min", kind, f"min({name})"), ("max", kind, f"max({name})"),
                      ("shortest", "number", f"min(length({name}))"), ("longest", "number", f"max(length({name}))")]
        else:
            stats += [("min", kind, f"min({name})::timestamp"), ("max", kind, f"max({name})::timestamp")]
        for stat, kind_of_value, value in stats:
            number, text, time = (
                f"({value})::{t}" if kind_of_value == k else f"null::{t}"
                for k, t in (("number", "double"), ("text", "varchar"), ("time", "timestamp")))
            rows.append(f"select '{name}' as col, '{stat}' as stat, {number} as number,"
                        f" {text} as text, {time} as time from {table}")
    return " union all ".join(rows)


_LINEITEM = {
    **dict.fromkeys(("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                     "l_extendedprice", "l_discount", "l_tax"), "number"),
    "l_returnflag": "text", "l_linestatus": "text", "l_shipdate": "time"}


def _rounded(described):
    return described.withColumn("number", F.round("number", 4))


@query(described_sql("lineitem", _LINEITEM))
def describe_lineitem(spark, folder):
    return _rounded(profiles.describe(read_table(spark, folder, "lineitem")))


@query(described_sql("documents", {
    "doc_id": "number", "text": "text", "lang": "text", "source": "text", "n_chars": "number"}))
def describe_documents(spark, folder):
    return _rounded(profiles.describe(read_table(spark, folder, "documents")))


_FLIGHTS = """
    with rows as (
        select o_orderdate::date as FL_DATE, o_orderpriority as DEST, o_totalprice as DEP_DELAY,
               year(o_orderdate) as year, o_orderstatus as ORIGIN
        from orders where o_orderstatus = 'F')
"""


@query(_FLIGHTS + described_sql("rows", {
    "FL_DATE": "time", "DEST": "text", "DEP_DELAY": "number", "year": "number", "ORIGIN": "text"}) + """
    union all
    select '*', 'approx_count', (count(*) filter (
        ('0x' || substr(md5(FL_DATE || '-' || DEP_DELAY), 1, 8))::bigint < 4294967296 // 10) * 10)::double,
        null, null
    from rows
""")
def flight_profile(spark, folder):
    """One origin of the flight lake: all of its columns, and its size from hashed keys."""
    lake = Lake(scratch_path(spark, "flight-profile"))
    raw, silver, gold = (lake.path(layer, "airplane-delay") for layer in ("raw", "silver", "gold"))
    write_csv(read_table(spark, folder, "orders").select(
        F.to_date("o_orderdate").alias("FL_DATE"), F.col("o_orderstatus").alias("ORIGIN"),
        F.col("o_orderpriority").alias("DEST"), F.col("o_totalprice").alias("DEP_DELAY"),
    ), raw, header=True)
    flights.raw_to_silver(spark, raw, silver)
    flights.publish_gold(spark, silver, gold)
    return _rounded(flights.origin_report(spark, gold, "F", ["FL_DATE", "DEP_DELAY"]))


_NESTED = (
    ("at", "string", 0), ("item", "struct", 0), ("item.k", "bigint", 1), ("item.values", "array", 1),
    ("item.values[]", "double", 2), ("kinds", "array", 0), ("kinds[]", "struct", 1),
    ("kinds[].name", "string", 2), ("kinds[].user", "bigint", 2), ("number", "bigint", 0))


@query(" union all ".join(
    f"select {i}::bigint as position, '{path}' as path, '{kind}' as type, true as nullable, {depth} as depth"
    " from events having count(event_id) > 0" for i, (path, kind, depth) in enumerate(_NESTED)))
def nested_schema(spark, folder):
    """The inferred schema of nested documents, with all that is nested."""
    path = scratch_path(spark, "nested-json")
    read_table(spark, folder, "events").select(
        F.col("event_id").alias("number"), F.col("ts").cast("string").alias("at"),
        F.struct(
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
            F.array(F.col("value"), F.col("value") * 2).alias("values")).alias("item"),
        F.array(F.struct(F.col("event_type").alias("name"), F.col("user_id").alias("user"))).alias("kinds"),
    ).write.json(path)
    return nested_schema_rows(read_json(spark, path))


@query("""
    with pairs as (
        select lower(c_mktsegment) || c_nationkey as pair, 'x' || (c_custkey % 7) as exchange, c_acctbal,
               lower(c_mktsegment) = 'building' and (c_nationkey < 5 or c_acctbal < 0) as kept
        from customer),
    rows as (
        select distinct pair, exchange from pairs
        where c_acctbal <= 9000
            and pair in (select pair from pairs where kept and c_acctbal > -500)
            and pair in ('building1', 'building2', 'building7', 'building9')),
    budget as (select pair, count(*)::bigint as calls from rows group by pair)
    select pair, exchange, 'https://api.cryptowat.ch/markets/' || exchange || '/' || pair || '/summary' as url,
           calls, round(calls * 0.002::double, 6) as cost_per_round,
           round(10 / (calls * 0.002::double), 6) as rounds_per_day,
           round(10 / (calls * 0.002::double) / 24, 6) as rounds_per_hour
    from rows join budget using (pair)
""")
def pair_calls(spark, folder):
    """Listed pairs to polled addresses in one job; some listings and some details failed."""
    customers = read_table(spark, folder, "customer").select(
        F.concat(F.lower("c_mktsegment"), F.col("c_nationkey").cast("string")).alias("pair"), "*")
    side = lambda symbol, fiat: F.struct(symbol.alias("symbol"), fiat.alias("fiat"))
    listings = customers.select(
        F.when(F.col("c_acctbal") > -500, 200).otherwise(503).alias("status_code"),
        F.to_json(F.struct(F.array(F.struct(
            F.col("pair").alias("symbol"), side(F.lower("c_mktsegment"), F.col("c_nationkey") < 5).alias("base"),
            side(F.col("c_nationkey").cast("string"), F.col("c_acctbal") < 0).alias("quote"),
        )).alias("result"))).alias("body"))
    exchange = F.concat(F.lit("x"), (F.col("c_custkey") % 7).cast("string"))
    details = customers.select(
        "pair", F.when(F.col("c_acctbal") > 9000, 500).otherwise(200).alias("status_code"),
        F.to_json(F.struct(F.struct(
            F.col("pair").alias("symbol"), F.array(F.struct(exchange.alias("exchange"))).alias("markets"),
        ).alias("result"))).alias("body"))
    calls = universe.polling_calls(
        listings, details, "building", ("building1", "building2", "building7", "building9"))
    return calls.withColumns({
        c: F.round(c, 6) for c in ("cost_per_round", "rounds_per_day", "rounds_per_hour")})


_TIME = "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f')"


def _orders_csv(spark, folder, header):
    path = scratch_path(spark, "all-orders-csv")
    write_csv(read_table(spark, folder, "orders"), path, header=header)
    return path


@query(f"""
    select o_orderkey::varchar as o_orderkey, o_custkey::varchar as o_custkey, o_orderstatus,
           o_totalprice::varchar as o_totalprice, {_TIME} as o_orderdate, o_orderpriority
    from orders
""")
def csv_all_columns(spark, folder):
    return read_csv(spark, _orders_csv(spark, folder, header=True))


@query("select * from orders")
def csv_inferred_all_columns(spark, folder):
    """Inference takes the times for zoned ones; the session's zone gives them back."""
    orders = read_csv(spark, _orders_csv(spark, folder, header=True), infer=True)
    return orders.withColumns({
        "o_orderkey": F.col("o_orderkey").cast("bigint"), "o_custkey": F.col("o_custkey").cast("bigint"),
        "o_orderdate": F.col("o_orderdate").cast("timestamp_ntz")})


@query(f"""
    select o_orderkey::varchar as _c0, o_custkey::varchar as _c1, o_orderstatus as _c2,
           o_totalprice::varchar as _c3, {_TIME} as _c4, o_orderpriority as _c5
    from orders
""")
def csv_no_header_all_columns(spark, folder):
    return read_csv(spark, _orders_csv(spark, folder, header=False), header=False)


@query("select doc_id::varchar as doc_id, text, lang, source, n_chars::varchar as n_chars from documents")
def csv_text_all_columns(spark, folder):
    path = scratch_path(spark, "all-documents-csv")
    write_csv(read_table(spark, folder, "documents"), path, header=True)
    return read_csv(spark, path)


@query("select doc_id, text, lang, source, n_chars, false as failed from documents")
def literal_all_columns(spark, folder):
    """Every column of the documents from the text of a literal."""
    literal = read_table(spark, folder, "documents").select(F.concat(
        F.lit("{'doc_id': "), F.col("doc_id").cast("string"),
        *[part for name in ("text", "lang", "source") for part in (
            F.lit(f", '{name}': "), python_string(name))],
        F.lit(", 'n_chars': "), F.col("n_chars").cast("string"), F.lit("}"),
    ).alias("value"))
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return decode_literals(literal, "value", schema, failed="failed").select("record.*", "failed")


@query("select * from orders order by o_orderkey limit 20")
def preview_all_columns(spark, folder):
    return preview(read_table(spark, folder, "orders").orderBy("o_orderkey"))
