"""Column operators, filters, joins, aggregates and unions."""

from pyspark.sql import functions as F

from lakework.catalogue.registry import epoch_seconds, query
from lakework.functions import budget
from lakework.functions.columns import (
    drop_prefix, epoch_to_timestamp, epoch_to_utc_ntz, to_double, with_constants,
)
from lakework.functions.dictionary import last_wins, to_dictionary
from lakework.operators import profile as profiles
from lakework.operators.relational import (
    count_and_mean, enrich, joined_count_and_mean, last_per_key, members, top, union_by_name,
)
from lakework.plans import universe
from lakework.sinks.display import preview
from lakework.sources.responses import EXCHANGES, SUMMARY_URL, result_rows, with_data, with_url
from lakework.sources.tables import read_table


@query("""
    select p_name, count(l_shipdate)::bigint as qty, round(avg(l_quantity), 6) as avg_quantity
    from lineitem join part on l_partkey = p_partkey
    group by p_name order by qty desc, p_name limit 10
""")
def top10_by_count(spark, folder):
    counted = joined_count_and_mean(
        read_table(spark, folder, "lineitem"), read_table(spark, folder, "part"),
        key="l_partkey", dimension_key="p_partkey", by="p_name",
        counted="l_shipdate", averaged="l_quantity", count_name="qty", mean_name="avg_quantity",
    )
    return top(counted, 10, "qty", "p_name").withColumn("avg_quantity", F.round("avg_quantity", 6))


@query("""
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, c_name
    from orders join customer on o_custkey = c_custkey
""")
def join_qualified_star(spark, folder):
    return enrich(
        read_table(spark, folder, "orders"), read_table(spark, folder, "customer"),
        key="o_custkey", dimension_key="c_custkey", take=["c_name"],
    )


@query("""
    select event_type, count(case when value >= 10 then value end)::bigint as qty,
           round(avg(value), 6) as mean
    from events group by event_type
""")
def group_count_mean(spark, folder):
    events = read_table(spark, folder, "events").withColumn(
        "large", F.when(F.col("value") >= 10, F.col("value"))
    )
    return count_and_mean(events, "event_type", "large", "value").withColumn(
        "mean", F.round("mean", 6)
    )


@query("""
    select event_id, date_trunc('second', ts) as at, floor(epoch(ts))::bigint as epoch, value
    from events
""")
def rename_cast_epoch(spark, folder):
    as_text = read_table(spark, folder, "events").select(
        "event_id",
        F.expr(epoch_seconds("ts")).cast("string").alias("timestamp"),
        F.col("value").cast("string").alias("value"),
    )
    renamed = as_text.withColumnRenamed("timestamp", "timestamp_epoch")
    return renamed.withColumns({
        "value": to_double("value"),
        "at": epoch_to_utc_ntz("timestamp_epoch"),
        "epoch": F.unix_seconds(epoch_to_timestamp("timestamp_epoch")),
    }).drop("timestamp_epoch")


@query("""
    select o_orderkey, try_cast(o_orderpriority as double) as whole,
           try_cast(left(o_orderpriority, 1) as double) as digit
    from orders
""")
def try_cast_text(spark, folder):
    return read_table(spark, folder, "orders").select(
        "o_orderkey",
        to_double("o_orderpriority").alias("whole"),
        to_double(F.substring("o_orderpriority", 1, 1)).alias("digit"),
    )


@query("""
    select c_custkey, c_nationkey::bigint as c_nationkey, c_acctbal from customer
""")
def drop_exact_and_prefix(spark, folder):
    customer = read_table(spark, folder, "customer").drop("c_name", "no_such_column")
    return drop_prefix(customer, "c_m").withColumn("c_nationkey", F.col("c_nationkey").cast("bigint"))


@query("""
    select s_suppkey, 'market' as source, 0.002::double as cost from supplier
""")
def literal_column(spark, folder):
    suppliers = read_table(spark, folder, "supplier").select("s_suppkey")
    return with_constants(suppliers, source="market", cost=0.002)


def _pairs(spark, folder):
    """Customers as trading pairs with a base and a quote side."""
    return read_table(spark, folder, "customer").select(
        F.concat(F.lower("c_mktsegment"), F.col("c_nationkey").cast("string")).alias("symbol"),
        F.struct(
            F.lower("c_mktsegment").alias("symbol"),
            (F.col("c_nationkey") < 5).alias("fiat"),
        ).alias("base"),
        F.struct(
            F.col("c_nationkey").cast("string").alias("symbol"),
            (F.col("c_acctbal") < 0).alias("fiat"),
        ).alias("quote"),
        "c_custkey", "c_acctbal",
    )


@query("""
    select c_custkey, lower(c_mktsegment) || c_nationkey as symbol from customer
    where (c_nationkey < 5 or c_acctbal < 0)
      and (lower(c_mktsegment) = 'building' or c_nationkey::varchar = 'building')
""")
def filter_nested_or(spark, folder):
    pairs = _pairs(spark, folder).where(universe.has_fiat_side())
    return pairs.where(universe.has_symbol("building")).select("c_custkey", "symbol")


@query("""
    with pairs as (
        select lower(c_mktsegment) || c_nationkey as symbol, lower(c_mktsegment) as base,
               c_nationkey < 5 or c_acctbal < 0 as fiat
        from customer)
    select count(*)::bigint as total,
           count(*) filter (fiat)::bigint as fiat,
           count(*) filter (fiat and base = 'building')::bigint as symbol,
           count(*) filter (fiat and symbol in ('building1', 'building2', 'building7'))::bigint
               as wanted
    from pairs
""")
def filter_membership(spark, folder):
    return universe.pair_funnel(
        _pairs(spark, folder), "building", ("building1", "building2", "building7")
    )


@query("""
    select l_orderkey, l_linenumber::bigint as l_linenumber, l_suppkey from lineitem
    where l_suppkey in (select s_suppkey from supplier where s_acctbal < 0)
""")
def filter_membership_list(spark, folder):
    wanted = read_table(spark, folder, "supplier").where("s_acctbal < 0").select("s_suppkey")
    return members(read_table(spark, folder, "lineitem"), "l_suppkey", wanted).select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_suppkey"
    )


def _responses(spark, folder):
    """Events as call responses; an ``error`` event is a failed call."""
    return read_table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
        F.col("props").alias("body"),
    )


@query("""
    select event_id, json_extract(props, '$.k')::bigint as k from events where event_type <> 'error'
""")
def status_gate_drop(spark, folder):
    good = _responses(spark, folder).where(F.col("status_code") == 200)
    return good.select("event_id", F.from_json("body", "k bigint")["k"].alias("k"))


@query("""
    select event_id,
           case when event_type <> 'error' then json_extract(props, '$.k')::bigint end as k
    from events
""")
def status_gate_null(spark, folder):
    kept = with_data(_responses(spark, folder), "k bigint")
    return kept.select("event_id", F.col("data.k").alias("k"))


@query("""
    select user_id, string_agg(event_type, ',' order by event_type) as exchanges,
           count(*)::bigint as n
    from (select distinct user_id, event_type from events) group by user_id
""")
def pair_exchange_dict(spark, folder):
    events = read_table(spark, folder, "events")
    return to_dictionary(events, "user_id", "event_type", "list").select(
        "user_id",
        F.array_join("list", ",").alias("exchanges"),
        F.size("list").cast("bigint").alias("n"),
    )


@query("""
    select user_id, arg_max(event_type, ts) as route from events group by user_id
""")
def map_last_wins(spark, folder):
    events = read_table(spark, folder, "events").withColumnRenamed("event_type", "route")
    return last_wins(events, "user_id", "route", "ts")


@query("""
    select unnest(string_split(p_name, ' ')) as exchange, p_brand as pair, p_partkey,
           'https://api.cryptowat.ch/markets/' || unnest(string_split(p_name, ' ')) || '/'
               || p_brand || '/summary' as url
    from part where p_brand = 'Brand#7'
""")
def key_lookup_explode(spark, folder):
    dictionary = read_table(spark, folder, "part").select(
        F.col("p_brand").alias("pair"), "p_partkey", F.split("p_name", " ").alias("exchanges")
    )
    rows = dictionary.where(F.col("pair") == "Brand#7").select(
        "pair", "p_partkey", F.explode("exchanges").alias("exchange")
    )
    return with_url(rows, SUMMARY_URL, ["exchange", "pair"])


@query("""
    select c_mktsegment, count(*)::bigint as calls,
           round(count(*) * 0.002, 6)::double as cost_per_round,
           round(10 / (count(*) * 0.002::double), 6) as rounds_per_day,
           round(10 / (count(*) * 0.002::double) / 24, 6) as rounds_per_hour
    from customer group by c_mktsegment
""")
def call_budget(spark, folder):
    calls = read_table(spark, folder, "customer").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("calls")
    )
    costs = budget.call_budget(calls)
    return costs.withColumns({
        c: F.round(c, 6) for c in ("cost_per_round", "rounds_per_day", "rounds_per_hour")
    })


@query("""
    select user_id, arg_max(case when value < 100 then value end, ts) as value,
           arg_max(event_type, ts) as event_type, max(ts) as ts
    from events group by user_id
""", name="last_per_key")
def newest_event_values(spark, folder):
    events = read_table(spark, folder, "events").select(
        "user_id", F.when(F.col("value") < 100, F.col("value")).alias("value"), "event_type", "ts"
    )
    return last_per_key(events, "user_id", "ts")


@query("""
    select c_custkey as key, c_name as name, c_acctbal as balance, c_mktsegment as segment,
           null::varchar as supplier_name
    from customer
    union all by name
    select s_suppkey as key, s_acctbal as balance, s_name as supplier_name from supplier
""")
def union_by_name_fill(spark, folder):
    customers = read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    suppliers = read_table(spark, folder, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("supplier_name"),
        F.col("s_suppkey").alias("key"),
    )
    return union_by_name([customers, suppliers])


@query("select distinct event_type from events")
def distinct_keys(spark, folder):
    return read_table(spark, folder, "events").select("event_type").distinct()


@query("select count(*)::bigint as n from lineitem")
def row_count(spark, folder):
    return profiles.row_count(read_table(spark, folder, "lineitem"))


_PROFILED = ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")


@query(" union all ".join(
    f"select '{c}' as col, '{stat}' as stat, round({sql}({c})::double, 4) + 0 as value from lineitem"
    for c in _PROFILED
    for stat, sql in (
        ("count", "count"), ("mean", "avg"), ("stddev", "stddev_samp"), ("min", "min"), ("max", "max"),
    )
))
def profile(spark, folder):
    lineitem = read_table(spark, folder, "lineitem")
    return profiles.profile(lineitem, list(_PROFILED)).withColumn("value", F.round("value", 4))


@query("""
    select 'count' as summary, count(event_type)::varchar as event_type,
           count(user_id)::double as user_id from events
    union all select 'mean', null, round(avg(user_id), 4) from events
    union all select 'stddev', null, round(stddev_samp(user_id), 4) from events
    union all select 'min', min(event_type), min(user_id)::double from events
    union all select 'max', max(event_type), max(user_id)::double from events
""")
def describe_text(spark, folder):
    described = read_table(spark, folder, "events").describe("event_type", "user_id")
    return described.withColumn("user_id", F.round(to_double("user_id"), 4))


@query("""
    select (count(*) filter (
        ('0x' || substr(md5(l_orderkey || '-' || l_linenumber), 1, 8))::bigint < 4294967296 // 100
    ) * 100)::bigint as approx_n
    from lineitem
""")
def approx_count_hash(spark, folder):
    lineitem = read_table(spark, folder, "lineitem")
    return profiles.hashed_count(lineitem, ["l_orderkey", "l_linenumber"])


@query("select count(*)::bigint as n, true as near from lineitem")
def approx_count_sample(spark, folder):
    """The exact count, and whether the sampled one lies within five standard deviations."""
    lineitem, fraction = read_table(spark, folder, "lineitem"), 0.01
    both = profiles.row_count(lineitem).unionByName(
        profiles.sampled_count(lineitem, fraction), allowMissingColumns=True
    ).agg(F.max("n").alias("n"), F.max("approx_n").alias("approx_n"))
    spread = F.sqrt(F.col("n") * (1 - fraction) / fraction)
    return both.select("n", (F.abs(F.col("approx_n") - F.col("n")) <= 5 * spread + 1).alias("near"))


@query("""
    select o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey limit 20
""")
def preview_rows(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return preview(orders.orderBy("o_orderkey"))


@query("""
    with pairs as (
        select c_custkey, lower(c_mktsegment) || c_nationkey as symbol, lower(c_mktsegment) as base,
               c_nationkey::varchar as quote
        from customer
        where c_acctbal <= 9000 and (c_nationkey < 5 or c_acctbal < 0))
    select symbol, base, quote, count(*)::bigint as n from pairs
    where base = 'building' and symbol in ('building1', 'building2', 'building7')
    group by symbol, base, quote
""")
def wanted_pairs(spark, folder):
    responses = _pairs(spark, folder).select(
        F.when(F.col("c_acctbal") > 9000, 500).otherwise(200).alias("status_code"),
        F.to_json(F.struct(F.array(F.struct("symbol", "base", "quote")).alias("result"))).alias("body"),
    )
    wanted = universe.wanted_pairs(responses, "building", ("building1", "building2", "building7"))
    return wanted.groupBy(
        "symbol", F.col("base.symbol").alias("base"), F.col("quote.symbol").alias("quote")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("""
    with calls as (
        select lower(p_brand) as pair, sum(len(string_split(p_name, ' ')))::bigint as calls
        from part where p_size <= 45 group by 1)
    select pair, calls, round(calls * 0.002::double, 6) as cost_per_round,
           round(10 / (calls * 0.002::double), 6) as rounds_per_day,
           round(10 / (calls * 0.002::double) / 24, 6) as rounds_per_hour
    from calls
""")
def pair_universe(spark, folder):
    markets = F.transform(F.split("p_name", " "), lambda w: F.struct(w.alias("exchange")))
    details = read_table(spark, folder, "part").select(
        F.when(F.col("p_size") > 45, 500).otherwise(200).alias("status_code"),
        F.to_json(F.struct(
            F.struct(F.lower("p_brand").alias("symbol"), markets.alias("markets")).alias("result")
        )).alias("body"),
    )
    costs = universe.budget_per_pair(universe.pair_exchanges(details))
    return costs.withColumns({
        c: F.round(c, 6) for c in ("cost_per_round", "rounds_per_day", "rounds_per_hour")
    })


@query("select c_name as symbol, '/x/' || c_custkey as route from customer")
def exchange_routes(spark, folder):
    """Both fields of every element of listing responses, a thousand elements to a response."""
    customers = read_table(spark, folder, "customer").select(
        F.floor(F.col("c_custkey") / 1000).alias("call"),
        F.struct(
            F.col("c_name").alias("symbol"),
            F.concat(F.lit("/x/"), F.col("c_custkey").cast("string")).alias("route")).alias("item"))
    bodies = customers.groupBy("call").agg(F.collect_list("item").alias("result")).select(
        F.lit(200).alias("status_code"), F.to_json(F.struct("result")).alias("body"))
    return result_rows(bodies, EXCHANGES)
