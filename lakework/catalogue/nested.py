"""Flattening of structs, arrays and maps."""

from pyspark.sql import functions as F

from lakework.catalogue.registry import query
from lakework.operators.flatten import flatten, map_rows, normalize
from lakework.operators.relational import enrich
from lakework.sources.json import parse_payload
from lakework.sources.tables import read_table


def _located_customers(spark, folder):
    nations = enrich(
        read_table(spark, folder, "nation"), read_table(spark, folder, "region"),
        key="n_regionkey", dimension_key="r_regionkey", take=["r_name"],
    )
    return enrich(
        read_table(spark, folder, "customer"), nations,
        key="c_nationkey", dimension_key="n_nationkey", take=["n_name", "r_name"],
    )


def _nested_customers(spark, folder):
    return _located_customers(spark, folder).select(
        F.struct(
            F.col("c_name").alias("name"),
            F.struct(
                F.col("n_name").alias("name"), F.struct(F.col("r_name").alias("name")).alias("region")
            ).alias("nation"),
        ).alias("customer"),
        F.col("c_custkey").alias("id"),
        F.array("c_mktsegment", "n_name").alias("tags"),
    )


@query("""
    select c_custkey as id, c_name as customer_name, n_name as customer_nation_name,
           r_name as customer_nation_region_name
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""")
def flatten_struct(spark, folder):
    return flatten(_nested_customers(spark, folder).drop("tags"))


@query("""
    select vec_id, label::bigint as label, unnest(embedding)::double as embedding from embeddings
""")
def flatten_array(spark, folder):
    rows = flatten(read_table(spark, folder, "embeddings"))
    return rows.select(
        "vec_id", F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("double").alias("embedding"),
    )


@query("""
    select event_id, json_extract(props, '$.k')::bigint as props_k from events
""")
def flatten_map(spark, folder):
    events = read_table(spark, folder, "events").select("event_id", "props")
    # The key is declared, so no job looks for keys; flatten_mixed has them looked for.
    return flatten(
        parse_payload(events, "props", "map<string,bigint>"), map_keys={"props": ["k"]}, other_keys=None)


@query("""
    select c_custkey as id, to_json([c_mktsegment, n_name])::varchar as tags,
           c_name as "customer.name", n_name as "customer.nation.name",
           r_name as "customer.nation.region.name"
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""")
def normalize_dotted(spark, folder):
    return normalize(_nested_customers(spark, folder))


@query("""
    select c_custkey as id, unnest([c_mktsegment, n_name]) as tags,
           unnest([c_nationkey, c_custkey])::bigint as codes, c_name as customer_name,
           n_name as customer_nation_name, r_name as customer_nation_region_name,
           c_acctbal as figures_balance, c_nationkey::double as figures_nation
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""")
def flatten_mixed(spark, folder):
    """A struct, two arrays walked in step and a map whose keys are looked for."""
    figures = F.create_map(
        F.lit("balance"), F.col("c_acctbal").cast("double"), F.lit("nation"), F.col("c_nationkey").cast("double"))
    keyed = read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), figures.alias("figures"),
        F.array(F.col("c_nationkey").cast("bigint"), F.col("c_custkey").cast("bigint")).alias("codes"))
    return flatten(_nested_customers(spark, folder).join(keyed, "id"), zip_arrays=True)


@query("""
    select event_id, k as key, json_extract(props, '$.' || k)::bigint as value
    from (select event_id, props, unnest(json_keys(props)) as k from events)
""")
def flatten_map_rows(spark, folder):
    events = read_table(spark, folder, "events").select("event_id", "props")
    return map_rows(parse_payload(events, "props", "map<string,bigint>"), ["event_id"], "props")
