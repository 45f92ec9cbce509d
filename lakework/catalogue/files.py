"""Round trips through file formats, in a folder all executors share."""

from pyspark.sql import functions as F

from lakework.catalogue.registry import query
from lakework.functions.dictionary import dictionary_sizes
from lakework.layers import Lake
from lakework.operators.relational import joined_count_and_mean
from lakework.scratch import scratch_path
from lakework.sinks.files import land_json, write_csv, write_partitioned, write_report
from lakework.sources.csv import read_csv, read_csv_by_name
from lakework.sources.files import list_files, with_provenance
from lakework.sources.json import NTZ_FORMAT, parse_payload, read_json
from lakework.sources.literal import decode_literals
from lakework.sources.tables import read_partition, read_table


def _orders_csv(spark, folder, header):
    path = scratch_path(spark, "orders-csv")
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"
    )
    write_csv(orders, path, header=header)
    return path


@query("""
    select o_orderkey::varchar as o_orderkey, o_custkey::varchar as o_custkey,
           o_totalprice::varchar as o_totalprice, o_orderstatus, o_orderpriority
    from orders
""")
def csv_all_strings(spark, folder):
    return read_csv(spark, _orders_csv(spark, folder, header=True))


@query("select doc_id::varchar as doc_id, text, lang, source from documents")
def csv_text(spark, folder):
    """Texts with quotes, commas, blanks at their ends and line breaks, through CSV and back."""
    path = scratch_path(spark, "documents-csv")
    documents = read_table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    write_csv(documents, path, header=True)
    return read_csv(spark, path)


@query("select o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority from orders")
def csv_inferred(spark, folder):
    orders = read_csv(spark, _orders_csv(spark, folder, header=True), infer=True)
    return orders.withColumns({
        "o_orderkey": F.col("o_orderkey").cast("bigint"),
        "o_custkey": F.col("o_custkey").cast("bigint"),
    })


@query("""
    select o_orderkey::varchar as _c0, o_custkey::varchar as _c1, o_totalprice::varchar as _c2,
           o_orderstatus as _c3, o_orderpriority as _c4
    from orders
""")
def csv_no_header(spark, folder):
    return read_csv(spark, _orders_csv(spark, folder, header=False), header=False)


@query("""
    select c_custkey::varchar as key, c_name as name, c_acctbal::varchar as balance from customer
    union all by name
    select s_suppkey::varchar as key, s_acctbal::varchar as balance from supplier
""")
def csv_union_headers(spark, folder):
    path = scratch_path(spark, "parties-csv")
    customers = read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )
    suppliers = read_table(spark, folder, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key")
    )
    write_csv(customers, f"{path}/customers", header=True)
    write_csv(suppliers, f"{path}/suppliers", header=True)
    # Each writer's folder holds one header, so none has to be looked for.
    return read_csv_by_name(spark, path, groups=[f"{path}/customers", f"{path}/suppliers"])


@query("select doc_id, lang, source, n_chars, text from documents")
def json_roundtrip(spark, folder):
    path = scratch_path(spark, "documents-json")
    documents = read_table(spark, folder, "documents")
    documents.write.json(path)
    return read_json(
        spark, path, "doc_id bigint, lang string, source string, n_chars bigint, text string"
    )


@query("""
    select event_id, user_id, ts, json_extract(props, '$.k')::bigint as k from events
""")
def json_payload(spark, folder):
    events = read_table(spark, folder, "events").select("event_id", "user_id", "ts", "props")
    line = events.select(
        F.to_json(F.struct("*"), {"timestampNTZFormat": NTZ_FORMAT}).alias("value")
    )
    outer = parse_payload(
        line, "value", "event_id bigint, user_id bigint, ts timestamp_ntz, props string",
        timestampNTZFormat=NTZ_FORMAT,
    ).select("value.*")
    return parse_payload(outer, "props", "k bigint").select(
        "event_id", "user_id", "ts", F.col("props.k").alias("k")
    )


def write_dictionaries(rows, path, key, value, rows_per_document=50_000):
    """Rows as pretty-printed key -> list documents, one per file.

    A document takes a run of input rows, so neither a hot key nor the table size
    makes one large. The lists of one key are spread over many documents.
    """
    numbered = rows.select(key, value, F.monotonically_increasing_id().alias("_row"))
    document = F.floor(F.col("_row") / rows_per_document).alias("document")
    lists = numbered.groupBy(document, key).agg(F.collect_list(value).alias("_list"))
    documents = lists.groupBy("document").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(key).cast("string"), "_list"))).alias("entries")
    )
    text = documents.select(F.to_json(F.struct("document", "entries"), {"pretty": "true"}).alias("value"))
    text.write.option("maxRecordsPerFile", 1).text(path)


@query("""
    select c_nationkey::varchar as pair, count(*)::bigint as n from customer group by c_nationkey
""")
def json_multiline(spark, folder):
    path = scratch_path(spark, "dictionary-json")
    write_dictionaries(read_table(spark, folder, "customer"), path, "c_nationkey", "c_name")
    documents = read_json(
        spark, path, "document bigint, entries map<string,array<string>>", multiline=True, glob="*.txt"
    )
    return dictionary_sizes(documents, "entries").groupBy("pair").agg(F.sum("n").alias("n"))


def python_string(column):
    """A string as Python writes it in a literal."""
    text = F.col(column)
    for plain, escaped in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return F.concat(F.lit("'"), text, F.lit("'"))


@query("""
    select doc_id, text, lang, n_chars > 500 as long, null::varchar as note, false as failed
    from documents
""")
def literal_text_decode(spark, folder):
    literal = read_table(spark, folder, "documents").select(F.concat(
        F.lit("{'doc_id': "), F.col("doc_id").cast("string"),
        F.lit(", 'text': "), python_string("text"),
        F.lit(", 'lang': "), python_string("lang"),
        F.lit(", 'long': "), F.when(F.col("n_chars") > 500, "True").otherwise("False"),
        F.lit(", 'note': None}"),
    ).alias("value"))
    schema = "doc_id bigint, text string, lang string, long boolean, note string"
    decoded = decode_literals(literal, "value", schema, failed="failed")
    return decoded.select("record.*", "failed")


@query("""
    select * from orders where o_orderstatus = 'F'
""")
def partition_prune(spark, folder):
    path = scratch_path(spark, "orders-by-status")
    write_partitioned(read_table(spark, folder, "orders"), path, "o_orderstatus")
    return read_partition(spark, path, o_orderstatus="F")


@query("select 'events' as source_key, count(*)::bigint as n, 0::bigint as undated from events")
def file_provenance(spark, folder):
    events = with_provenance(read_table(spark, folder, "events"), "parquet")
    return events.groupBy("source_key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("datetime").isNull()).alias("undated")
    )


@query("""
    select p_name as title, count(*)::bigint as qty, round(avg(l_extendedprice), 4) as mean
    from lineitem join part on l_partkey = p_partkey
    group by p_name order by qty desc, title limit 10
""")
def report_csv(spark, folder):
    counted = joined_count_and_mean(
        read_table(spark, folder, "lineitem"),
        read_table(spark, folder, "part").withColumnRenamed("p_name", "title"),
        key="l_partkey", dimension_key="p_partkey", by="title",
        counted="l_orderkey", averaged="l_extendedprice",
    )
    path = scratch_path(spark, "report-csv")
    write_report(counted, path, [F.desc("qty"), F.asc("title")], 10)
    rows = read_csv(spark, path, schema="title string, qty bigint, mean double")
    return rows.withColumn("mean", F.round("mean", 4))


@query("""
    select event_id, ts, user_id, event_type, props,
           case when event_type in ('click', 'error') then value * 2 else value end as value
    from events
""")
def raw_upsert(spark, folder):
    path = Lake(scratch_path(spark, "upsert")).raw("events")
    events = read_table(spark, folder, "events")
    land_json(events, path, "event_type")
    newer = events.where(F.col("event_type").isin("click", "error"))
    land_json(newer.withColumn("value", F.col("value") * 2), path, "event_type")
    return read_json(spark, path, events.schema)


@query("select distinct o_orderstatus, true as named, true as filled from orders")
def listed_files(spark, folder):
    """The files of a table written in folders, by folder."""
    path = scratch_path(spark, "listed-orders")
    write_partitioned(read_table(spark, folder, "orders"), path, "o_orderstatus")
    files = list_files(spark, path, glob="*.parquet")
    status = F.regexp_extract("file_path", "/o_orderstatus=([^/]*)/", 1)
    return files.groupBy(status.alias("o_orderstatus")).agg(
        F.every(F.col("file_name").startswith("part-") & F.col("datetime").isNotNull()).alias("named"),
        F.every(F.col("bytes") > 0).alias("filled"))
