"""What Spark will run, read off the physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from lakework.catalogue import QUERIES, nested, tables
from lakework.catalogue.jobs import market_responses
from lakework.plans import market
from lakework.sources.literal import decode_literals

FOLDER = "/root/testdata/sf0.001"
LAZY = [n for n, q in QUERIES.items() if q.__module__ in (tables.__name__, nested.__name__)]
PYTHON = re.compile(r"\b(ArrowEvalPython|BatchEvalPython|MapInPandas|MapInArrow|FlatMapGroupsInPandas)")
ALL_PAIRS = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", LAZY)
def test_queries_stay_in_the_jvm_and_pair_by_key(spark, plan, name):
    text = plan(QUERIES[name](spark, FOLDER), "simple")
    assert not PYTHON.search(text) and not ALL_PAIRS.search(text)


def test_flagship_reads_three_columns_and_takes_ten_rows(spark, plan):
    text = plan(QUERIES["top10_by_count"](spark, FOLDER))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in text
    assert "PushedFilters: [IsNotNull(l_partkey)]" in text
    assert "TakeOrderedAndProject" in text


def test_flagship_shuffles_each_table_once(spark, conf, plan):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(QUERIES["top10_by_count"](spark, FOLDER), "simple")
    # Facts by key, names by key, titles: the sum before the join costs no shuffle of its own.
    assert text.count("Exchange hashpartitioning") == 3


def test_membership_list_needs_no_shuffle_of_its_own(spark, conf, plan):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(QUERIES["filter_membership_list"](spark, FOLDER), "simple")
    assert text.count("Exchange hashpartitioning") == 2


def test_row_count_reads_no_columns(spark, plan):
    assert "ReadSchema: struct<>" in plan(QUERIES["row_count"](spark, FOLDER))


def test_nested_predicates_reach_the_scan(spark, plan):
    assert "PushedFilters: [Or(" in plan(QUERIES["filter_nested_or"](spark, FOLDER))


@pytest.mark.parametrize("name", ["pair_universe", "wanted_pairs", "status_gate_null", "flatten_map"])
def test_bodies_are_parsed_once(spark, conf, plan, name):
    conf("spark.sql.maxToStringFields", "1000")
    assert plan(QUERIES[name](spark, FOLDER), "simple").count("from_json") == 1


def test_a_filter_after_decoding_does_not_repeat_it(spark, conf, plan):
    conf("spark.sql.maxToStringFields", "1000")
    text = spark.read.parquet(f"{FOLDER}/documents.parquet").select("text")
    decoded = decode_literals(text, "text", "a string, b boolean").where("not decode_failed")
    shown = plan(decoded.select("record.a", "record.b"), "simple")
    assert shown.count("regexp_extract_all") == 1 and shown.count("ArrowEvalPython") == 1


def test_silver_is_one_projection(spark, plan):
    documents = market_responses(spark, FOLDER).select(
        F.from_json("body", f"result {market.RESULT}, allowance {market.ALLOWANCE}").alias("d"),
        "exchange_name", "pair",
    ).select("d.*", "exchange_name", "pair", F.current_timestamp().alias("datetime"))
    text = plan(market.to_silver(documents), "simple")
    assert "Exchange" not in text and "Generate" not in text and text.count("from_json") == 1
