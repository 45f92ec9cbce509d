import datetime
import math

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakework.functions.budget import call_budget
from lakework.functions.columns import (
    drop_prefix, epoch_to_timestamp, epoch_to_utc_ntz, snapshot_name, to_double, with_constants,
)
from lakework.functions.dictionary import last_wins, lookup, to_dictionary
from lakework.operators.profile import hashed_count, profile, row_count, sampled_count
from lakework.operators.relational import (
    count_and_mean, dated_values, enrich, funnel, joined_count_and_mean, last_per_key, members,
    merge_newest, top, union_by_name,
)


def at(second):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=second)


def test_bad_numbers_become_null(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), ("",), (None,)], "x string")
    assert [r.x for r in df.withColumn("x", to_double("x")).collect()] == [1.5, None, None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_epochs_are_exact_in_every_zone(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    df = spark.createDataFrame([("1699160400",), ("1699164000",), ("1699167600",), ("x",), (None,)], "e string")
    out = df.select(F.unix_seconds(epoch_to_timestamp("e")).alias("s"), epoch_to_utc_ntz("e").alias("w"))
    rows = out.collect()
    assert [r.s for r in rows] == [1699160400, 1699164000, 1699167600, None, None]
    assert rows[1].w == datetime.datetime(2023, 11, 5, 6, 0) and rows[3].w is None


def test_drops_and_constants(spark):
    df = spark.createDataFrame([(1, 2, 3)], "allowance int, allowance_note int, kept int")
    assert df.drop("allowance", "nothing").columns == ["allowance_note", "kept"]
    assert drop_prefix(df, "allowance").columns == ["kept"]
    assert with_constants(df, source="m").first().source == "m"


def test_snapshot_name(spark):
    df = spark.createDataFrame([("kraken", at(0))], "k string, t timestamp_ntz")
    assert df.select(snapshot_name("k", "t")).first()[0] == "kraken_2024-01-01_00-00-00"


def test_enrich_keeps_fact_columns_and_string_keys(spark):
    fact = spark.createDataFrame([("1", 5.0), ("01", 6.0), (None, 7.0)], "movieId string, rating double")
    dim = spark.createDataFrame([("1", "A"), (None, "N")], "movieId string, title string")
    out = enrich(fact, dim, "movieId", ["title"])
    assert out.columns == ["movieId", "rating", "title"] and out.collect() == [("1", 5.0, "A")]


def test_hot_join_key_is_split(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20000b")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000b")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    fact = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    dim = spark.range(1000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"))
    joined = enrich(fact, dim, "k", ["name"])
    assert joined.groupBy().count().first()[0] == 60_000
    joined.write.format("noop").mode("overwrite").save()
    counted = joined.select("payload", "name")
    counted.collect()
    assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()


ROWS = st.lists(
    st.tuples(
        st.sampled_from([None, 1, 2, 3, 4]),
        st.one_of(st.none(), st.floats(-5, 5)),
        st.one_of(st.none(), st.integers(0, 9)),
    ),
    max_size=30,
)


@given(ROWS)
@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_counting_before_the_join_changes_nothing(spark, rows):
    fact = spark.createDataFrame(rows, "k int, x double, t int")
    # Two ids share a title, one id appears twice, one has no title.
    dim = spark.createDataFrame(
        [(1, "A"), (2, "A"), (3, "B"), (3, "B2"), (4, None), (None, "N")], "k int, title string"
    )
    fast = joined_count_and_mean(fact, dim, "k", "title", "t", "x")
    plain = count_and_mean(enrich(fact, dim, "k", ["title"]), "title", "t", "x")

    def result(df):
        return {r.title: (r.qty, r["mean"]) for r in df.collect()}

    got, expected = result(fast), result(plain)
    assert got.keys() == expected.keys()
    for title, (qty, mean) in expected.items():
        assert got[title][0] == qty
        assert (mean is None and got[title][1] is None) or math.isclose(got[title][1], mean, abs_tol=1e-9)


def test_top_breaks_ties_by_name(spark, plan):
    df = spark.createDataFrame([("d", 1), ("c", 1), ("b", 1), ("a", 5)], "t string, n int")
    assert top(df, 3, "n", "t").collect() == [("a", 5), ("b", 1), ("c", 1)]
    assert "TakeOrderedAndProject" in plan(top(df, 3, "n", "t"))


def test_last_is_per_column_and_skips_nulls(spark):
    df = spark.createDataFrame(
        [("a", at(1), 1.0, "x"), ("a", at(2), None, "y"), ("b", at(1), None, None), (None, at(9), 1.0, "z")],
        "k string, datetime timestamp_ntz, v double, s string",
    )
    assert last_per_key(df, "k", "datetime").collect() == [
        ("a", at(2), 1.0, "y"), ("b", at(1), None, None)
    ]


def test_last_agrees_with_pandas(spark):
    rows = [(f"k{i % 5}", i, float(i) if i % 3 else None, str(i) if i % 4 else None) for i in range(60)]
    pdf = pd.DataFrame(rows, columns=["k", "t", "v", "s"])
    expected = pdf.groupby("k").last().reset_index()
    df = spark.createDataFrame(rows, "k string, t int, v double, s string").repartition(7)
    assert [tuple(r) for r in last_per_key(df, ["k"], "t").collect()] == [
        tuple(r) for r in expected.itertuples(index=False)
    ]


def test_last_breaks_ties_by_later_columns_and_ranks_undated_rows_first(spark):
    tied = spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 2, "y")], "k string, t int, id int, s string")
    assert last_per_key(tied, "k", ["t", "id"], ["s"]).first().s == "y"
    undated = spark.createDataFrame([("a", None, "x"), ("b", None, "p"), ("b", 1, "q")], "k string, t int, s string")
    assert last_per_key(undated, "k", "t", ["s"]).collect() == [("a", "x"), ("b", "q")]


def test_last_does_not_depend_on_row_order(spark):
    rows = [("a", 1, "x"), ("a", 1, "z"), ("a", 1, "y")]
    for n in (1, 3):
        df = spark.createDataFrame(rows[::-1], "k string, t int, s string").repartition(n)
        assert last_per_key(df, "k", "t", ["s"]).collect() == [("a", "z")]


def test_last_combines_before_the_shuffle(spark, plan):
    df = spark.createDataFrame([(1, 1, 1.0)], "k int, t int, v double")
    text = plan(last_per_key(df, "k", "t", sort=False))
    assert "partial_max" in text and text.count("Exchange (") == 1


def test_last_of_dotted_columns(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, None)], "k string, t int, `p.last` double")
    assert last_per_key(df, "k", "t").first().asDict() == {"k": "a", "t": 2, "p.last": 2.0}


SNAPSHOTS = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 5)),
        st.one_of(st.none(), st.integers(0, 9)), st.one_of(st.none(), st.sampled_from("xyz")),
    ),
    min_size=1, max_size=12,
)


@given(SNAPSHOTS, st.integers(1, 4))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_merging_in_steps_equals_one_pass(spark, rows, step):
    schema = "k string, t int, v int, s string"
    gold = None
    for start in range(0, len(rows), step):
        batch = dated_values(spark.createDataFrame(rows[start:start + step], schema), ["k"], ["t"])
        gold = merge_newest([batch] if gold is None else [batch, gold], ["k"])
        gold = spark.createDataFrame(gold.collect(), gold.schema)
    expected = last_per_key(spark.createDataFrame(rows, schema), "k", "t")
    assert gold.drop("as_of").orderBy("k").collect() == expected.collect()


def test_union_by_name_counts_and_fills(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2), ("y", 2)], "b string, k int")
    out = union_by_name([a, b, a])
    assert out.columns == ["k", "a", "b"] and out.count() == 4
    assert sorted(out.collect(), key=str)[-1] == (2, None, "y")


def test_members_by_list_and_by_frame(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "x string")
    wanted = spark.createDataFrame([("a",), ("a",), (None,)], "w string")
    assert members(df, "x", ["a", "q"]).count() == 2
    assert members(df, "x", wanted).collect() == [("a",), ("a",)]


def test_funnel_is_one_pass(spark, plan):
    out = funnel(spark.range(100), even=F.col("id") % 2 == 0, small=F.col("id") < 10)
    assert out.first() == (100, 50, 10)
    assert plan(out).count("Range (") <= 2


def test_dictionary_and_last_wins(spark):
    rows = spark.createDataFrame(
        [("p", "b", 1), ("p", "a", 2), ("p", "b", 3), (None, "z", 1), ("q", None, 5), ("q", "x", 4)],
        "k string, v string, t int",
    )
    lists = {r.k: r.list for r in to_dictionary(rows, "k", "v", "list").collect()}
    assert lists == {"p": ["a", "b"], "q": ["x"]}
    assert sorted(last_wins(rows, "k", "v", "t").collect(), key=str) == [("p", "b"), ("q", None)]


def test_a_long_list_is_spread_over_parts(spark):
    rows = spark.range(3000).selectExpr("'hot' as k", "cast(id % 1000 as string) as v")
    lists = to_dictionary(rows, "k", "v", "list", parts=8).collect()
    assert len(lists) == 8 and max(len(r.list) for r in lists) < 200
    assert sorted(v for r in lists for v in r.list) == sorted(str(i) for i in range(1000))


def test_map_lookup_of_a_missing_key(spark):
    df = spark.sql("select map('a', array(1)) as m")
    assert df.select(lookup("m", "a"), lookup("m", "z")).first() == ([1], None)


def test_budget_values(spark):
    df = spark.createDataFrame([(5,), (82,), (0,)], "calls int")
    rows = [tuple(r) for r in call_budget(df).collect()]
    assert rows[0][1:3] == (0.01, 1000.0) and round(rows[0][3], 1) == 41.7
    assert round(rows[1][1], 3) == 0.164 and [round(x, 1) for x in rows[1][2:]] == [61.0, 2.5]
    assert rows[2] == (0, 0.0, None, None)


def test_profile_agrees_with_pandas(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.5, None, 4.0], "b": [1, 2, 3, 4], "s": list("wxyz")})
    df = spark.createDataFrame(
        [(1.0, 1, "w"), (2.5, 2, "x"), (None, 3, "y"), (4.0, 4, "z")], "a double, b int, s string"
    )
    got = {(r.col, r.stat): r.value for r in profile(df).collect()}
    stats = pdf[["a", "b"]].describe()
    assert len(got) == 10
    for (column, stat), value in got.items():
        assert math.isclose(value, stats[column][{"stddev": "std"}.get(stat, stat)])


def test_counts(spark):
    df = spark.range(50_000)
    assert row_count(df).first().n == 50_000
    assert row_count(spark.range(1, 8)).first().n == 7
    # Five standard deviations of a 1 % Bernoulli sample.
    spread = 5 * math.sqrt(50_000 * 0.01 * 0.99) * 100
    first = sampled_count(df, seed=3).first()[0]
    assert abs(first - 50_000) < spread and first == sampled_count(df, seed=3).first()[0]
    exact = hashed_count(df, "id").first()[0]
    assert abs(exact - 50_000) < spread
    assert exact == hashed_count(df.repartition(13), "id").first()[0]


def test_profile_of_dotted_names_and_of_none(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "`a.b` double")
    assert {(r.col, r.stat): r.value for r in profile(df).collect()}["a.b", "mean"] == 2.0
    assert profile(df.select(F.lit("x").alias("t"))).collect() == []


def test_hashed_count_of_all_rows_is_exact(spark):
    assert hashed_count(spark.range(10_000), "id", one_in=1).first()[0] == 10_000


def test_fractional_epochs_keep_their_time(spark):
    df = spark.createDataFrame([("1699164000.0",), ("1699164000",), ("x",), (None,)], "t string")
    rows = df.select(epoch_to_utc_ntz("t").alias("n"), epoch_to_timestamp("t").isNull().alias("m")).collect()
    at = datetime.datetime(2023, 11, 5, 6)
    assert [(r.n, r.m) for r in rows] == [(at, False), (at, False), (None, True), (None, True)]
