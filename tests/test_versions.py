"""Versioned tables, and the market jobs that run again over what is new."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from lakework.layers import Lake
from lakework.plans import flights, market, universe
from lakework.sinks import versions
from lakework.sinks.display import nested_schema_rows
from lakework.operators.profile import describe
from lakework.sources.responses import ENVELOPE
from lakework.streaming import market as streams


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n long")


def held(spark, path):
    return sorted(r["n"] for r in versions.read_current(spark, path).collect())


def test_a_write_that_stops_half_way_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    assert versions.current(spark, path) is None
    versions.replace(numbers(spark, 1, 2), path)
    reader = versions.read_current(spark, path)
    bad = spark.range(4).select((F.col("id") / F.when(F.col("id") < 3, F.lit(1)).otherwise(
        F.raise_error(F.lit("lost")).cast("int"))).cast("long").alias("n"))
    with pytest.raises(Exception, match="lost"):
        versions.replace(bad, path)
    assert held(spark, path) == [1, 2]
    # Killed behind the part, before its manifest: a folder without a finished file.
    versions.write_part(numbers(spark, 9), path)
    os.makedirs(f"{path}/manifests/000000000001-x/_temporary/0")
    assert held(spark, path) == [1, 2]
    with pytest.raises(ValueError):
        versions.replace(numbers(spark), path)
    assert versions.replace(numbers(spark, 3), path) == 1
    assert held(spark, path) == [3]
    # Who began to read before still can.
    assert sorted(r["n"] for r in reader.collect()) == [1, 2]


def test_added_parts_are_merged_as_they_grow(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(9):
        versions.add(spark, path, versions.write_part(numbers(spark, i, i + 100), path), batch=i)
        table = versions.current(spark, path)
        assert len(table["parts"]) <= 4 and table["batch"] == i
        assert [p["rows"] for p in table["parts"]] == sorted((p["rows"] for p in table["parts"]), reverse=True)
    assert held(spark, path) == sorted([*range(9), *range(100, 109)])
    versions.add(spark, path, versions.write_part(numbers(spark), path), batch=9)
    assert versions.current(spark, path)["batch"] == 9 and len(held(spark, path)) == 18


def test_expire_removes_what_no_reader_needs(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(3):
        versions.replace(numbers(spark, i), path)
    assert versions.expire(spark, path) == 0  # all are young
    assert versions.expire(spark, path, datetime.timedelta(seconds=-60)) == 2
    assert held(spark, path) == [2] and len(os.listdir(f"{path}/parts")) == 1
    assert versions.expire(spark, str(tmp_path / "none")) == 0


def test_columns_named_like_the_folders_of_parts(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, 2, "x")], "part long, bucket long, k string")
    versions.replace(rows, path, by="k")
    versions.add(spark, path, versions.write_part(rows, path, "k"), "k", keys=["k"])
    assert versions.read_current(spark, path, ["k"]).select("part", "bucket", "k").collect() == [(1, 2, "x")] * 2


def test_times_as_microseconds_and_back(spark):
    time = datetime.datetime(1969, 12, 31, 23, 59, 59, 999_999)
    row = spark.createDataFrame([(time, time)], "a timestamp_ntz, b timestamp")
    assert row.select(versions.micros(row, "a")).first()[0] == -1
    for name in ("a", "b"):
        value = row.select(versions.micros(row, name)).first()[0]
        assert row.where(F.col(name) == versions.time_literal(row, name, value)).count() == 1


def calls(spark, *rows):
    return spark.createDataFrame([
        (e, "p", "u", 200, json.dumps({"result": {"price": {"last": price}}}),
         datetime.datetime(2024, 1, 1, 0, minute)) for e, price, minute in rows], ENVELOPE)


def prices(gold):
    return sorted(tuple(r) for r in gold.select("exchange_name", "result_price_last").collect())


@pytest.fixture
def read(monkeypatch):
    """The raw files that each run reads."""
    seen = []
    plain = market.read_raw
    monkeypatch.setattr(
        market, "read_raw", lambda spark, paths, *a, **k: seen.append(paths) or plain(spark, paths, *a, **k))
    return seen


def test_a_run_reads_what_landed_since_the_last(spark, tmp_path, read):
    lake = Lake(str(tmp_path))
    raw = lake.raw("exchanges")
    market.land(calls(spark, ("a", 1.0, 1), ("b", 2.0, 1)), raw, datetime.datetime(2024, 1, 1, 0, 1))
    assert prices(market.run(spark, lake)) == [("a", 1.0), ("b", 2.0)]
    before = versions.current(spark, lake.gold("exchanges"))
    assert prices(market.run(spark, lake)) == [("a", 1.0), ("b", 2.0)]
    assert versions.current(spark, lake.gold("exchanges")) == before and len(read) == 1
    # A later round, with one document that landed before.
    market.land(calls(spark, ("a", 3.0, 2), ("b", 2.0, 1)), raw, datetime.datetime(2024, 1, 1, 0, 2))
    assert prices(market.run(spark, lake)) == [("a", 1.0), ("a", 3.0), ("b", 2.0)]
    assert len(read) == 2 and all("00-02-00" in p for p in read[1])
    silver = market.read_silver(spark, lake.silver("exchanges"))
    assert silver.count() == 3
    # Nothing but repeats: gold stays as it is.
    market.land(calls(spark, ("a", 3.0, 2)), raw, datetime.datetime(2024, 1, 1, 0, 3))
    before = versions.current(spark, lake.gold("exchanges"))
    market.run(spark, lake)
    assert versions.current(spark, lake.gold("exchanges")) == before


@pytest.mark.parametrize("killed", ["silver", "gold", "exchanges-files"])
def test_a_run_that_was_killed_may_be_repeated(spark, tmp_path, monkeypatch, killed):
    lake = Lake(str(tmp_path))
    raw = lake.raw("exchanges")
    market.land(calls(spark, ("a", 1.0, 1)), raw, datetime.datetime(2024, 1, 1, 0, 1))
    market.run(spark, lake)
    market.land(calls(spark, ("a", 2.0, 2)), raw, datetime.datetime(2024, 1, 1, 0, 2))
    plain = versions.publish

    def publish(spark, path, *rest, **named):
        if path.endswith({"silver": "silver/exchanges", "gold": "gold/exchanges"}.get(killed, killed)):
            raise RuntimeError("killed")
        return plain(spark, path, *rest, **named)

    monkeypatch.setattr(versions, "publish", publish)
    with pytest.raises(RuntimeError):
        market.run(spark, lake)
    monkeypatch.setattr(versions, "publish", plain)
    assert prices(market.run(spark, lake)) == [("a", 1.0), ("a", 2.0)]
    assert market.read_silver(spark, lake.silver("exchanges")).count() == 2


def test_landing_parses_a_body_once_and_counts_in_the_pass_that_writes(spark, tmp_path, plan):
    body = json.dumps({"result": {"price": {"last": 1.0}}})
    rows = [("a", "p", "u", status, text, datetime.datetime(2024, 1, 1)) for status, text in (
        (200, body), (200, body), (500, body), (None, body), (200, "<html>"), (200, None),
        (200, body.replace("1.0", "1.0, \"high\": \"x\"")))]
    responses = spark.createDataFrame(rows, ENVELOPE)
    counted = {"calls": 7, "landed": 3, "status": 2, "unreadable": 2, "misfit": 1}
    assert market.land(responses, str(tmp_path / "raw"), rejects_path=str(tmp_path / "bad")) == counted
    assert spark.read.json(str(tmp_path / "raw")).count() == 3
    assert spark.read.json(str(tmp_path / "bad")).count() == 5
    assert plan(market.rejects(responses), "extended").split("== Physical Plan ==")[1].count("from_json") == 1
    none = market.land(responses.where("1 = 0"), str(tmp_path / "none"), rejects_path=str(tmp_path / "bad"))
    assert set(none.values()) == {0}


def test_latest_is_read_from_few_sets(spark, tmp_path):
    landing, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for i in range(8):
        spark.createDataFrame([("hot", i, i), (f"k{i}", i, i)], "k string, t long, v long").write.mode(
            "append").parquet(landing)
        stream = streams.read_stream(spark, landing, "k string, t long, v long", fmt="parquet")
        streams.start_latest(stream, ["k"], ["t"], out, check).awaitTermination()
        assert len(versions.current(spark, out)["parts"]) <= 4
    rows = {r["k"]: r["v"] for r in streams.read_latest(spark, out, ["k"]).collect()}
    assert rows == {"hot": 7, **{f"k{i}": i for i in range(8)}}
    # The key that every batch changes is held once in the merged set.
    assert versions.read_current(spark, out).where("k = 'hot'").count() < 4


def test_gold_rewrites_only_the_buckets_of_a_batch(spark, tmp_path, monkeypatch):
    sinks = {}
    monkeypatch.setattr(streams, "start", lambda stream, sink, checkpoint, **how: sinks.setdefault("sink", sink))
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    streams.start_layers(None, lambda f: f, ["k"], ["t"], silver, gold, "", buckets=8)
    schema = "k string, t long, v long"

    def parts():
        return {p["bucket"]: p["name"] for p in versions.current(spark, gold)["parts"]}

    sinks["sink"](spark.createDataFrame([*[(f"k{i}", 1, i) for i in range(50)], (None, 1, 1)], schema), 0)
    before = parts()
    assert len(before) > 4
    batch = spark.createDataFrame([("k3", 2, 99), ("k3", 0, 7), ("k4", 3, None)], schema)
    sinks["sink"](batch, 1)
    changed = {b for b, name in parts().items() if before[b] != name}
    assert 1 <= len(changed) <= 2 and set(parts()) == set(before)
    rows = {r["k"]: (r["t"], r["v"]) for r in streams.read_gold(spark, gold).collect()}
    assert rows["k3"] == (2, 99) and rows["k4"] == (3, 4) and rows["k5"] == (1, 5) and len(rows) == 50
    now = parts()
    sinks["sink"](batch, 1)  # run again after it was published
    assert parts() == now
    sinks["sink"](spark.createDataFrame([], schema), 2)
    assert parts() == now and versions.current(spark, gold)["batch"] == 2


def test_flight_gold_is_replaced_in_one_step(spark, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    for origins in (["007", "JFK"], ["007"]):
        rows = spark.createDataFrame([(o, 2018, 1.5) for o in origins], "ORIGIN string, year int, DEP_DELAY double")
        rows.write.mode("overwrite").parquet(silver)
        flights.publish_gold(spark, silver, gold)
    assert flights.per_origin(spark, gold).collect() == [("007", 1)]
    report = {(r["col"], r["stat"]): r["number"] for r in flights.origin_report(spark, gold, "007", ["year"]).collect()}
    assert report["DEP_DELAY", "mean"] == 1.5 and report["ORIGIN", "longest"] == 3 and ("*", "approx_count") in report


def test_describe_every_type(spark):
    df = spark.createDataFrame(
        [(True, "b", datetime.date(2024, 1, 2), [1]), (False, None, None, None), (None, "abc", None, None)],
        "flag boolean, `a.b` string, day date, list array<int>")
    rows = {(r["col"], r["stat"]): (r["number"], r["text"], r["time"]) for r in describe(df).collect()}
    assert rows["flag", "mean"][0] == 0.5 and rows["flag", "count"][0] == 2
    assert rows["a.b", "min"][1] == "abc" and rows["a.b", "longest"][0] == 3
    assert rows["day", "max"][2] == datetime.datetime(2024, 1, 2) and rows["list", "count"][0] == 1
    assert ("list", "min") not in rows and describe(df.select()).collect() == []


def test_nested_schema(spark):
    df = spark.createDataFrame([], "a int, b struct<c: array<struct<d: string>>, e: map<string, array<long>>>")
    assert [(r["path"], r["type"], r["depth"]) for r in nested_schema_rows(df).collect()] == [
        ("a", "int", 0), ("b", "struct", 0), ("b.c", "array", 1), ("b.c[]", "struct", 2), ("b.c[].d", "string", 3),
        ("b.e", "map", 1), ("b.e{key}", "string", 2), ("b.e{value}", "array", 2), ("b.e{value}[]", "bigint", 3)]


def test_only_kept_pairs_details_are_parsed(spark, plan):
    listing = json.dumps({"result": [{"symbol": s, "base": {"symbol": "btc", "fiat": False}, "quote": {
        "symbol": "usd", "fiat": True}} for s in ("btcusd", "btcxyz")]})
    detail = lambda pair, *names: json.dumps({"result": {
        "symbol": pair, "markets": [{"exchange": n} for n in names]}})
    listings = spark.createDataFrame([(200, listing), (500, "no")], "status_code int, body string")
    details = spark.createDataFrame([
        ("btcusd", 200, detail("btcusd", "x", "y")), ("btcusd", 200, detail("btcusd", "x")),
        ("btcxyz", 200, detail("btcxyz", "z")), ("btcusd", 404, "no")], "pair string, status_code int, body string")
    rows = sorted(universe.polling_calls(listings, details).collect())
    assert [(r["pair"], r["exchange"], r["calls"]) for r in rows] == [("btcusd", "x", 2), ("btcusd", "y", 2)]
    assert rows[0]["url"].endswith("/markets/x/btcusd/summary") and rows[0]["cost_per_round"] == 0.004
    text = plan(universe.polling_calls(listings, details), "simple")
    lines = text.splitlines()
    parse = next(i for i, line in enumerate(lines) if "markets:array" in line or "markets" in line and "from_json" in line)
    assert any("LeftSemi" in line for line in lines[parse:])
