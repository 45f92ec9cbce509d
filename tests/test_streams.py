import datetime
import json
import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lakework.operators.relational import last_per_key
from lakework.plans import market
from lakework.sources.responses import ENVELOPE
from lakework.streaming import market as streams

SCHEMA = "exchange_name string, datetime timestamp_ntz, price double"


def land(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"exchange_name": e, "datetime": f"2024-01-0{d}T00:00:00.000000", "price": p}) for e, d, p in rows]
    (folder / f"{name}.json").write_text("\n".join(lines) + "\n")


def day(d):
    return datetime.datetime(2024, 1, d)


def test_latest_equals_batch_over_several_runs(spark, tmp_path):
    landing, out, checkpoint = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        stream = streams.read_stream(spark, str(landing), SCHEMA, files_per_batch=1)
        streams.start_latest(stream, ["exchange_name"], ["datetime"], out, checkpoint).awaitTermination()
        rows = streams.read_latest(spark, out, ["exchange_name"]).orderBy("exchange_name")
        return rows.select("exchange_name", "datetime", "price").collect()

    land(landing, "a", ("kraken", 1, 10.0), ("bisq", 3, 9.0))
    land(landing, "b", ("kraken", 2, 11.0), ("bisq", 1, 1.0))
    assert run() == [("bisq", day(3), 9.0), ("kraken", day(2), 11.0)]
    assert run() == [("bisq", day(3), 9.0), ("kraken", day(2), 11.0)]
    land(landing, "c", ("bisq", 4, 8.0))
    result = run()
    batch = spark.read.schema(SCHEMA).json(str(landing))
    assert result == [("bisq", day(4), 8.0), ("kraken", day(2), 11.0)]
    assert result == last_per_key(batch, "exchange_name", "datetime").collect()


def test_files_older_than_those_seen_are_read(spark, tmp_path):
    landing, out, checkpoint = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        stream = streams.read_stream(spark, str(landing), SCHEMA)
        streams.start_latest(stream, ["exchange_name"], ["datetime"], out, checkpoint).awaitTermination()
        return sorted(r.exchange_name for r in streams.read_latest(spark, out, ["exchange_name"]).collect())

    land(landing, "a", ("a", 1, 1.0))
    assert run() == ["a"]
    land(landing, "b", ("b", 1, 1.0))
    old = time.time() - 30 * 86_400
    os.utime(landing / "b.json", (old, old))
    land(landing, "c", ("c", 1, 1.0))
    assert run() == ["a", "b", "c"]


def test_a_failed_batch_still_finds_its_snapshot_after_the_next_landing(spark, tmp_path):
    raw, checkpoint = str(tmp_path / "raw"), str(tmp_path / "check")

    def round_of(price, second):
        body = json.dumps({"result": {"price": {"last": price}}})
        calls = spark.createDataFrame(
            [("kraken", "btcusd", "u", 200, body, datetime.datetime(2024, 1, 1, 0, 0, second))], ENVELOPE)
        market.land(calls, raw)

    def start(sink):
        return streams.start(streams.read_stream(spark, raw, market.ROUNDS), sink, checkpoint)

    def fail(frame, batch_id):
        raise ValueError("lost")

    prices = []
    round_of(1.0, 1)
    with pytest.raises(StreamingQueryException):
        start(fail).awaitTermination()
    round_of(2.0, 2)
    start(lambda frame, batch_id: prices.extend(
        r.last for r in frame.select("result.price.last").collect())).awaitTermination()
    assert sorted(prices) == [1.0, 2.0]


def test_history_keeps_each_snapshot_once(spark, tmp_path):
    landing, out, checkpoint = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        stream = streams.read_stream(spark, str(landing), SCHEMA, bytes_per_batch=100)
        streams.start_history(
            stream, ["exchange_name", "datetime"], F.to_date("datetime"), out, checkpoint
        ).awaitTermination()
        rows = spark.read.parquet(out)
        return sorted(rows.select("exchange_name", "datetime", "price").collect())

    land(landing, "a", ("kraken", 1, 10.0), ("kraken", 1, 10.0), ("kraken", 2, 11.0))
    land(landing, "b", ("kraken", 2, 11.0), ("bisq", 2, 9.0))
    expected = [("bisq", day(2), 9.0), ("kraken", day(1), 10.0), ("kraken", day(2), 11.0)]
    assert run() == expected
    land(landing, "late", ("kraken", 1, 10.0))
    assert run() == expected


@pytest.mark.parametrize("replayed", [0, 1])
def test_a_replayed_batch_changes_nothing(spark, tmp_path, monkeypatch, replayed):
    sinks = {}
    monkeypatch.setattr(streams, "start", lambda stream, sink, checkpoint, **how: sinks.setdefault("sink", sink))
    out = str(tmp_path / "out")
    streams.start_history(spark.range(0).selectExpr("'' as k", "now()::timestamp_ntz as t"), ["k", "t"], F.to_date("t"), out, "")
    batches = [
        spark.createDataFrame([("a", day(1)), ("b", day(1))], "k string, t timestamp_ntz"),
        spark.createDataFrame([("a", day(1)), ("a", day(2)), (None, day(2))], "k string, t timestamp_ntz"),
        spark.createDataFrame([(None, day(2))], "k string, t timestamp_ntz"),
    ]
    for number, batch in enumerate(batches):
        sinks["sink"](batch, number)
    def stored():
        return sorted(spark.read.parquet(out).select("k", "t").collect(), key=str)

    before = stored()
    assert len(before) == 4
    sinks["sink"](batches[replayed], replayed)
    assert stored() == before


def test_layers_equal_the_batch_job(spark, tmp_path):
    landing, checkpoint = tmp_path / "raw", str(tmp_path / "check")
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    landing.mkdir()

    def write(name, exchange, second, price):
        document = {
            "exchange_name": exchange, "pair": "btcbrl", "fetched_at": f"2024-01-01T00:00:0{second}.000000",
            "result": {"price": {"last": price}, "volume": second if second < 4 else None},
            "allowance": {"cost": 1.0},
        }
        (landing / f"{name}.json").write_text(json.dumps(document) + "\n")

    def run():
        stream = streams.read_stream(spark, str(landing), market.LANDED, files_per_batch=1).withColumn(
            "datetime", F.col("_metadata.file_modification_time")
        )
        streams.start_layers(
            stream, market.to_silver, ["exchange_name"], ["datetime"], silver, gold, checkpoint
        ).awaitTermination()
        return streams.read_gold(spark, gold)

    write("a", "kraken", 1, 10.0)
    write("b", "bisq", 2, 9.0)
    run()
    write("c", "kraken", 4, 12.0)
    write("d", "bisq", 1, 1.0)
    run()
    # Late, yet newer than the volume known so far.
    write("e", "kraken", 3, 11.0)
    streamed = run()
    columns = sorted(streamed.columns)
    batch = market.latest(market.to_silver(market.read_raw(spark, str(landing))))
    assert streamed.orderBy("exchange_name").select(*columns).collect() == batch.select(*columns).collect()
    assert spark.read.parquet(silver).count() == 5
    kraken = streamed.where("exchange_name = 'kraken'").first()
    # The newest price, and the volume of the late snapshot, as the newest has none.
    assert (kraken.result_price_last, kraken.result_volume) == (12.0, 3.0)


def test_continuous_polling_can_be_started_and_stopped(spark, tmp_path):
    land(tmp_path / "raw", "a", ("kraken", 1, 10.0))
    seen = []
    stream = streams.read_stream(spark, str(tmp_path / "raw"), SCHEMA)
    run = streams.start(
        stream, lambda frame, batch_id: seen.append((batch_id, frame.count())),
        str(tmp_path / "check"), continuous=True,
    )
    run.processAllAvailable()
    assert run.isActive and seen == [(0, 1)]
    run.stop()
