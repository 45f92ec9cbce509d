"""The market jobs as streams over a landing folder.

Every batch writes to a place named after its number, or publishes a version that carries
its number, so a batch that is run again after a failure replaces its own output and nothing
else. A checkpoint and the folders its query writes belong together: start afresh with both new.
"""

from pyspark.sql import functions as F

from lakework.functions.columns import quoted
from lakework.operators.relational import dated_values, merge_newest, with_keys
from lakework.sinks import versions
from lakework.sinks.files import write_partitioned
from lakework.sources.json import NTZ_FORMAT
from lakework.sources.tables import read_if_present

POLL_INTERVAL = "2 minutes"
# Longer than any file is old; Spark's own week would leave late files out for good.
MAX_FILE_AGE = "36500d"
# Buckets of keys that gold is split into: a batch rewrites those it touches.
GOLD_BUCKETS = 32
# Batches between removals of versions that no reader needs any more.
EXPIRE_EVERY = 50


def read_stream(spark, path, schema, fmt="json", bytes_per_batch=1 << 40, files_per_batch=None):
    """Files as they land below ``path``.

    A backlog is worked off in batches of bounded size, so that a failure repeats
    one of them and not all. A file is read however old it is when it lands; to that end
    the checkpoint remembers the name of every file, so land few large ones.
    """
    reader = spark.readStream.format(fmt).schema(schema).option("maxFileAge", MAX_FILE_AGE)
    if fmt == "json":
        reader = reader.option("timestampNTZFormat", NTZ_FORMAT).option("pathGlobFilter", "*.json")
    if files_per_batch:
        return reader.option("maxFilesPerTrigger", files_per_batch).load(path)
    return reader.option("maxBytesPerTrigger", bytes_per_batch).load(path)


def start(stream, sink, checkpoint, mode="append", continuous=False):
    """Start a query that hands each batch to ``sink(frame, batch_id)``.

    By default it works off what has landed and stops, for a scheduler to start
    again; ``continuous`` keeps polling every two minutes.
    """
    trigger = {"processingTime": POLL_INTERVAL} if continuous else {"availableNow": True}
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(sink)
        .trigger(**trigger)
        .start()
    )


def _published(spark, path, batch_id):
    """Whether a batch, run again, has been published before; and the version it would follow."""
    before = versions.current(spark, path)
    return before is not None and before["batch"] >= batch_id, before


def _tidy(spark, path, batch_id):
    if batch_id % EXPIRE_EVERY == EXPIRE_EVERY - 1:
        versions.expire(spark, path)


def _newest_change(changes, keys):
    return changes.groupBy(*keys).agg(
        F.max_by("newest", "batch_id").alias("newest"), F.max("batch_id").alias("batch_id"))


def start_latest(stream, keys, order, path, checkpoint, **how):
    """Keep the newest row per key.

    Spark's state holds one row per key; a batch adds the keys it changed. Change sets are
    merged as they grow, so a reader meets one large set and the few since, not all.
    """
    keys, order = list(keys), list(order)
    values = [c for c in stream.columns if c not in keys]
    newest = stream.groupBy(*keys).agg(
        F.max_by(F.struct(*values), F.struct(*order)).alias("newest")
    )

    def sink(frame, batch_id):
        spark = frame.sparkSession
        if _published(spark, path, batch_id)[0]:
            return
        part = versions.write_part(frame.withColumn("batch_id", F.lit(batch_id).cast("bigint")), path)
        versions.add(spark, path, part, batch=batch_id, merge=lambda rows: _newest_change(rows, keys))
        _tidy(spark, path, batch_id)

    return start(newest, sink, checkpoint, mode="update", **how)


def read_latest(spark, path, keys):
    """The current row per key from what ``start_latest`` wrote."""
    changes = versions.read_current(spark, path)
    if changes is None:
        raise FileNotFoundError(f"no rows yet below {path}")
    return _newest_change(changes, keys).select(*keys, "newest.*")


def _stored_days(spark, path, days):
    """The history of some days; only their folders are listed."""
    names = ["__HIVE_DEFAULT_PARTITION__" if d is None else d.isoformat() for d in days]
    return read_if_present(spark, f"{path}/day={{{','.join(names)}}}", basePath=path)


def start_history(stream, keys, day, path, checkpoint, **how):
    """Append every snapshot once; one whose ``keys`` were seen before is skipped.

    The table is split by ``day``, a date taken from the key columns, so a batch is
    compared with the stored days it touches and not with all of history. Columns
    beside the keys come from the row that sorts last, whatever the order in which
    a batch is read.
    """
    keys = list(keys)
    values = [c for c in stream.columns if c not in keys]
    day = day.cast("date")

    def once(frame):
        if not values:
            return frame.select(*keys).distinct()
        picked = frame.groupBy(*keys).agg(F.max(F.struct(*values)).alias("row"))
        return picked.select(*keys, "row.*")

    def sink(frame, batch_id):
        spark, staged = frame.sparkSession, f"{path}/_staged/{batch_id}"
        # The batch is worked out once; its days, of which there are few, are read from that.
        once(frame).withColumn("day", day).write.mode("overwrite").parquet(staged)
        fresh = spark.read.parquet(staged)
        days = [row["day"] for row in fresh.select("day").distinct().collect()]
        stored = _stored_days(spark, path, days) if days else None
        if stored is not None:
            earlier = stored.where(F.col("batch_id") < batch_id).select("day", *keys).alias("s")
            same = [F.col(f"f.{k}").eqNullSafe(F.col(f"s.{k}")) for k in ["day", *keys]]
            fresh = fresh.alias("f").join(earlier, same, "left_anti")
        write_partitioned(fresh.withColumn("batch_id", F.lit(batch_id)), path, ["day", "batch_id"])

    return start(stream, sink, checkpoint, **how)


def start_layers(stream, to_silver, keys, order, silver_path, gold_path, checkpoint,
                 buckets=GOLD_BUCKETS, **how):
    """Silver and then gold from the same batch, in that order.

    Silver is appended. Gold is the newest value of every column per key, worked out from the
    gold of the batch before and the new silver rows only; it carries the time of each value,
    so that late rows find their place. It is split into ``buckets`` by the keys' hash, and a
    batch writes only the buckets it has rows for; a version names the others' old files.
    """
    keys, order = list(keys), list(order)
    bucket = F.pmod(F.xxhash64(*map(quoted, keys)), F.lit(buckets)).cast("int")

    def sink(frame, batch_id):
        spark = frame.sparkSession
        mine = f"{silver_path}/batch_id={batch_id}"
        to_silver(frame).write.mode("overwrite").parquet(mine)
        again, before = _published(spark, gold_path, batch_id)
        if again:
            return
        rows = dated_values(with_keys(spark.read.parquet(mine), keys), keys, order)
        touched = {r[0] for r in rows.select(bucket).distinct().collect()}  # as many as buckets at most
        parts = list(before["parts"]) if before else []
        old = [p for p in parts if p["bucket"] in touched]
        earlier = [versions.read_parts(spark, gold_path, old, mergeSchema=True)] if old else []
        if touched:
            gold = merge_newest([rows, *earlier], keys).withColumn("_bucket", bucket)
            part = versions.write_part(gold, gold_path, "_bucket")
            parts = [p for p in parts if p["bucket"] not in touched] + [
                {**part, "name": f"{part['name']}/_bucket={b}", "bucket": b} for b in sorted(touched)]
        versions.publish(spark, gold_path, parts, batch_id)
        _tidy(spark, gold_path, batch_id)

    return start(stream, sink, checkpoint, **how)


def read_gold(spark, path):
    """The newest gold version; only its files are read."""
    gold = versions.read_current(spark, path, mergeSchema=True)
    if gold is None:
        raise FileNotFoundError(f"no gold yet below {path}")
    return gold.drop("as_of")
