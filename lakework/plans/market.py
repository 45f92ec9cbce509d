"""Market summaries: raw documents, flat silver, unioned gold, newest price per key."""

import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lakework.functions.columns import drop_prefix, quoted, snapshot_name
from lakework.operators.flatten import flatten, normalize
from lakework.operators.relational import last_per_key
from lakework.sinks import versions
from lakework.sinks.files import CSV_TEXT, append_json, replace_table, write_partitioned
from lakework.sources.csv import read_csv_by_name
from lakework.sources.files import list_files
from lakework.sources.json import NTZ_FORMAT, read_json
from lakework.sources.literal import read_literals
from lakework.sources.tables import read_if_present, read_keyed

# Prices are always double: inference would take a whole number for bigint.
RESULT = (
    "struct<price:struct<last:double,high:double,low:double,"
    "change:struct<percentage:double,absolute:double>>,volume:double,volumeQuote:double>"
)
ALLOWANCE = "struct<cost:double,remaining:double,upgrade:string>"
SUMMARY = f"result {RESULT}, allowance {ALLOWANCE}, exchange_name string"
LANDED = f"{SUMMARY}, pair string, fetched_at timestamp_ntz"
# As landed documents are read: the folder of a round is a column too.
ROUNDS = f"{LANDED}, snapshot string"
VALUES = (
    "price.last", "price.high", "price.low", "price.change.percentage", "price.change.absolute",
    "volume", "volumeQuote",
)
_BAD = "_bad_record"
REASONS = ("status", "unreadable", "misfit")


def has_values(result="result"):
    """Whether a document holds at least one value; one that could not be read holds none."""
    return F.coalesce(*[F.col(f"{result}.{value}") for value in VALUES]).isNotNull()


def _with_body(responses):
    """Responses with their parsed body ``data`` and the ``reason`` why it is not whole.

    ``status``: not 200, the body is not parsed; ``unreadable``: no value in it; ``misfit``:
    some field does not fit. The body is made a row of its own, a list of one: a filter on
    what it holds would else be pushed below and parse it again for each field.
    """
    good = F.coalesce(F.col("status_code") == 200, F.lit(False))
    body = F.from_json(
        F.when(good, F.col("body")), f"result {RESULT}, allowance {ALLOWANCE}, {_BAD} string",
        {"columnNameOfCorruptRecord": _BAD},
    )
    reason = F.when(~good, "status").when(~has_values("data.result"), "unreadable").when(
        F.col(f"data.{_BAD}").isNotNull(), "misfit")
    return responses.select("*", F.explode(F.array(body)).alias("data")).withColumn("reason", reason)


def rejects(responses):
    """Calls that did not give all of their values, and why (see ``_with_body``).

    Nothing lands of ``status`` and ``unreadable``; of ``misfit`` the fields that fit do. The
    columns are those of the response and ``reason``.
    """
    return _with_body(responses).where("reason is not null").drop("data")


def _observed(seen, names):
    """What was counted; zeros where Spark found the frame empty and left the counting out."""
    try:
        return seen.get
    except Py4JJavaError:
        return dict.fromkeys(names, 0)


def land(responses, path, time=None, rejects_path=None):
    """Append the successful responses of one round as raw JSON; returns what was counted.

    Each exchange gets a folder named by itself and the ``time`` of the round (by default
    now), and nothing that landed before is replaced, so a stream over ``path`` sees every
    file unchanged and a pair that a round lacks keeps what it had. A repeated round adds
    the same documents again, which ``run`` takes once. With ``rejects_path`` the calls in
    ``rejects`` are appended there.

    The result has the number of ``calls``, of those ``landed``, and of each reason, counted
    by the pass that writes; tasks repeated after a loss may count again. Only where that
    pass has counted rejects does another one write them.
    """
    time = time or datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    seen, reason = Observation(), F.col("reason")
    landed = reason.isNull() | (reason == "misfit")
    documents = _with_body(responses).observe(
        seen, F.count(F.lit(1)).alias("calls"), F.count_if(landed).alias("landed"),
        *[F.count_if(reason == name).alias(name) for name in REASONS],
    ).where(landed).select(
        "data.result", "data.allowance", "exchange_name", "pair", "fetched_at",
        snapshot_name("exchange_name", F.lit(time)).alias("snapshot"),
    )
    append_json(documents, path, "snapshot")
    counts = _observed(seen, ["calls", "landed", *REASONS])
    if rejects_path and any(counts[name] for name in REASONS):
        append_json(rejects(responses), rejects_path, "reason")
    return counts


def read_raw(spark, path, schema=ROUNDS, **options):
    """Raw JSON documents with the modification time of their file as ``datetime``."""
    return read_json(spark, path, schema, **options).withColumn(
        "datetime", F.col("_metadata.file_modification_time")
    )


def read_raw_literals(spark, path, schema=SUMMARY, **how):
    """Legacy raw documents stored as literal text.

    A document that does not fit keeps its row, the fields that do fit, and
    ``decode_failed``, so that it can be counted and found by ``file_path``.
    """
    decoded = read_literals(spark, path, schema, **how)
    return decoded.select("record.*", "datetime", "file_path", "decode_failed")


def to_silver(documents, sep="_"):
    """Flat documents without the API allowance.

    ``sep="_"`` explodes lists into rows; ``sep="."`` gives dotted names, drops
    every ``allowance*`` column and keeps lists as JSON text.
    """
    documents = documents.drop("snapshot")
    if "fetched_at" in documents.columns:
        # A landed document says itself when it was fetched; its file may hold many.
        documents = documents.withColumn(
            "datetime", F.coalesce("fetched_at", F.col("datetime").cast("timestamp_ntz"))
        ).drop("fetched_at")
    if sep == ".":
        return drop_prefix(normalize(documents), "allowance")
    return flatten(documents.drop("allowance"), sep)


def write_silver(silver, path):
    write_partitioned(silver, path, "exchange_name")


def read_silver(spark, path, schema=None):
    """All silver rows, columns matched by name.

    Without a schema the columns of all files are merged, which reads every footer.
    """
    options = {} if schema is not None else {"mergeSchema": True}
    if versions.current(spark, path) is not None:
        return versions.read_current(spark, path, ["exchange_name"], **options)
    silver = read_if_present(spark, path, schema, **options)
    if silver is None:
        raise FileNotFoundError(f"no silver data below {path}")
    return silver if schema is not None else read_keyed(spark, path, ["exchange_name"], **options)


def silver_to_gold(spark, silver_path, gold_path, schema=None, batch=None):
    """Replace gold by the union of all silver files, in one step; an empty silver leaves it alone.

    Gold is a versioned table, to be read by ``versions.read_current``.
    """
    versions.replace(read_silver(spark, silver_path, schema), gold_path, batch=batch)


def write_silver_csv(silver, path):
    """Silver as CSV files with headers, one current folder per exchange."""
    write_partitioned(
        silver, path, "exchange_name", fmt="csv", header=True, timestampNTZFormat=NTZ_FORMAT,
        **CSV_TEXT
    )


def csv_silver_to_gold(spark, silver_path, gold_path, schema=None, groups=None):
    """Replace gold by the union of all silver CSV files, columns matched by name.

    Give the schema of silver: without it types are inferred from the text. ``groups`` lists
    paths whose files share a header, which saves looking for headers.
    """
    silver = read_csv_by_name(
        spark, silver_path, infer=schema is None, groups=groups, schema=schema, basePath=silver_path)
    replace_table(silver, gold_path)


def latest(gold, keys=("exchange_name",), sort=True):
    """The newest non-null value of every column per key."""
    return last_per_key(gold, keys, "datetime", sort=sort)


def _new_files(spark, path, done):
    """The raw files that ``done`` does not name, with their times: a written part of it."""
    files = list_files(spark, path, "*.json").select("file_path", "datetime")
    if versions.current(spark, done) is not None:
        files = files.join(versions.read_current(spark, done), ["file_path", "datetime"], "left_anti")
    return versions.write_part(files, done)


def _without_known(spark, path, part, known):
    """A part of silver without the rows that are in it already; it may be the same part.

    Only parts that share its range of time are read, and of them that range.
    """
    near = [p for p in known if p["low"] <= part["high"] and p["high"] >= part["low"]]
    if not near:
        return part
    rows = versions.read_parts(spark, path, [part], ["exchange_name"])
    low, high = (versions.time_literal(rows, "datetime", part[end]) for end in ("low", "high"))
    earlier = versions.read_parts(spark, path, near, ["exchange_name"], mergeSchema=True).where(
        F.col("datetime").between(low, high))
    same = [F.col(f"n.{quoted(c)}").eqNullSafe(F.col(f"e.{quoted(c)}")) for c in rows.columns]
    fresh = rows.alias("n").join(earlier.alias("e"), same, "left_anti")
    return versions.write_part(fresh, path, "exchange_name", "datetime")


def run(spark, lake, dataset="exchanges", sep="_", literals=False):
    """Raw to silver to gold, of the files that have landed since the last run; returns gold.

    The files read are noted beside silver, under ``<dataset>-files``. A document that landed
    twice counts once, in whichever run; so a run that was killed may be repeated. With
    ``literals`` raw holds legacy literal text; a file that was replaced counts as another one.
    In both forms a document keeps the fields that could be read; one without any value stays
    in raw only, where ``read_raw_literals`` shows it.
    """
    raw, silver, gold, done = (
        lake.raw(dataset), lake.silver(dataset), lake.gold(dataset), lake.silver(f"{dataset}-files"))
    files = _new_files(spark, raw, done)
    known = versions.current(spark, silver)
    batch = known["batch"] if known else 0
    if files["rows"]:
        paths = [r[0] for r in versions.read_parts(spark, done, [files]).select("file_path").collect()]
        if literals:
            documents = read_raw_literals(spark, paths).drop("file_path", "decode_failed")
        else:
            documents = read_raw(spark, paths, basePath=raw)
        rows = to_silver(documents.where(has_values()), sep).distinct()
        part = versions.write_part(rows, silver, "exchange_name", "datetime")
        if known and part["rows"]:
            part = _without_known(spark, silver, part, known["parts"])
        if part["rows"]:
            batch += 1
            added = versions.read_parts(spark, silver, [part], ["exchange_name"])
            versions.add(spark, silver, part, "exchange_name", "datetime", batch, keys=["exchange_name"])
            before = versions.current(spark, gold)
            if before and before["batch"] == batch - 1:
                versions.add(spark, gold, versions.write_part(added, gold), batch=batch)
        versions.add(spark, done, files)
    made = versions.current(spark, gold)
    if made is None or made["batch"] != batch:  # the first run, or one was killed before gold
        silver_to_gold(spark, silver, gold, batch=batch)
    return versions.read_current(spark, gold, mergeSchema=True)
