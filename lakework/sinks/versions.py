"""Tables whose content changes in one step.

A table is a folder of parts, each written once under a name of its own, and of manifests,
each of which names the parts of one version. A reader takes the newest manifest, so a write
that was killed half-way leaves what was there, and a reader that has begun keeps its version
until ``expire`` removes it. One job writes a table at a time.
"""

import datetime
import uuid

from pyspark.sql import functions as F

from lakework.functions.columns import quoted
from lakework.sinks.files import write_partitioned
from lakework.sources.files import file_system, list_files
from lakework.sources.tables import read_keyed

#: ``low`` and ``high`` are the range of a time column in microseconds.
PART = "struct<name:string, rows:bigint, low:bigint, high:bigint, bucket:int>"
MANIFEST = f"version bigint, batch bigint, parts array<{PART}>"
_FIELDS = ("name", "rows", "low", "high", "bucket")
KEEP = datetime.timedelta(days=1)


def _manifests(spark, path):
    """Name and time of each manifest; their contents are not read. None where there are none."""
    files, place = file_system(spark, path)
    if not files.exists(place(f"{path}/manifests")):
        return None
    return list_files(spark, f"{path}/manifests", "*.json").select("file_path", "datetime")


def current(spark, path):
    """The newest manifest as a row: version, batch, parts. None where nothing is published."""
    manifests = _manifests(spark, path)
    newest = None if manifests is None else manifests.agg(F.max("file_path")).first()[0]
    return None if newest is None else spark.read.schema(MANIFEST).json(newest).first()


def publish(spark, path, parts, batch=None):
    """Make ``parts`` the content of the table, in one step; returns the new version's number.

    ``batch`` says how far the table has come, for a job that works in numbered steps.
    """
    before = current(spark, path)
    version = before["version"] + 1 if before else 0
    rows = [tuple(part[name] for name in _FIELDS) for part in parts]
    manifest = spark.createDataFrame([(version, batch, rows)], MANIFEST)
    # A folder per manifest: one that was not finished holds no file that a reader would see.
    manifest.coalesce(1).write.json(f"{path}/manifests/{version:012d}-{uuid.uuid4().hex}")
    return version


def micros(df, column):
    """A time column as microseconds since 1970; a zone-free one without any zone."""
    time = F.col(quoted(column))
    if dict(df.dtypes)[column] == "timestamp":
        return F.unix_micros(time)
    seconds = F.unix_date(time.cast("date")) * F.lit(86_400).cast("bigint") + F.hour(time) * 3_600 + F.minute(time) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("bigint")


def time_literal(df, column, micros):
    """A number of microseconds as a literal of a column's type, which Parquet filters understand."""
    if dict(df.dtypes)[column] == "timestamp":
        return F.timestamp_micros(F.lit(micros))
    time = datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=micros)
    return F.expr(f"timestamp_ntz'{time.isoformat(sep=' ')}'")


def write_part(df, path, by=None, time=None):
    """Write rows below the table and return their part, which no reader sees yet.

    With ``by`` the part is split into folders. Its rows and its range of ``time`` are taken
    from what was written, of which that reads the footers and one column.
    """
    name = f"parts/_part={uuid.uuid4().hex}"
    if by is None:
        df.write.parquet(f"{path}/{name}")
    else:
        write_partitioned(df, f"{path}/{name}", by, whole=True)
    written = df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}")
    low, high = (f(micros(df, time)) if time else F.lit(None).cast("bigint") for f in (F.min, F.max))
    seen = written.agg(F.count(F.lit(1)).alias("rows"), low.alias("low"), high.alias("high")).first()
    return {"name": name, "bucket": None, **seen.asDict()}


def read_parts(spark, path, parts, keys=(), **options):
    """The rows of some parts; ``keys``, taken from folder names, are text."""
    paths = [f"{path}/{part['name']}" for part in parts]
    return read_keyed(spark, paths, keys, basePath=f"{path}/parts", **options).drop("_part", "_bucket")


def read_current(spark, path, keys=(), **options):
    """The table's rows; a folder without manifests is read as it is. None for an empty version."""
    manifest = current(spark, path)
    if manifest is None:
        return read_keyed(spark, [path], keys, **options)
    return read_parts(spark, path, manifest["parts"], keys, **options) if manifest["parts"] else None


def replace(df, path, by=None, time=None, batch=None):
    """Replace the whole table in one step; refuses to replace it by nothing."""
    part = write_part(df, path, by, time)
    if not part["rows"]:
        files, place = file_system(df.sparkSession, path)
        files.delete(place(f"{path}/{part['name']}"), True)
        raise ValueError(f"refusing to overwrite {path} with an empty table")
    return publish(df.sparkSession, path, [part], batch)


def add(spark, path, part, by=None, time=None, batch=None, merge=None, keys=()):
    """Add a written part to the table in one step.

    It is merged with the latest parts as long as those are no larger than what they are merged
    with. So there are as many parts as the rows' number has binary digits, at most, and a row
    is written again that often. ``merge`` turns the rows of several parts into those of one;
    by default all stay.
    """
    manifest = current(spark, path)
    parts = list(manifest["parts"]) if manifest else []
    taken, rows = [part], part["rows"]
    while parts and parts[-1]["rows"] <= rows:
        taken.append(parts.pop())
        rows += taken[-1]["rows"]
    if len(taken) > 1:
        together = read_parts(spark, path, taken[::-1], keys, mergeSchema=True)
        part = write_part(merge(together) if merge else together, path, by, time)
    return publish(spark, path, [*parts, part] if part["rows"] else parts, batch)


def expire(spark, path, keep=KEEP):
    """Delete what no reader needs: manifests older than ``keep``, but for the newest, and parts
    that none of the others names and that were written longer ago. Returns how many parts went.
    """
    manifests = _manifests(spark, path)
    found = [] if manifests is None else sorted(manifests.collect())
    if not found:
        return 0
    since = datetime.datetime.now() - keep
    held = [r for i, r in enumerate(found) if i == len(found) - 1 or r["datetime"] > since]
    named = spark.read.schema(MANIFEST).json([r["file_path"] for r in held])
    names = {r[0] for r in named.select(F.explode("parts.name")).collect()}
    needed = {name.split("/")[1] for name in names}
    files, place = file_system(spark, path)
    for r in found:
        if r not in held:
            files.delete(place(r["file_path"]).getParent(), True)
    gone = [
        s.getPath() for s in files.listStatus(place(f"{path}/parts"))
        if s.getPath().getName() not in needed and s.getModificationTime() < since.timestamp() * 1000]
    for part in gone:
        files.delete(part, True)
    return len(gone)
