"""CSV readers."""

from collections import defaultdict
from urllib.parse import unquote

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakework.functions.columns import quoted, with_types
from lakework.operators.relational import union_by_name
from lakework.sources.files import is_folder, list_files, total_bytes

# The part of a monotonically increasing id that counts rows within a partition.
_ROW_IN_PARTITION = (1 << 33) - 1


# Doubled quotes, as other CSV programs write them.
CSV_TEXT = {"escape": '"'}


def _split_bytes(spark):
    """The most bytes of a file that one task reads, as the session sets them."""
    size = spark.conf.get("spark.sql.files.maxPartitionBytes").lower().removesuffix("b")
    unit = "kmgtp".find(size[-1]) + 1
    return int(size[:-1] if unit else size) << 10 * unit


def _place(url):
    """A file's path without the scheme, which listings and rows write in two ways."""
    return url.split(":", 1)[-1].lstrip("/")


def plain_files(spark, path, quote='"'):
    """The files below ``path`` that several tasks may read, and the others.

    The former are larger than one task reads, and none of their lines holds an odd number of
    quotes. A value with a line break leaves such a line, as quotes in values are doubled; so
    records of these files are lines. None where no file is that large.
    """
    if total_bytes(spark, path) <= _split_bytes(spark):
        return None
    files = list_files(spark, path).select("file_path", "bytes").collect()
    large = [f["file_path"] for f in files if f["bytes"] > _split_bytes(spark)]
    if not large:
        return None
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    odd = spark.read.text(large).where(quotes % 2 == 1).select("_metadata.file_path").distinct()
    broken = {_place(unquote(r[0])) for r in odd.collect()}
    plain = [f for f in large if _place(f) not in broken]
    return plain, [f["file_path"] for f in files if f["file_path"] not in plain]


def _read_parts(spark, path, options, read):
    """``read(reader, path)`` of all files, those without line breaks in values split."""
    options = {**CSV_TEXT, **options}
    whole = lambda: read(spark.read.options(**{"multiLine": True, **options}), path)
    if "multiLine" in options or options["escape"] != options.get("quote", '"'):
        return whole()
    parts = plain_files(spark, path, options.get("quote", '"'))
    if parts is None or not parts[0]:
        return whole()
    base = {"basePath": path} if isinstance(path, str) and is_folder(spark, path) else {}
    frames = [
        read(spark.read.options(**base, **options, multiLine=lines), files)
        for lines, files in zip((False, True), parts, strict=True) if files]
    if any(frame.schema != frames[0].schema for frame in frames):  # inferred types that differ
        return whole()
    return frames[0] if len(frames) == 1 else frames[0].unionAll(frames[1])


def read_csv(spark, path, schema=None, infer=False, header=True, **options):
    """CSV with a header: all strings, inferred types, or the columns of a schema.

    A value in quotes may hold line breaks. Files larger than one task reads are looked through
    for such values, and those without any are split over tasks; ``multiLine`` true or false
    says so beforehand and saves the look. An empty text, quoted or not, reads as NULL.

    With a header the columns of a schema are found by name, wherever they stand in
    the file, and text that does not fit its type becomes NULL. Inference reads the
    data once more; jobs that run again should give a schema. Without a header the
    columns are ``_c0``, ``_c1`` and so on, or those of the schema in order. Unless types
    are inferred, keys in folder names stay text, so that ``007`` does not become 7.
    """
    options = {"header": header, **options}
    if schema is None and infer:
        return _read_parts(
            spark, path, options, lambda reader, files: reader.option("inferSchema", True).csv(files))
    if schema is None or header:
        names = spark.read.options(**{**CSV_TEXT, "multiLine": True, **options}).csv(path).columns
        text = StructType([StructField(name, StringType()) for name in names])
        strings = _read_parts(spark, path, options, lambda reader, files: reader.schema(text).csv(files))
    if schema is None:
        return strings
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not header:
        return _read_parts(spark, path, options, lambda reader, files: reader.schema(schema).csv(files))
    named = strings.select(*[quoted(f.name) for f in schema.fields])
    return with_types(named, {f.name: f.dataType for f in schema.fields})


def csv_header_groups(spark, path, glob="*.csv"):
    """The files below ``path`` by header line: ``{header: [file, …]}``.

    One scan of the text, without parsing it, that passes on the first row of each
    file. Only header lines and file names come back to the driver, the same list
    that any Spark read of these files keeps there.
    """
    # A sibling session, so that giving each task a single split stays private.
    probe = spark.newSession()
    split_bytes = spark.conf.get("spark.sql.files.maxPartitionBytes")
    probe.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    probe.conf.set("spark.sql.files.openCostInBytes", split_bytes)
    lines = (
        probe.read.options(recursiveFileLookup=True, pathGlobFilter=glob)
        .text(path)
        .select("value", "_metadata.file_path", "_metadata.file_block_start")
        .withColumn("row", F.monotonically_increasing_id().bitwiseAND(_ROW_IN_PARTITION))
    )
    groups = defaultdict(list)
    for row in lines.where("row = 0 and file_block_start = 0").collect():
        groups[row["value"]].append(unquote(row["file_path"]))
    return {header: sorted(groups[header]) for header in sorted(groups)}


def read_csv_by_name(spark, path, infer=False, glob="*.csv", groups=None, schema=None, **options):
    """Every CSV file below ``path``, each under its own header, matched by column name.

    Reading them in one go would match by position and put values under the wrong
    name. One scan per distinct header, not per file. ``groups`` lists paths (or
    lists of paths) whose files are known to share a header, and so saves the scan
    that looks for headers. A ``schema`` gives the columns and types of the result; a
    file may lack some of them.
    """
    if groups is None:
        groups = list(csv_header_groups(spark, path, glob).values())
    if not groups:
        raise FileNotFoundError(f"no {glob} below {path}")
    if schema is None:
        return union_by_name([read_csv(spark, files, infer=infer, **options) for files in groups])
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    frames = []
    for files in groups:
        found = read_csv(spark, files, **options)
        held = [f for f in schema.fields if f.name in found.columns]
        frames.append(with_types(
            found.select(*[quoted(f.name) for f in held]), {f.name: f.dataType for f in held}))
    return union_by_name([spark.createDataFrame([], schema), *frames])
