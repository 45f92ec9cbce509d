"""Listing of files and where each row came from."""

from pyspark.sql import functions as F

from lakework.functions.columns import stem


def file_system(spark, path):
    """Hadoop's file system of a path, and its class of paths."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def is_folder(spark, path):
    """Whether a path is a folder; one with wildcards is none."""
    files, place = file_system(spark, path)
    return files.exists(place(path)) and files.getFileStatus(place(path)).isDirectory()


def total_bytes(spark, paths):
    """Bytes below some paths, which may hold wildcards."""
    total = 0
    for path in [paths] if isinstance(paths, str) else paths:
        files, place = file_system(spark, path)
        total += sum(files.getContentSummary(s.getPath()).getLength() for s in files.globStatus(place(path)) or [])
    return total


def list_files(spark, path, glob="*"):
    """One row per file below ``path``: name, path, bytes, modification time.

    File contents are not read.
    """
    return (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter=glob)
        .load(path)
        .select(
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.col("path").alias("file_path"),
            F.col("length").alias("bytes"),
            F.col("modificationTime").alias("datetime"),
        )
    )


def with_provenance(df, extension, key="source_key", time="datetime"):
    """Add the source key, taken from the file name, and the file's modification time.

    ``df`` must come straight from a file reader.
    """
    return df.withColumns({
        key: stem(F.col("_metadata.file_path"), extension),
        time: F.col("_metadata.file_modification_time"),
    })
