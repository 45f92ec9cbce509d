"""Token ids in Parquet list columns, ordered by document and read back selectively.

A row is a document: ``doc_id``, ``n_tokens``, ``tokens`` and its place. Ids are
dictionary encoded (a page of bit-packed codes), the other numbers delta encoded;
row groups and pages are small enough that a reader of a few documents, or of the
metadata alone, skips the rest by footer statistics and page indexes.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from lakework.llm.common import chunks, in_order, part_offsets, share_code
from lakework.llm.tokens import encoder

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000

STORED = "doc_id long, n_tokens int, start_in_part long, part int, tokens array<int>"


def _encoding(vocabulary):
    def encode(batches):
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in chunks(batch, "text"):
                ids, bounds = encoder(vocabulary).encode(piece.column("text").to_pylist())
                sizes = np.diff(bounds)
                yield pa.record_batch({
                    "doc_id": piece.column("doc_id"),
                    "n_tokens": pa.array(sizes, pa.int32()),
                    "start_in_part": pa.array(bounds[:-1] + before, pa.int64()),
                    "part": pa.array(np.full(len(sizes), part), pa.int32()),
                    "tokens": pa.ListArray.from_arrays(
                        pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())),
                })
                before += int(bounds[-1])
    return encode


def write_tokens(docs, path, vocabulary):
    """Encode ``doc_id, text`` and write the ids below ``path`` in ascending ``doc_id`` order.

    Files, and rows in each file, follow ``doc_id``; equal ids stand in order
    of a hash of their texts. A null text counts as empty and holds the end id only; an empty
    table writes no rows. Rows with one id share a file.
    """
    share_code(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    ordered = in_order(rows, ["doc_id"], [F.xxhash64("text")]).select("doc_id", "text")
    (
        ordered.mapInArrow(_encoding(vocabulary), STORED)
        .write
        .option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#tokens.list.element", "true")
        .parquet(path)
    )


def token_index(spark, path):
    """``doc_id, part, n_tokens, start`` of every document; the ids stay on disk.

    ``start`` counts the ids of all documents before it.
    """
    rows = spark.read.schema(STORED).parquet(path).select(
        "doc_id", "part", "n_tokens", "start_in_part")
    return rows.join(part_offsets(rows, before=F.col("n_tokens")), "part").select(
        "doc_id", "part", F.col("n_tokens").cast("long").alias("n_tokens"),
        (F.col("before") + F.col("start_in_part")).alias("start"))


def read_tokens(spark, path, first=None, last=None):
    """Documents with their ids; a range of ``doc_id`` reads only its row groups and pages."""
    rows = spark.read.schema(STORED).parquet(path)
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    return rows


def _checksums(batches):
    for batch in batches:
        tokens = batch.column("tokens")
        values = tokens.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        bounds = np.concatenate(([0], np.cumsum(tokens.value_lengths().to_numpy())))
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"), "part": batch.column("part"),
            "start_in_part": batch.column("start_in_part"),
            "n_tokens": pa.array(np.diff(bounds), pa.int64()),
            "ids_crc32": pa.array(
                [zlib.crc32(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)],
                pa.int64()),
        })


def token_digests(spark, path):
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``."""
    share_code(spark)
    rows = read_tokens(spark, path)
    read = rows.select("doc_id", "part", "start_in_part", "tokens").mapInArrow(
        _checksums, "doc_id long, part int, start_in_part long, n_tokens long, ids_crc32 long")
    return read.join(part_offsets(rows, before=F.col("n_tokens")), "part").select(
        "doc_id", (F.col("before") + F.col("start_in_part")).alias("start"),
        "n_tokens", "ids_crc32")
