"""Order-preserving packing: cut a run of documents into windows by dynamic programming.

Documents stand one after another in order of ``doc_id``. A window is a run of at
most ``window`` tokens between two cuts. A cut at the end of a document is free, one
at the end of a sentence costs ``SENTENCE_CUT`` and one elsewhere ``WORD_CUT``; a
window costs its padding besides. The cheapest cuts of a block of documents are found
exactly: because padding is linear in both ends, the best earlier cut is the smallest
key of a sliding range, kept in a monotone queue.
"""

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from lakework.llm.common import chunks, in_order, share_code
from lakework.llm.tokens import encoder

WINDOW = 2048
#: Costs in tokens of padding.
SENTENCE_CUT = 8
WORD_CUT = 64
#: Where no document or sentence ends for so many tokens, cuts may fall inside.
STRIDE = 128
#: Tokens of a block, beyond which it ends with the document it is in.
BLOCK = 1 << 20

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
          " sequence_id long, offset long")


def cut_points(size, ends, closing, stride=STRIDE, sentence=SENTENCE_CUT, word=WORD_CUT):
    """Places from 0 to ``size`` where a cut may fall, and what it costs there.

    ``ends``: places behind documents; ``closing``: behind sentences.
    """
    marks = np.unique(np.concatenate(([0], ends, closing)))
    gaps = np.diff(marks)
    wide = np.flatnonzero(gaps > stride)
    inner = [np.arange(marks[i] + stride, marks[i + 1], stride) for i in wide]
    places = np.unique(np.concatenate([marks, *inner]))
    cost = np.full(len(places), word, dtype=np.int64)
    cost[np.searchsorted(places, closing)] = sentence
    cost[np.searchsorted(places, ends)] = 0
    return places, cost


def best_cuts(places, cost, window=WINDOW):
    """The places of the cheapest cuts, first and last place included.

    A window of a power of two tokens needs no padding; any other is padded to
    ``window``. No two neighbouring places may be further apart than ``window``.
    """
    place, price = places.tolist(), cost.tolist()
    # Of all pairs of places that lie a power apart: the later one, ascending, and the earlier.
    hits = []
    for size in (1 << k for k in range(window.bit_length() - 1) if 1 << k < window):
        at = np.searchsorted(places, places - size)
        later = np.flatnonzero(places[at] == places - size)
        hits.append(np.stack([later, at[later]]))
    later, earlier = np.concatenate(hits, axis=1) if hits else np.zeros((2, 0), dtype=np.int64)
    order = np.argsort(later, kind="stable")
    earlier = earlier[order].tolist()
    first = np.searchsorted(later[order], np.arange(len(place) + 1)).tolist()
    total, previous = [0] * len(place), [0] * len(place)
    queue = deque([(0, 0, 0)])  # (total + place, place, index), keys ascending
    for j in range(1, len(place)):
        p = place[j]
        while queue[0][1] < p - window:
            queue.popleft()
        key, _, best = queue[0]
        least = key + window - p
        for i in earlier[first[j]:first[j + 1]]:
            if total[i] < least:
                least, best = total[i], i
        total[j], previous[j] = least + price[j], best
        key = total[j] + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, p, j))
    cuts, j = [place[-1]], len(place) - 1
    while j:
        j = previous[j]
        cuts.append(place[j])
    return np.array(cuts[::-1])


def _pieces(doc_ids, bounds, ids, cuts, sequence):
    """The pieces between all document and window ends, as a record batch."""
    edges = np.unique(np.concatenate([bounds, cuts]))
    starts, lengths = edges[:-1], np.diff(edges)
    doc = np.searchsorted(bounds, starts, side="right") - 1
    window = np.searchsorted(cuts, starts, side="right") - 1
    data = ids.astype("<u4")
    return pa.record_batch({
        "doc_id": doc_ids.take(pa.array(doc)).cast(pa.int64()),
        "start": pa.array(starts - bounds[doc], pa.int64()),
        "length": pa.array(lengths, pa.int64()),
        "ids_crc32": pa.array(
            [zlib.crc32(data[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.int64()),
        "doc_tokens": pa.array(np.diff(bounds)[doc], pa.int64()),
        "sequence_id": pa.array(window + sequence, pa.int64()),
        "offset": pa.array(starts - cuts[window], pa.int64()),
    })


def _packing(vocabulary, window, block):
    def pack_block(words, held, sequence):
        doc_ids = pa.concat_arrays([d for d, _, _ in held])
        ids = np.concatenate([i for _, i, _ in held])
        sizes = np.concatenate([np.diff(b) for _, _, b in held])
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        closing = np.flatnonzero(np.isin(ids, words.closing)) + 1
        places, cost = cut_points(len(ids), bounds[1:], closing, min(STRIDE, window))
        cuts = best_cuts(places, cost, window)
        return _pieces(doc_ids, bounds, ids, cuts, sequence), len(cuts) - 1

    def pack(batches):
        words = encoder(vocabulary)
        sequence = TaskContext.get().partitionId() << 33
        held, size = [], 0
        for batch in batches:
            for piece in chunks(batch, "text"):
                ids, bounds = words.encode(piece.column("text").to_pylist())
                held.append((piece.column("doc_id"), ids, bounds))
                size += len(ids)
                if size >= block:
                    found, n = pack_block(words, held, sequence)
                    yield found
                    held, size, sequence = [], 0, sequence + n
        if held:
            yield pack_block(words, held, sequence)[0]
    return pack


def pack(docs, vocabulary, window=WINDOW, block=BLOCK):
    """Pack ``doc_id, text`` into sequences; one row per piece of a document.

    Columns: ``doc_id``, ``start`` (ids of the document before the piece), ``length``,
    ``ids_crc32`` (of the ids as unsigned little-endian words), ``doc_tokens`` (with the
    end id), ``sequence_id`` (unique, ascending with the order) and ``offset`` (place in
    the sequence). Null and empty texts hold the end id only; rows with one ``doc_id``
    follow a hash of their texts; an empty table gives no rows. Each task packs its
    range of documents in blocks, so its memory is bounded by a block and one document.
    """
    share_code(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    ordered = in_order(rows, ["doc_id"], [F.xxhash64("text")]).select("doc_id", "text")
    return ordered.mapInArrow(_packing(vocabulary, window, block), PIECES)
