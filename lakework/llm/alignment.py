"""Cross-tokenizer alignment: which ids of one vocabulary stand for which of another.

Both tokenizers cut a text into runs of bytes. Offsets where both cut bound the groups. A
group of one token each is the regular case: an array over vocabulary A, made once, says
which id of B has the same bytes, and a vector over vocabulary A counts the documents that
hold such a pair. Only the other pairs, those of irregular groups, are shuffled to be counted.

Neither tokenizer joins anything over a blank or line break behind a word, so a text is the
row of its segments: white space and the word behind it. Each distinct segment is encoded and
aligned once per worker. Texts with other white space, and vocabularies with pieces over a
word's end, are encoded whole.
"""

import functools
import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakework.llm.common import chunks, cut, if_small, share_code

#: Segments that a worker keeps; others are looked up anew in each chunk.
KEPT = 300_000
#: Segments of so many bytes are never kept.
LONG = 64

_SEGMENT = re.compile(rb"[ \n]*[^ \n]+|[ \n]+")
_PLAIN = re.compile(rb" [^ \n]+")
_OTHER_SPACE = re.compile(r"[^\S \n]")

STORED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
    " own array<int>, own_links array<long>, pairs array<long>, pair_links array<long>,"
    " vector_ids array<int>, vector_counts array<long>")


def byte_letters():
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    letters for themselves, all other bytes by the letters from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class Aligner:
    """Encodes segments for vocabularies A (byte-level) and B (pieces), and aligns them."""

    def __init__(self, path_a, path_b):
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(letters[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        ids = range(self.b.get_piece_size())
        pieces = [self.b.id_to_piece(i) for i in ids]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in zip(ids, pieces, strict=True)]
        self.sizes_a, self.sizes_b = list(map(len, self.bytes_a)), list(map(len, self.bytes_b))
        self.size_b = len(self.bytes_b)
        known = {}
        for i in sorted(ids, key=self.b.is_byte, reverse=True):  # a piece goes before a byte
            if not (self.b.is_control(i) or self.b.is_unknown(i)):
                known[self.bytes_b[i]] = i
        #: A-id to the B-id of the same bytes, or -1.
        self.same = np.array([known.get(x, -1) for x in self.bytes_a], dtype=np.int64)
        inside = [p for i, p in zip(ids, pieces, strict=True) if not self.b.is_byte(i)]
        self.start_b = self.b.piece_to_id("▁a")
        self.break_a, self.break_b = self.bytes_a.index(b"\n"), self.b.piece_to_id("<0x0A>")
        self.cuttable = not any("\n" in p or re.search("[^▁]▁", p) for p in inside) and (
            self.b.encode("a\n a") == [self.start_b, self.break_b, self.start_b])
        self.known, self.broken = {}, set()
        #: Of each kept segment: tokens, groups and links; places of its pairs; its groups as text.
        self.numbers, self.places = array("q"), array("q", [0])
        self.pairs, self.links, self.texts = array("q"), array("q"), []

    def _encoded(self, segments):
        """Ids of A and of B for segments that begin anywhere in a text."""
        plain = [s for s in segments if _PLAIN.fullmatch(s)]
        found = {}
        for i in range(0, len(plain), 5_000):
            some = plain[i:i + 5_000]
            text = b"\n".join(some).decode()
            ids = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
            a = _split(ids, self.break_a)
            b = _split(self.b.encode("a" + text, num_threads=1)[1:], self.break_b)
            found.update(zip(some, zip(a, b, strict=True), strict=True))
        for s in segments:
            if s not in found:
                ids = self.a.encode_batch_fast([s.decode()], add_special_tokens=False)[0].ids
                found[s] = ids, self.b.encode("a" + s.decode(), num_threads=1)[1:]
        return found

    def _keep(self, name, segment, a, b):
        n_groups, pairs, text = self.aligned(segment, a, b)
        self.known[name] = len(self.texts)
        if text is None:
            self.broken.add(len(self.texts))
        self.numbers.extend((len(a), len(b), n_groups, sum(pairs.values())))
        self.pairs.extend(pairs.keys())
        self.links.extend(pairs.values())
        self.places.append(len(self.pairs))
        self.texts.append(text)

    def aligned(self, segment, a, b):
        """Groups, links by pair (A-id times B's size plus B-id), and the groups as text.

        The text is None where the bytes of either side are not the segment's.
        """
        if (b"".join(map(self.bytes_a.__getitem__, a)) != segment
                or b"".join(map(self.bytes_b.__getitem__, b)) != segment):
            return 0, {}, None
        sizes_a, sizes_b, size = self.sizes_a, self.sizes_b, self.size_b
        pairs, groups = {}, []
        i = j = end_a = end_b = first_a = first_b = 0
        while i < len(a) or j < len(b):
            if end_a <= end_b:
                end_a += sizes_a[a[i]]
                i += 1
            else:
                end_b += sizes_b[b[j]]
                j += 1
            if end_a == end_b:
                if i - first_a == 1 == j - first_b:
                    x, y = a[first_a], b[first_b]
                    pairs[x * size + y] = pairs.get(x * size + y, 0) + 1
                    groups.append(f"{x}|{y}")
                else:
                    left, right = a[first_a:i], b[first_b:j]
                    self._link(left, right, pairs)
                    groups.append(f"{','.join(map(str, left))}|{','.join(map(str, right))}")
                first_a, first_b = i, j
        return len(groups), pairs, ";".join(groups).encode()

    def _link(self, left, right, pairs):
        """Count each pair of occurrences of a group; those of a long one by its distinct ids."""
        if len(left) * len(right) <= 100:
            for x in left:
                for y in right:
                    key = x * self.size_b + y
                    pairs[key] = pairs.get(key, 0) + 1
            return
        left, right = (np.unique(x, return_counts=True) for x in (left, right))
        keys = (left[0].astype(np.int64)[:, None] * self.size_b + right[0]).ravel().tolist()
        for key, n in zip(keys, np.outer(left[1], right[1]).ravel().tolist(), strict=True):
            pairs[key] = pairs.get(key, 0) + n

    def of(self, texts):
        """Per text (str or None) the numbers of its segments in order, and what to ``forget``."""
        rows, whole = [], {}
        for text in texts:
            if not text:
                rows.append([])
            elif self.cuttable and not _OTHER_SPACE.search(text):
                rows.append(_SEGMENT.findall(b" " + text.encode()))
            else:
                name = b"\n" + text.encode() + b" whole"  # no segment: it holds no blank behind a word
                rows.append([name])
                whole[name] = text
        first = len(self.texts)
        new = {s for row in rows for s in row}.difference(self.known, whole)
        short = [s for s in new if len(s) <= LONG]
        for segment, ids in self._encoded(short).items():
            self._keep(segment, segment, *ids)
        last = len(self.texts)
        for segment, ids in self._encoded([s for s in new if len(s) > LONG]).items():
            self._keep(segment, segment, *ids)
        for name, text in whole.items():
            a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
            self._keep(name, (" " + text).encode(), a, self.b.encode(text, num_threads=1))
        rows = [list(map(self.known.__getitem__, row)) for row in rows]
        return rows, first if last > KEPT else last

    def forget(self, kept):
        """Back to the first ``kept`` segments: without long ones, and others than fit."""
        while len(self.known) > kept:
            self.known.popitem()
        self.broken = {s for s in self.broken if s < kept}
        del self.numbers[4 * kept:], self.places[kept + 1:], self.texts[kept:]
        del self.pairs[self.places[-1]:], self.links[self.places[-1]:]


def _split(ids, mark):
    """Lists of ids between the marks."""
    ends = [*np.flatnonzero(np.array(ids, dtype=np.int64) == mark).tolist(), len(ids)]
    return [ids[i:j] for i, j in zip([0, *(end + 1 for end in ends)], ends, strict=False)]


@functools.lru_cache(maxsize=2)
def aligner(path_a, path_b):
    """The worker's aligner for two vocabulary files."""
    return Aligner(path_a, path_b)


def _lists(text, n_texts, *columns):
    """List columns from values in order of their text's number."""
    bounds = pa.array(np.searchsorted(text, np.arange(n_texts + 1)), pa.int32())
    return [pa.ListArray.from_arrays(bounds, c) for c in columns]


def _aligning(path_a, path_b):
    def align(batches):
        words = aligner(path_a, path_b)
        vector = np.zeros(len(words.same), dtype=np.int64)
        row = TaskContext.get().partitionId() << 33
        names = [f.split()[0] for f in STORED.split(", ")]
        for batch in batches:
            for piece in chunks(batch, "text"):
                found = _measured(words, piece.column("text").to_pylist(), vector)
                n = piece.num_rows
                yield pa.record_batch([
                    pa.array(np.arange(row, row + n)), piece.column("doc_id"), *found,
                    pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.list_(pa.int64()))], names=names)
                row += n
        held = np.flatnonzero(vector)
        yield pa.record_batch([
            *[pa.nulls(1, pa.int64())] * 6, pa.nulls(1, pa.string()),
            pa.nulls(1, pa.list_(pa.int32())), *[pa.nulls(1, pa.list_(pa.int64()))] * 3,
            pa.array([held.tolist()], pa.list_(pa.int32())),
            pa.array([vector[held].tolist()], pa.list_(pa.int64()))], names=names)
    return align


def _measured(words, texts, vector):
    """The columns of a chunk; documents that hold an id with its like go into ``vector``."""
    rows, kept = words.of([t.decode() if t else None for t in texts])
    if words.broken:  # a text with a segment that either side writes otherwise has no tokens
        rows = [r if words.broken.isdisjoint(r) else [] for r in rows]
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = np.fromiter((s for r in rows for s in r), np.int64, int(sizes.sum()))
    text = np.repeat(np.arange(len(rows)), sizes)
    numbers = np.array(words.numbers).reshape(-1, 4)[flat]
    totals = np.zeros((len(rows), 4), dtype=np.int64)
    ends = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(numbers, axis=0)))
    stops = np.cumsum(sizes)
    totals[:] = ends[stops] - ends[stops - sizes]
    digests = [hashlib.sha256(b";".join([words.texts[s] for s in r])).hexdigest() if r else ""
               for r in rows]
    # All pairs of all texts, equal ones of a text together.
    places = np.array(words.places)
    count = np.diff(places)[flat]
    at = np.repeat(places[flat] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
    span = len(words.same) * words.size_b
    keys = np.repeat(text, count) * span + np.array(words.pairs, dtype=np.int64)[at]
    links = np.array(words.links, dtype=np.int64)[at]
    order = np.argsort(keys, kind="stable")
    keys, links = keys[order], links[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    keys, links = keys[first], np.add.reduceat(links, first) if len(first) else links
    text, pair = keys // span, keys % span
    a, b = pair // words.size_b, pair % words.size_b
    alike = words.same[a] == b
    vector += np.bincount(a[alike], minlength=len(vector))
    own = _lists(text[alike], len(rows), pa.array(a[alike], pa.int32()), pa.array(links[alike]))
    other = _lists(text[~alike], len(rows), pa.array(pair[~alike]), pa.array(links[~alike]))
    words.forget(kept)
    return [*[pa.array(totals[:, i]) for i in range(4)], pa.array(digests, pa.string()), *own, *other]


def _best(path_a, path_b, counts, best):
    """Sums over the regular links of each document, by two vectors over vocabulary A."""
    def regular(batches):
        for batch in batches:
            own, links = batch.column("own"), batch.column("own_links").flatten().to_numpy()
            ids = own.flatten().to_numpy()
            sums = []
            for values in (links * (counts[ids] == best[ids]), links * counts[ids]):
                ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(values)))
                stops = np.cumsum(own.value_lengths().to_numpy())
                sums.append(np.diff(ends[stops], prepend=0))
            yield pa.record_batch(
                [*(batch.column(c) for c in REGULAR), *(pa.array(s, pa.int64()) for s in sums)],
                names=[*REGULAR, "own_best", "own_sum"])
    return regular


REGULAR = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def aligned(docs, path_a, path_b):
    """``stored, pairs``: per document its groups and pairs, and the irregular pairs' counts.

    Both are written tables; ``stored`` holds, for each task, a row of vector counts too.
    """
    share_code(docs.sparkSession)
    stored = cut(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        _aligning(path_a, path_b), STORED), "aligned")
    pairs = cut(stored.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(
        F.count(F.lit(1)).alias("n")), "pairs")
    return stored, pairs


def alignment(docs, path_a, path_b):
    """Tokens, groups and links of every row of ``docs`` (``doc_id, text``) in vocabularies A and B.

    ``n_best``: links whose pair is in as many documents as any pair of its A-id;
    ``count_sum``: over the links, how many documents hold the pair; ``groups_sha256``: of the
    groups as text. Null and empty texts, and those that either tokenizer does not give back
    byte for byte behind one blank, have no tokens: zeros and an empty digest. Rows with one
    id, or with none, are documents of their own; an empty table gives no rows.
    """
    stored, pairs = aligned(docs, path_a, path_b)
    words = aligner(path_a, path_b)
    size_a, size_b = len(words.same), words.size_b
    a = F.floor(F.col("pair") / F.lit(size_b)).cast("int")
    # Both have a row per id of vocabulary A at most, whatever the documents.
    counts, best = np.zeros(size_a, np.int64), np.zeros(size_a, np.int64)
    vectors = stored.where("row is null").select(
        F.explode(F.arrays_zip("vector_ids", "vector_counts")).alias("v"))
    for i, n in vectors.groupBy("v.vector_ids").agg(F.sum("v.vector_counts")).collect():
        counts[i] = n
    for i, n in pairs.groupBy(a.alias("a")).agg(F.max("n")).collect():
        best[i] = n
    best = np.maximum(best, counts)
    spark = docs.sparkSession
    most = spark.createDataFrame(
        [(i, n) for i, n in enumerate(best.tolist()) if n], "a int, most long")
    rated = if_small(cut(pairs.withColumn("a", a).join(F.broadcast(most), "a").select(
        "pair", "n", (F.col("n") == F.col("most")).cast("long").alias("is_best")), "rated"))
    rows = stored.where("row is not null")
    irregular = rows.select("row", F.explode(F.arrays_zip("pairs", "pair_links")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.pair_links").alias("links")).join(
        rated, "pair").groupBy("row").agg(
        F.sum(F.col("links") * F.col("is_best")).alias("other_best"),
        F.sum(F.col("links") * F.col("n")).alias("other_sum"))
    regular = rows.select(*REGULAR, "own", "own_links").mapInArrow(
        _best(path_a, path_b, counts, best),
        "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,"
        " own_best long, own_sum long")
    none = F.lit(0).cast("long")
    return regular.join(irregular, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("own_best") + F.coalesce("other_best", none)).alias("n_best"),
        (F.col("own_sum") + F.coalesce("other_sum", none)).alias("count_sum"), "groups_sha256")
