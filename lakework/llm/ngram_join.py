"""N-gram Jaccard join over count vectors of token groups, searched with packed R-trees.

Every set of shingle hashes is split into groups by hash. The counts of its groups are
a point; two sets share at most the sum of the smaller count of each group, so a pair
whose bound is below the needed overlap is left out before any text is read, and so is
a whole tree node by its largest counts. Survivors are verified on the texts.

A point search alone looks at a share of all points: a count says little about a set.
The groups therefore also say where to look. With more groups than the two sets may
differ in tokens, some groups must hold the same tokens in both, so only sets that agree
in the content of a whole group are compared. That loses no pair, whatever the data. As
there are more groups than needed, a set leaves out those whose contents most sets share:
in one order of all contents, the rarest first, linked sets agree in one of the first
``differ + 1``. A passage that many texts share thus leads nowhere by itself.

Exact copies of a set are folded into one representative first. Then each bucket of
sets with an equal group is linked to its smallest member, which joins up most groups of
near copies in linear work; buckets that still hold several components are searched
whole by R-trees over blocks of bounded size.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakework.llm.common import chunks, cut, if_small, share_code, thrifty
from lakework.llm.components import components
from lakework.llm.shingles import WordHashes, mixed, shingle_sets

#: Sizes of a class grow by this factor; a class has its own number of groups.
CLASS_RATIO = 1.5
#: Members of a bucket, or of a hub, that one task handles together on average.
BLOCK = 256
#: Points in a tree node.
NODE = 16
#: Counts of a group's point: the group's hash range is cut into so many.
FINE = 3
#: Bytes of texts that a worker takes apart at a time; the words of more take much memory.
TEXTS = 1 << 20
#: Groups beyond those needed, as a share of the tokens in which linked sets may differ.
SPARE = 0.5
#: A key's lowest bit tells an empty group, the next ones its class.
LEVEL_BITS = 6

#: Counts of the short vector that trees and first bounds use, whatever the class, as a power of
#: two. Fewer tell little of sets of some hundred tokens around a passage that they share.
SHORT_BITS = 8
SHORT = 1 << SHORT_BITS

FEATURES = ("doc_id long, n long, signature binary, keys array<long>, wanted array<int>,"
            " short binary, level int, counts binary, next_counts binary")
_HASHES = WordHashes()


def needed(n, m, percent):
    """The smallest overlap of sets of ``n`` and ``m`` tokens with 100 I >= percent U."""
    return -(-percent * (n + m) // (100 + percent))


class Classes:
    """Size classes and their groups for a threshold in percent.

    Linked sets of ``n`` and ``m`` tokens differ in at most ``(n + m) (100 - percent) /
    (100 + percent)`` of them. A class has one group more than that for its largest size.
    A set belongs to its own class and also looks into the next one if a set there may be
    near enough in size.
    """

    def __init__(self, percent):
        if percent * CLASS_RATIO < 100:
            raise ValueError("classes are too narrow for so low a similarity")
        self.percent = percent

    def bounds(self, n):
        low, level = 1, 0
        while True:
            high = max(low, int(low * CLASS_RATIO))
            if n <= high:
                return level, low, high
            low, level = high + 1, level + 1

    def groups(self, high):
        """The number of groups of a class, and how many of them a set is looked up by."""
        differ = 2 * high * (100 - self.percent) // (100 + self.percent)
        return differ + 1 + int(SPARE * differ), differ + 1

    def of(self, n):
        """``(level, groups, needed)`` of each class that a set of ``n`` tokens is looked up in."""
        level, _, high = self.bounds(n)
        found = [(level, *self.groups(high))]
        # The next class begins at high + 1; n is near enough if n / (high + 1) >= percent.
        if 100 * n >= self.percent * (high + 1):
            found.append((level + 1, *self.groups(self.bounds(high + 1)[2])))
        return found


def _grouped(tokens, level, groups, least):
    """Keys of the contents of the groups, how many more than the filled ones a set needs,
    and how many tokens each part of a group holds.

    Empty groups come last in the order of keys, so only a set with fewer than ``least``
    filled ones is looked up by the first of them as well.
    """
    spread = mixed(tokens ^ np.uint64(0x5851F42D4C957F2D))
    part = ((spread >> np.uint64(32)) * np.uint64(groups * FINE) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(spread[order]), dtype=np.uint64)))
    counts = np.bincount(part, minlength=groups * FINE)
    ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts)[FINE - 1::FINE]))
    names = np.arange(groups, dtype=np.uint64) + np.uint64((level << 40) + 1)
    keys = mixed(sums[ends[1:]] - sums[ends[:-1]] ^ mixed(names))
    keys = (keys >> np.uint64(LEVEL_BITS + 1) << np.uint64(LEVEL_BITS + 1)) | np.uint64(level << 1)
    filled = np.diff(ends) > 0
    more = least - int(filled.sum())
    empty = np.sort(keys[~filled])[:max(0, more)] | np.uint64(1)
    return np.concatenate((keys[filled], empty)), more, counts


def _packed(counts):
    """A count vector as bytes; the first tells the size of each count."""
    most = counts.max(initial=0)
    size = 1 if most < 256 else 2 if most < 65_536 else 4
    return bytes([size]) + counts.astype(f"<u{size}").tobytes()


def _vector(packed):
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1).astype(np.int64)


def _features(size, percent):
    def features(batches):
        classes, known = Classes(percent), {}
        for batch in batches:
            for piece in chunks(batch, "text", TEXTS):
                rows = {name: [] for name in (
                    "n", "signature", "keys", "wanted", "short", "level", "counts", "next")}
                for tokens in shingle_sets(piece.column("text").to_pylist(), size, _HASHES):
                    n = len(tokens)
                    if n not in known:
                        known[n] = classes.of(n) if n else []
                    found = [_grouped(tokens, *c) for c in known[n]]
                    vectors = [_packed(c) for _, _, c in found] + [None, None]
                    rows["n"].append(n)
                    rows["signature"].append(
                        hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if n else None)
                    rows["keys"].append(
                        np.concatenate([k.view(np.int64) for k, _, _ in found]) if found else [])
                    rows["wanted"].append([more for _, more, _ in found])
                    rows["short"].append(_packed(np.bincount(
                        (mixed(tokens) >> np.uint64(64 - SHORT_BITS)).astype(np.int64), minlength=SHORT)))
                    rows["level"].append(known[n][0][0] if n else None)
                    rows["counts"].append(vectors[0])
                    rows["next"].append(vectors[1])
                yield pa.record_batch([
                    piece.column("doc_id"), pa.array(rows["n"], pa.int64()),
                    pa.array(rows["signature"], pa.binary()),
                    pa.array(rows["keys"], pa.list_(pa.int64())),
                    pa.array(rows["wanted"], pa.list_(pa.int32())),
                    pa.array(rows["short"], pa.binary()), pa.array(rows["level"], pa.int32()),
                    pa.array(rows["counts"], pa.binary()),
                    pa.array(rows["next"], pa.binary()),
                ], names=["doc_id", "n", "signature", "keys", "wanted", "short", "level", "counts",
                          "next_counts"])
    return features


class Tree:
    """A packed R-tree over count vectors of sets.

    Points are sorted by size and first counts and cut into nodes; a node keeps the
    largest count of each group and its range of sizes.
    """

    def __init__(self, sizes, counts):
        self.order = np.lexsort((counts[:, 0], sizes))
        self.sizes, self.counts = sizes[self.order], counts[self.order]
        cuts = range(0, len(sizes), NODE)
        self.top = np.array([self.counts[i:i + NODE].max(axis=0) for i in cuts])
        self.least = np.array([self.sizes[i:i + NODE].min() for i in cuts])
        self.most = np.array([self.sizes[i:i + NODE].max() for i in cuts])

    def near(self, size, counts, percent):
        """Places of the points whose bound allows a link with the given point."""
        small = np.maximum(self.least, -(-percent * size // 100))
        open_nodes = (self.most * 100 >= percent * size) & (self.least * percent <= 100 * size) & (
            np.minimum(self.top, counts).sum(axis=1) >= needed(size, small, percent))
        found = []
        for node in np.flatnonzero(open_nodes):
            part = slice(node * NODE, (node + 1) * NODE)
            bound = np.minimum(self.counts[part], counts).sum(axis=1)
            fits = bound >= needed(size, self.sizes[part], percent)
            found.extend(self.order[part][fits])
        return found


def _search(percent):
    def search(batches):
        """Pairs across components between two blocks of one bucket."""
        for batch in batches:
            for row in batch.to_pylist():
                points, found = row["right"], set()
                tree = Tree(np.array([p["n"] for p in points]),
                            np.array([_vector(p["short"]) for p in points]))
                for p in row["left"]:
                    for i in tree.near(p["n"], _vector(p["short"]), percent):
                        if points[i]["component"] != p["component"]:
                            ends = p["rep"], points[i]["rep"]
                            found.add((min(ends), max(ends)))
                if found:
                    pairs = np.array(sorted(found))
                    yield pa.record_batch({
                        "a": pa.array(pairs[:, 0], pa.int64()),
                        "b": pa.array(pairs[:, 1], pa.int64())})
    return search


def _short_vectors(a, b):
    return a["short"], b["short"]


def _class_vectors(a, b):
    """The vectors of two sets in the class of the larger one; None where they have none."""
    step = b["level"] - a["level"]
    if abs(step) > 1:
        return None, None
    return (a["counts"] if step <= 0 else a["next_counts"],
            b["counts"] if step >= 0 else b["next_counts"])


def _bounded(percent, vectors):
    def bounded(batches):
        """Pairs whose sizes and bound of the overlap allow a link."""
        for batch in batches:
            fits = []
            for i, row in enumerate(batch.select(["left", "right"]).to_pylist()):
                a, b = row["left"], row["right"]
                n, m = a["n"], b["n"]
                if 100 * min(n, m) >= percent * max(n, m):
                    u, v = vectors(a, b)
                    if u is not None and v is not None and np.minimum(
                            _vector(u), _vector(v)).sum() >= needed(n, m, percent):
                        fits.append(i)
            yield batch.select(["a", "b"]).take(pa.array(fits, pa.int64()))
    return bounded


def _allowed(pairs, points, percent):
    """Those of ``pairs`` (a, b) that no bound rules out: by short vectors, then by full ones."""
    pairs = pairs.distinct()
    for columns, vectors in (
        (["n", "short"], _short_vectors), (["n", "level", "counts", "next_counts"], _class_vectors),
    ):
        left = points.select(F.col("rep").alias("a"), F.struct(*columns).alias("left"))
        right = points.select(F.col("rep").alias("b"), F.struct(*columns).alias("right"))
        pairs = cut(pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(
            thrifty(_bounded(percent, vectors)), "a long, b long"), "allowed")
        pairs = if_small(pairs)
    return pairs


def _verify(size, percent):
    def verify(batches):
        """Rows in order of (a, salt, own text first); links of each text with a's."""
        held, own = None, None
        for batch in batches:
            for piece in chunks(batch, "text", TEXTS):
                a, salt, b = (piece.column(c).to_pylist() for c in ("a", "salt", "b"))
                linked = []
                sets = shingle_sets(piece.column("text").to_pylist(), size, _HASHES)
                for i, tokens in enumerate(sets):
                    if a[i] == b[i]:
                        held, own = (a[i], salt[i]), tokens
                    elif held == (a[i], salt[i]):
                        common = len(np.intersect1d(own, tokens, assume_unique=True))
                        if 100 * common >= percent * (len(own) + len(tokens) - common):
                            linked.append(i)
                if linked:
                    yield piece.select(["a", "b"]).take(pa.array(linked))
    return verify


def _links(pairs, texts, size, percent):
    """Those of ``pairs`` (a, b) whose sets are near enough, verified on the texts.

    The texts of all partners of ``a`` meet a's own; partners of a hot ``a`` are dealt
    over several tasks, each of which gets a's text.
    """
    pairs = cut(pairs.distinct(), "candidates")
    salts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("salts"))
    salts = cut(salts, "hubs")
    own = salts.select(
        "a", F.explode(F.sequence(F.lit(0), (F.col("salts") - 1).cast("int"))).alias("salt"),
        F.col("a").alias("b"))
    members = pairs.join(if_small(salts), "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), "b")
    wanted = if_small(cut(members.unionAll(own), "wanted"))
    rows = texts.join(wanted, F.col("doc_id") == F.col("b")).select("a", "salt", "b", "text")
    return rows.repartition("a", "salt").sortWithinPartitions(
        "a", "salt", F.col("a") != F.col("b"), "b").mapInArrow(
        thrifty(_verify(size, percent)), "a long, b long")


def near_classes(docs, size=5, percent=80):
    """Classes of texts linked by shingle sets with Jaccard similarity of ``percent`` or more.

    Returns ``doc_id, n_shingles, component_id``; the component is the smallest ``doc_id``
    that links reach. Null and empty texts, and texts of white space, have no shingles and
    are alone; fewer than ``size`` words make one shingle. A repeated ``doc_id`` is one
    document, that of its smallest text, and gets one row; rows with a null ``doc_id`` are
    left out. An empty table gives no rows.
    """
    share_code(docs.sparkSession)
    docs = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    if docs.groupBy("doc_id").count().where("count > 1").limit(1).count():
        docs = docs.groupBy("doc_id").agg(F.min("text").alias("text"))
    features = cut(docs.mapInArrow(thrifty(_features(size, percent)), FEATURES), "features")
    sets = features.where("n > 0")
    # Sets that only one text has leave first. The others are joined from tables, so that Spark
    # may split the rows of a set that very many texts have.
    owners = cut(sets.groupBy("signature").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "owners")
    copies = cut(sets.select("doc_id", "signature").join(if_small(owners), "signature")
                 .where("doc_id != rep").select("doc_id", "rep"), "copies")
    reps = sets.join(if_small(copies.select("doc_id")), "doc_id", "left_anti").withColumnRenamed(
        "doc_id", "rep")
    members = _buckets(
        reps.select(F.explode("keys").alias("key"), "rep"),
        reps.select("rep", "level", F.posexplode("wanted").alias("next", "wanted")).select(
            "rep", (F.col("level") + F.col("next")).alias("level"), "wanted"))

    # First every member against the smallest of its buckets, if the bounds allow it.
    inside = if_small(cut(members.select("rep").distinct(), "members"))
    points = cut(reps.select("rep", "n", "short", "level", "counts", "next_counts").join(
        inside, "rep", "left_semi"), "points")
    stars = members.where("rep > hub").select(F.col("hub").alias("a"), F.col("rep").alias("b"))
    stars = cut(_links(_allowed(stars, points, percent), docs, size, percent), "star-links")
    found = cut(components(stars), "star-components")

    # Then all pairs across components in the buckets that still hold several.
    known = members.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component"))
    several = known.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    rest = cut(known.join(several.select("key"), "key"), "open-buckets")
    blocks = cut(_blocks(rest).join(points.select("rep", "n", "short"), "rep").groupBy("key", "block").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.collect_list(F.struct("rep", "component", "n", "short")).alias("points")), "blocks")
    left = blocks.toDF("key", "block", "left_low", "left_high", "left")
    right = blocks.toDF("key", "other", "right_low", "right_high", "right")
    pairs = left.join(right, "key").where(
        "block <= other and not (left_low = left_high and right_low = right_high"
        " and left_low = right_low)").select("left", "right")
    pairs = pairs.mapInArrow(thrifty(_search(percent)), "a long, b long")
    more = cut(_links(_allowed(pairs, points, percent), docs, size, percent), "tree-links")
    found = components(more.unionAll(found.select("node", "component")))
    found = if_small(cut(found.select(F.col("node").alias("rep"), "component"), "components"))
    return features.select("doc_id", "n").join(if_small(copies), "doc_id", "left").select(
        "doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")).join(found, "rep", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))


def _buckets(keyed, wanted):
    """``key, rep, hub`` for the rarest keys of each set; the hub is the smallest of a key.

    ``wanted``: per set and class, how many keys it needs beyond its filled groups. Keys of
    one set alone come first in the order and lead nowhere; so does a set that has enough
    of them. The two sets of a pair are its smallest and largest; only larger buckets are
    joined back to their keys.
    """
    shared = cut(keyed.groupBy("key").agg(
        F.min("rep").alias("hub"), F.max("rep").alias("last"), F.count(F.lit(1)).alias("members"))
        .where("members > 1"), "shared-keys")
    pairs = shared.where("members = 2").select(
        "key", F.explode(F.array("hub", "last")).alias("rep"), "members")
    more = if_small(shared.where("members > 2").select("key", "members"))
    level = F.shiftright("key", 1).bitwiseAND((1 << LEVEL_BITS) - 1).cast("int")
    empty = F.col("key").bitwiseAND(1)
    found = keyed.join(more, "key").select("key", "rep", "members").unionAll(pairs).select(
        "key", "rep", "members", level.alias("level"), empty.alias("empty"))
    own = Window.partitionBy("rep", "level")
    ranked = found.join(wanted, ["rep", "level"]).select(
        "key", "rep",
        (F.col("wanted") + F.sum(1 - F.col("empty")).over(own)).alias("wanted"),
        F.row_number().over(own.orderBy("empty", "members", "key")).alias("rank"))
    kept = cut(ranked.where("rank <= wanted").select("key", "rep"), "rare-keys")
    # Buckets of the same sets tell nothing new: one of them is enough.
    hubs = kept.groupBy("key").agg(
        F.min("rep").alias("hub"), F.max("rep").alias("last"), F.count(F.lit(1)).alias("members"),
        F.bit_xor(F.xxhash64("rep")).alias("h1"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("h2"),
    ).where("hub < last").groupBy("hub", "last", "members", "h1", "h2").agg(
        F.min("key").alias("key")).select("key", "hub")
    return cut(kept.join(hubs, "key").select("key", "rep", "hub"), "buckets")


def _blocks(rest):
    """Deal the members of each bucket into blocks of about ``BLOCK``.

    A component that fills half a block gets blocks of its own, which need not be
    compared with each other.
    """
    share = rest.groupBy("key", "component").agg(F.count(F.lit(1)).alias("own"))
    large = F.col("own") * 2 >= BLOCK
    total = share.where(~large).groupBy("key").agg(F.sum("own").alias("others"))
    dealt = share.join(total, "key", "left").select(
        "key", "component",
        F.when(large, F.col("component")).otherwise(-1).alias("kind"),
        F.ceil(F.when(large, F.col("own")).otherwise(F.col("others")) / F.lit(BLOCK)).alias("salts"))
    return rest.select("key", "component", "rep").join(dealt, ["key", "component"]).select(
        "key", "component", "rep",
        F.concat_ws("/", "kind", F.pmod(F.xxhash64("rep"), F.col("salts"))).alias("block"))
