"""Near duplicates of embeddings by randomised-rotation binary codes.

A unit vector is turned by random rotations and kept as the signs of its coordinates,
with one correction factor per rotation: the inner product of the vector and its own
code. For any other vector q, the inner product of q's rotated coordinates and the
code, divided by the factor, is an unbiased estimate of the cosine, and the factor
gives the spread of its error. A pair whose estimate plus ``SPREADS`` spreads stays
below the threshold is settled; every other pair is computed again in double precision,
so no link below the threshold is ever made. Each comparison of two blocks sums its links
up per vector.

Pairs are looked for where some band of the two codes is equal. At a cosine of 0.93 a
sign differs with a probability of 0.12, so sixteen bands of twelve signs miss about one
pair in fifty, and fewer above it. ``recall_bound`` gives the share for other settings.
"""

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lakework.llm.common import cut, share_code
from lakework.llm.components import components

BANDS = 16
BAND_BITS = 12
SPREADS = 4.0
#: Members of a bucket that one task handles together on average.
BLOCK = 256


def recall_bound(cosine, bands=BANDS, bits=BAND_BITS):
    """The chance that two vectors of that cosine share a band."""
    same = 1 - math.acos(cosine) / math.pi
    return 1 - (1 - same ** bits) ** bands


@functools.lru_cache(maxsize=8)
def rotations(size):
    """Enough random orthogonal matrices for all bands, stacked; the same in every task."""
    random = np.random.default_rng(20_001 + size)
    turns = -(-BANDS * BAND_BITS // size)
    return np.concatenate([
        np.linalg.qr(random.standard_normal((size, size)))[0] for _ in range(turns)])


def coded(units):
    """Signs (as 1 and -1) of the rotated vectors and the factor of each rotation."""
    size = units.shape[1]
    turned = units @ rotations(size).T
    signs = np.where(turned >= 0, 1.0, -1.0)
    factors = (turned * signs).reshape(len(units), -1, size).sum(axis=2) / math.sqrt(size)
    return turned, signs, factors


def bands_of(signs):
    """The bands of each code as numbers, one column per band."""
    bits = (signs[:, :BANDS * BAND_BITS] > 0).reshape(len(signs), BANDS, BAND_BITS)
    return bits @ (1 << np.arange(BAND_BITS))


def estimates(turned, signs, factors):
    """Estimated cosines of all pairs (query, code) and the spread of each code's error."""
    size = signs.shape[1] // factors.shape[1]
    scaled = signs / np.repeat(factors, size, axis=1) / math.sqrt(size) / factors.shape[1]
    spread = np.sqrt(((1 - factors ** 2) / factors ** 2).clip(0).sum(axis=1) / max(1, size - 1))
    return turned @ scaled.T, spread / factors.shape[1]


def _units(vectors):
    matrix = np.array(vectors, dtype=np.float64)
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # no overflow in the norm
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _band_keys(batches):
    for batch in batches:
        sizes = np.array(batch.column("embedding").value_lengths())
        vectors = batch.column("embedding").to_pylist()
        reps, found = batch.column("rep").to_pylist(), []
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            _, signs, _ = coded(_units([vectors[i] for i in rows]))
            found += [(reps[i], b.tolist()) for i, b in zip(rows, bands_of(signs), strict=True)]
        yield pa.record_batch({
            "rep": pa.array([r for r, _ in found], pa.int64()),
            "bands": pa.array([b for _, b in found], pa.list_(pa.int32()))})


def _points(scalar):
    """Ids, numbers of copies and unit vectors of a list of points."""
    reps, copies, vectors = scalar.values.flatten()
    return reps.to_numpy(), copies.to_numpy(), _units(
        vectors.flatten().to_numpy().reshape(len(reps), -1))


def summed(a, b, a_copies, b_copies):
    """Of links between ``a`` and ``b``: the nodes, how many vectors each is linked to, and the
    smallest node that it reaches by them."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    p, q = at[:len(a)], at[len(a):]
    others = np.zeros(len(nodes), np.int64)
    np.add.at(others, p, b_copies)
    np.add.at(others, q, a_copies)
    root, before = np.arange(len(nodes)), None
    while before is None or (root != before).any():
        before = root.copy()
        least = np.minimum(root[p], root[q])
        np.minimum.at(root, p, least)
        np.minimum.at(root, q, least)
        root = root[root]
    return nodes, others, nodes[root]


def _compare(threshold):
    def compare(batches):
        """Links between two blocks of a bucket, each only in the first band that it shares.

        They leave as one row per vector, with their number and the smallest vector reached,
        so that a large group of near copies makes no row per pair.
        """
        for batch in batches:
            for k in range(batch.num_rows):
                band = batch.column("band")[k].as_py()
                same = batch.column("block")[k].as_py() == batch.column("other")[k].as_py()
                left = _points(batch.column("left")[k])
                right = left if same else _points(batch.column("right")[k])
                turned, left_signs, _ = coded(left[2])
                _, signs, factors = coded(right[2])
                guess, spread = estimates(turned, signs, factors)
                i, j = np.nonzero(guess + SPREADS * spread >= threshold)
                if same:
                    i, j = i[left[0][i] < right[0][j]], j[left[0][i] < right[0][j]]
                first = (bands_of(left_signs)[i] == bands_of(signs)[j]).argmax(axis=1)
                i, j = i[first == band], j[first == band]
                near = np.einsum("ij,ij->i", left[2][i], right[2][j]) >= threshold
                i, j = i[near], j[near]
                if len(i):
                    nodes, others, roots = summed(left[0][i], right[0][j], left[1][i], right[1][j])
                    yield pa.record_batch({
                        "node": pa.array(nodes, pa.int64()), "others": pa.array(others, pa.int64()),
                        "root": pa.array(roots, pa.int64())})
    return compare


def near_vectors(table, threshold=0.93):
    """Links and classes of vectors with one label and a cosine of ``threshold`` or more.

    Takes ``vec_id, label, embedding`` and returns ``vec_id, n_links`` (other vectors linked
    directly), ``component_id`` (smallest id reachable) and ``kept`` (the id is its class's).
    Vectors that are null, empty, all zero or hold a null or non-finite number, and rows
    without a label, have no links; vectors of different lengths are never linked. A
    repeated ``vec_id`` is one vector, the smallest of its rows; rows with a null ``vec_id``
    are left out. Equal vectors are folded into one representative and count as links of
    each other. An empty table gives no rows.
    """
    share_code(table.sparkSession)
    rows = table.where("vec_id is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), "label",
        F.col("embedding").cast("array<double>").alias("embedding"))
    if rows.groupBy("vec_id").count().where("count > 1").limit(1).count():
        least = F.min(F.struct("label", "embedding"))
        rows = rows.groupBy("vec_id").agg(least.alias("r")).select("vec_id", "r.*")
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    nonzero = F.exists("embedding", lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & finite & nonzero, F.lit(False))
    rows = cut(rows.withColumn("usable", usable), "vectors")
    classes = cut(
        rows.where("usable").groupBy("label", "embedding").agg(
            F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "vector-classes")
    bands = classes.select("rep", "embedding").mapInArrow(_band_keys, "rep long, bands array<int>")
    keyed = cut(
        bands.select("rep", F.posexplode("bands").alias("band", "value")).join(
            classes.select("rep", "label", F.size("embedding").alias("size")), "rep")
        .select("rep", "band", F.struct("label", "size", "band", "value").alias("key")), "bands")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    dealt = keyed.join(shared, "key").select(
        "key", "band", "rep",
        F.pmod(F.xxhash64("rep"), F.ceil(F.col("members") / F.lit(BLOCK))).alias("block"))
    blocks = cut(
        dealt.join(classes.drop("label"), "rep").groupBy("key", "band", "block").agg(
            F.collect_list(F.struct("rep", "copies", "embedding")).alias("points")), "bucket-blocks")
    left = blocks.toDF("key", "band", "block", "left")
    right = blocks.select("key", F.col("block").alias("other"), F.col("points").alias("right"))
    pairs = left.join(right, "key").where("block <= other").drop("key")
    links = cut(pairs.mapInArrow(
        _compare(threshold), "node long, others long, root long"), "vector-links")
    linked = links.groupBy("node").agg(F.sum("others").alias("others"))
    found = linked.join(components(links, "node", "root"), "node", "left")
    owners = rows.where("usable").select("vec_id", "label", "embedding").join(
        classes, ["label", "embedding"]).select("vec_id", "rep", "copies")
    result = owners.join(found, F.col("rep") == F.col("node"), "left").select(
        "vec_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    alone = rows.where("not usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return result.unionAll(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
