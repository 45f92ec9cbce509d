"""Document fingerprints by consistent weighted sampling, in built-in functions only.

A document is a weighted set: its words and how often each stands in it. Per word and
sample there are two Gamma(2, 1) variates r and c and a uniform one b, all drawn from hashes
of the word, so that every document draws the same. The weight w reaches the level
t = floor(ln w / r + b); the word with the smallest a = c exp(-r (t - b + 1)), with its level,
is the sample. Two documents draw the same sample with the probability of their generalised
Jaccard similarity, the sum of smaller weights over the sum of larger ones.

The variates are made of four exponential ones. With c = x + y and u = x / c, which is uniform,
and r = -ln u + z and b = z / r, level 0 has the value a = x, and is left where w u >= 1. So
the weight 1, which most words have, needs x alone; and as 1 - exp(-x) is uniform, values are
compared as that: for those words a hash is the draw. With y and z as -ln of uniform v1 and v2,
level 0 is kept where exp(-x) ^ (w - 1) > v1, and the value behind is x v2 / w exp(m mod s) with
m = ln(w / v2) and s = ln((1 + y / x) / v2), in which everything stands once: Spark works out
what stands twice in a branch twice. The value itself tells what was sampled, so its hash stands
for the sample; it is cut to 40 bits, as different weights reach a level by other roundings.

Every distinct word is drawn for every one of the ``SAMPLES``, so a text with any words
has all samples, and the share of equal ones is that similarity in expectation. Texts that
are drawn together, like a text and its edited form, share the draws of the words that weigh
the same in them.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

SAMPLES = 64
#: Blocks of neighbouring documents per shuffle partition.
BLOCKS = 4

_SIGN = 1 << 16
_BITS = 40
_WHOLE = float(1 << _BITS)


def _uniform(hashed, shift, bits):
    """A uniform number above 0 and below 1 from some bits of a 64-bit hash."""
    part = F.shiftrightunsigned(hashed, shift).bitwiseAND((1 << bits) - 1)
    return (part + F.lit(0.5)) / F.lit(float(1 << bits))


def _drawn(word, weight, sample):
    """What a word of some weight (a whole number) draws for a sample: 40 bits to compare.

    ``word`` is a 64-bit hash; the draw is null where ``weight`` is.
    """
    lowest = F.shiftrightunsigned(F.xxhash64(word, F.lit(sample)), 64 - _BITS)
    kept = 1 - (lowest + F.lit(0.5)) / F.lit(_WHOLE)
    more = F.xxhash64(word, F.lit(SAMPLES + sample))
    v1, v2 = _uniform(more, 32, 32), _uniform(more, 0, 32)
    left = F.log(weight / v2) % F.log((1 + F.log(v1) / F.log(kept)) / v2)
    higher = F.floor(-F.expm1(F.log(kept) * v2 / weight * F.exp(left)) * F.lit(_WHOLE))
    return F.when(weight == 1, lowest).when(
        F.when(weight == 2, kept).otherwise(F.pow(kept, weight - 1)) > v1, lowest).when(weight > 1, higher)


def _words(text):
    """Hashes of the words of a text: runs without white space, in lower case."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _entry(word, weight, texts):
    return F.struct(word.alias("_word"), weight.alias("weight"), texts.alias("texts"))


def _run_bounds(words):
    """Places where the runs of equal values of a sorted array begin, and its length if it has any."""
    return F.filter(
        F.sequence(F.lit(0), F.size(words)),
        lambda at: ~F.get(words, at).eqNullSafe(F.get(words, at - 1)))


def _counted(words, bounds, texts):
    """An entry per distinct word of a sorted array, with the length of its run."""
    return F.transform(F.array_distinct(words), lambda word, at: _entry(
        word, F.get(bounds, at + 1) - F.get(bounds, at), F.lit(texts)))


def _shared(entries, most):
    """One entry for each run of ``most`` at most with equal word and weight in a sorted array."""
    def same(a, b):
        return a["_word"].eqNullSafe(b["_word"]) & a["weight"].eqNullSafe(b["weight"])

    def first(entry, at):
        others = [F.get(entries, at + i) for i in range(1, most)]
        texts = sum((F.when(same(entry, x), x["texts"]).otherwise(0) for x in others), entry["texts"])
        return F.when(~same(entry, F.get(entries, at - 1)), _entry(entry["_word"], entry["weight"], texts))

    return F.array_compact(F.transform(entries, first))


def fingerprints_of(rows, key, texts):
    """``rows`` with the samples of every text column in ``texts`` (a name to a column).

    ``key`` are columns of ``rows``, the first of which deals the rows over tasks, that tell
    rows apart; they are all that stays. The samples of a text are ``sample * 65536 + 16
    bits of a hash``; null, empty and blank texts have none. Equal words are folded first, in
    sorted arrays of one row, so that no task holds the words of all its rows. A word is
    then drawn once for all texts of its row in which it has the same weight; the smallest
    draw of each sample is kept, first for each set of texts and then for each text.
    """
    names = list(texts)
    # A column of each step is read several times in the next, so Spark works it out once.
    words = rows.select(*key, *[
        F.sort_array(_words(column)).alias(f"_words{i}") for i, column in enumerate(texts.values())])
    bounds = words.select("*", *[
        _run_bounds(F.col(f"_words{i}")).alias(f"_bounds{i}") for i in range(len(names))])
    counted = bounds.select(*key, F.sort_array(F.concat(*[
        _counted(F.col(f"_words{i}"), F.col(f"_bounds{i}"), 1 << i) for i in range(len(names))])).alias("_entries"))
    # A row without words keeps one entry, of nulls.
    drawn = counted.select(*key, F.inline_outer(_shared(F.col("_entries"), len(names))))
    least = drawn.groupBy(*key, "texts").agg(*[
        F.min(_drawn(F.col("_word"), F.col("weight"), k)).alias(f"_{k}") for k in range(SAMPLES)])
    kept = least.groupBy(*key).agg(*[
        F.min(F.when(F.col("texts").bitwiseAND(1 << i) > 0, F.col(f"_{k}"))).alias(f"_{i}_{k}")
        for i in range(len(names)) for k in range(SAMPLES)])
    return kept.select(*key, *[
        F.when(F.col(f"_{i}_0").isNull(), F.array().cast("array<int>")).otherwise(F.array(*[
            (F.xxhash64(f"_{i}_{k}").bitwiseAND(_SIGN - 1) + k * _SIGN).cast("int")
            for k in range(SAMPLES)])).alias(name)
        for i, name in enumerate(names)])


def as_text(samples):
    """Samples as hexadecimal digits, six each."""
    return F.array_join(F.transform(samples, lambda x: F.lpad(F.hex(x), 6, "0")), "")


def likeness(a, b):
    """Share of equal samples; 1 for two texts without any, 0 if one has none."""
    most = F.greatest(F.size(a), F.size(b))
    return F.when(most == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(a, b)).cast("double") / most)


def with_next(docs, blocks=None):
    """``docs`` (``doc_id, text``) in blocks of neighbours, each with the first row of the next.

    Adds ``block``, ``tie`` and ``guest``: the window returned with the frame runs over a
    block in descending ``doc_id``, and behind its last document stands, as a guest, the
    first one of the next block (behind the last block, of the first). Rows with one
    ``doc_id`` follow the order of ``tie``, a hash of the text; null ids come last.
    """
    spark = docs.sparkSession
    blocks = blocks or BLOCKS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shares = [i / blocks for i in range(1, blocks)] or [0.5]
    bounds = sorted(set(
        rows.agg(F.percentile_approx("doc_id", shares, 10 * blocks)).first()[0] or []))
    # Block 0 holds the largest ids; a null id is below all.
    above = F.size(F.filter(F.lit(bounds) if bounds else F.array().cast("array<long>"),
                            lambda b: b >= F.coalesce("doc_id", F.lit(-(1 << 63)))))
    rows = rows.withColumns({"block": above, "tie": F.xxhash64("text")})
    first = F.max(F.struct("doc_id", "tie"))
    heads = rows.groupBy("block").agg(first.alias("head"))
    order = Window.orderBy("block")
    heads = heads.select(
        F.col("block").alias("own"), F.col("head.doc_id").alias("id"), F.col("head.tie").alias("t"),
        F.coalesce(F.lag("block").over(order), F.max("block").over(
            order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("before"))
    # At most one row per block, and the number of blocks is given.
    guests = rows.join(F.broadcast(heads), (F.col("block") == F.col("own"))
                       & F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tie") == F.col("t")))
    guests = guests.dropDuplicates(["own"]).select(
        "doc_id", "text", F.col("before").alias("block"), "tie", F.lit(True).alias("guest"))
    ordered = Window.partitionBy("block").orderBy(
        "guest", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
    return rows.withColumn("guest", F.lit(False)).unionAll(guests), ordered


def fingerprints(docs):
    """Fingerprints of all texts and of their edited forms.

    The edited text has its last third, in code points, replaced by the first as many code
    points (or all) of the next document in descending ``doc_id``; after the last comes the
    first. Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``, one row per row of ``docs``. A null text is empty; empty texts
    have an empty fingerprint and are alike; an only document is its own next one; an empty
    table gives no rows. Equal texts have equal fingerprints.
    """
    rows, ordered = with_next(docs)
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.substr("text", F.lit(1), n - cut),
        F.coalesce(F.substr(F.lead("text").over(ordered), F.lit(1), cut), F.lit("")))
    rows = rows.withColumns({"edited": edited, "place": F.row_number().over(ordered)}).select(
        "block", "place", "doc_id", "guest", "text",
        n.cast("long").alias("n_chars"), F.unhex(F.sha2("edited", 256)).alias("digest"),
        F.when(~F.col("guest"), F.col("edited")).alias("edited"))
    key = ["block", "place", "doc_id", "guest", "n_chars", "digest"]
    drawn = fingerprints_of(
        rows, key, {"samples": F.col("text"), "edited_samples": F.col("edited")})
    following = F.lead("samples").over(Window.partitionBy("block").orderBy("place"))
    return drawn.withColumn("next_samples", following).where("not guest").select(
        "doc_id", "n_chars", F.lower(F.hex("digest")).alias("edited_sha256"), as_text(F.col("samples")).alias("fingerprint"),
        as_text(F.col("edited_samples")).alias("edited_fingerprint"),
        likeness(F.col("samples"), F.col("edited_samples")).alias("near_edited"),
        likeness(F.col("samples"), F.col("next_samples")).alias("near_next"))
