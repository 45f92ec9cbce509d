"""Sharding along a Hilbert curve, in built-in functions only.

Several metadata columns are quantised to a few bits each by their own quantiles, the
codes of a row are turned into its place on a Hilbert curve, and rows sorted by that
place are cut into runs of equal length. Rows of one run are near each other in every
column, so readers that filter on any of them skip most shards by minimum and maximum.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakework.llm.common import cut, if_small, in_order, part_offsets

BITS = 4


def _with_text_code(df, column, bits, name):
    """Adds the code of a text column: its values in order, cut where equal shares of rows end.

    The values are counted, ordered and summed up as one table, whatever they have in common.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_value")).agg(
        F.count(F.lit(1)).alias("_rows"))
    ordered = cut(in_order(values, ["_value"]), "values")
    earlier = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ordered = ordered.withColumn("_inside", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    coded = ordered.join(part_offsets(ordered, before=F.col("_rows")), "part").select(
        "_value", F.floor((F.col("before") + F.col("_inside")) * (1 << bits) / F.col("before_total"))
        .cast("int").alias(name))
    coded = if_small(cut(coded, "codes"))
    return df.join(coded, F.col(column) == F.col("_value"), "left").drop("_value").withColumn(
        name, F.coalesce(name, F.lit(0)))


def quantised(df, columns, bits=BITS, prefix="_axis"):
    """Adds codes of ``bits`` bits, ``<prefix>0`` and so on, from the quantiles of each column.

    Codes keep the order of the values; equal values have equal codes; null has code 0.
    """
    kinds = dict(df.dtypes)
    numbers = [c for c in columns if kinds[c] != "string"]
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    bounds = df.agg(*[
        F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(c)
        for c in numbers]).first() if numbers else {}
    for i, c in enumerate(columns):
        if c in numbers:
            code = F.lit(0)
            for bound in sorted(set(bounds[c] or [])):
                code = code + F.coalesce(F.col(c).cast("double") > F.lit(bound), F.lit(False)).cast("int")
            df = df.withColumn(f"{prefix}{i}", code)
        else:
            df = _with_text_code(df, c, bits, f"{prefix}{i}")
    return df


def _bound(value, body):
    """``body(x)`` with ``x`` evaluated once; keeps the plan linear in the steps."""
    return F.transform(F.array(value), body)[0]


def hilbert_index(df, axes, bits=BITS, name="curve"):
    """Adds the place on the Hilbert curve of the integer columns ``axes`` (``bits`` bits each),
    which are dropped."""
    n = len(axes)

    def codes(values):
        return F.struct(*[v.alias(f"x{i}") for i, v in enumerate(values)])

    def parts(state):
        return [state[f"x{i}"] for i in range(n)]

    def step(axis, bit):
        low = (1 << bit) - 1

        def turned(state):
            x = parts(state)
            is_set = x[axis].bitwiseAND(F.lit(1 << bit)) != 0
            swap = x[0].bitwiseXOR(x[axis]).bitwiseAND(F.lit(low))
            first = F.when(is_set, x[0].bitwiseXOR(F.lit(low))).otherwise(x[0].bitwiseXOR(swap))
            if axis:
                x[axis] = F.when(is_set, x[axis]).otherwise(x[axis].bitwiseXOR(swap))
            return codes([first, *x[1:]])
        return turned

    def grey(state):
        x = parts(state)
        for i in range(1, n):
            x[i] = x[i].bitwiseXOR(x[i - 1])
        return codes(x)

    def placed(state):
        x, mask = parts(state), F.lit(0)
        for bit in range(bits - 1, 0, -1):
            mask = mask.bitwiseXOR(F.when(
                x[-1].bitwiseAND(F.lit(1 << bit)) != 0, F.lit((1 << bit) - 1)).otherwise(F.lit(0)))
        return _bound(mask, lambda m: sum(
            (F.shiftright(v.bitwiseXOR(m), bit).bitwiseAND(F.lit(1)).cast("long")
             * (1 << (bit * n + n - 1 - i)) for bit in range(bits) for i, v in enumerate(x)),
            F.lit(0).cast("long")))

    state = codes([F.col(a).cast("int") for a in axes])
    for bit in range(bits - 1, 0, -1):
        for axis in range(n):
            state = _bound(state, step(axis, bit))
    return df.withColumn(name, _bound(_bound(state, grey), placed)).drop(*axes)


def hilbert_shards(docs, columns, shards):
    """Deal documents into ``shards`` runs along the Hilbert curve of ``columns``.

    Returns ``doc_id, size`` (UTF-8 bytes of the text and 1), ``text_crc32, law, shard, slot,
    grown_shard, curve``. The law is ``rows``: counts of shards differ by one at most, and
    slots count from 0 in the order of the curve. Places tie by ``doc_id``, then by size and
    checksum; rows alike in all of these are interchangeable. Null columns count as lowest,
    a null text as empty, and a null ``doc_id`` stands before all others of its place. An
    empty table gives no rows. A place that holds very many rows is split by ``doc_id``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *[F.col(c).alias(f"_by{i}") for i, c in enumerate(columns)])
    by = [f"_by{i}" for i in range(len(columns))]
    placed = hilbert_index(quantised(rows, by), [f"_axis{i}" for i in range(len(by))]).drop(*by)
    ordered = cut(in_order(placed, ["curve", "doc_id", "size", "text_crc32"]), "curve")
    rank = F.col("at") + F.col("before")
    total = F.col("before_total")
    numbered = ordered.join(part_offsets(ordered, before=F.lit(1)), "part").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        F.floor(rank * shards / total).cast("int").alias("shard"), rank.alias("rank"),
        total.alias("total"), "curve")
    begin = F.ceil(F.col("shard") * F.col("total") / shards)
    return numbered.select(
        "doc_id", "size", "text_crc32", "law", "shard",
        (F.col("rank") - begin).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "curve")
