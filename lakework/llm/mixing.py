"""Mixing to target weights by iterative proportional fitting, in built-in functions only.

Documents fall into cells of source, language and topic. The token weights of the cells
are raked: scaled to meet the target share of each source, then of each language, then of
each topic, again and again until all three hold. A document is then drawn at the rate
that brings its cell from its tokens to its weight's share of a token budget: with a
probability below one, or as often as the rate says above, up to a bound; what a cell lacks
beyond it is reported. The fraction is drawn from a hash of its id, so that expected tokens
meet every target and the budget but for what cells lack, and a rerun draws the same documents.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakework.llm.common import cut, if_small

#: Without given targets, shares are those of the data to these powers: large ones shrink,
#: and a power of one holds them as they are.
EXPONENTS = {"source": 0.9, "lang": 0.95, "topic": 1.0}
ROUNDS = 30
TOLERANCE = 1e-6
#: Rounds in one plan, between two written tables.
ROUNDS_AT_ONCE = 2
SEED = 11
#: How often a document may stand in the sample at most.
MOST_COPIES = 8


def topic_of(text):
    """The kind of a text by its symbols: ``table``, ``numbers``, ``symbols`` or ``prose``."""
    n = F.greatest(F.length(text), F.lit(1))
    share = lambda marks: (n - F.length(F.translate(text, marks, ""))) / n
    return (
        F.when(share("|\t") > 0.02, "table").when(share("0123456789") > 0.05, "numbers")
        .when(share("#$%&*<>{}[]=_/") > 0.03, "symbols").otherwise("prose"))


def tokens_of(text):
    """Words of a text, and one for its end."""
    return (F.size(F.array_remove(F.split(text, r"\s+"), "")) + 1).cast("double")


def rake(cells, dims, targets=None, exponents=None):
    """Scale ``tokens`` of ``cells`` to the target shares of every column in ``dims``.

    ``cells`` has one row per combination; ``targets`` maps a column to ``{value: share}``
    (a share for null under ``None``). Values without a given share keep their own; where a
    column has no targets, shares are those of the data to its power in ``exponents`` (1 by
    default). Shares count among the values that are there. Adds ``weight``, which sums to one. Cells without
    tokens weigh nothing.
    """
    cells = cut(cells, "cells")
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    for dim in dims:
        own = F.sum("tokens") / F.lit(total)
        given = (targets or {}).get(dim)
        if given is None:
            wanted = F.pow("own", F.lit(float((exponents or {}).get(dim, 1))))
        else:
            wanted = F.col("own")
            for value, share in given.items():
                wanted = F.when(F.col("_value").eqNullSafe(F.lit(value)), F.lit(float(share))).otherwise(wanted)
        # One row per value; their sum is one number.
        shares = cut(cells.groupBy(F.col(dim).alias("_value")).agg(own.alias("own")).select(
            "_value", wanted.alias("_share")), "shares")
        whole = shares.agg(F.sum("_share")).first()[0] or 1
        cells = cells.join(if_small(shares), F.col(dim).eqNullSafe(F.col("_value"))).withColumn(
            f"_want_{dim}", F.col("_share") / F.lit(whole)).drop("_value", "_share")
    cells = cut(cells.withColumn("weight", F.col("tokens") / F.lit(total)), "weighed")
    for _ in range(0, ROUNDS, ROUNDS_AT_ONCE):
        for _ in range(ROUNDS_AT_ONCE):
            for dim in dims:
                now = F.sum("weight").over(Window.partitionBy(dim))
                cells = cells.withColumn("weight", F.when(
                    now > 0, F.col("weight") * F.col(f"_want_{dim}") / now).otherwise(F.lit(0.0)))
        cells = cut(cells, "raked")
        off = cells
        for dim in dims:
            off = off.withColumn(f"_off_{dim}", F.abs(
                F.sum("weight").over(Window.partitionBy(dim)) - F.col(f"_want_{dim}")))
        worst = off.agg(F.max(F.array_max(F.array(*[f"_off_{d}" for d in dims])))).first()[0]
        if worst is None or worst < TOLERANCE:
            break
    return cells.drop(*[f"_want_{d}" for d in dims])


def rated(docs, columns, topic=None, targets=None, exponents=None, seed=SEED, budget=None,
          most_copies=MOST_COPIES):
    """``columns`` of ``docs`` with ``topic, tokens, weight, rate, probability, copies, sampled, lacking``.

    ``docs`` needs ``doc_id, text, lang, source``; ``topic`` is a column, by default the kind of
    text. ``weight`` is that of the document's cell. ``budget`` is the expected number of tokens
    drawn, by default as many as there are, so no cell sets how much of the others is kept.
    ``rate`` is the expected number of ``copies`` in the sample, ``probability`` that of having
    any; a cell whose weight asks for more tokens than it has is repeated, each document
    ``most_copies`` times at most; ``lacking`` is what its cell is short of then, in tokens. Null and empty texts count one token; null
    sources, languages and topics are values of their own; rows with one ``doc_id`` and source
    are kept or left together, null ids by their text. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        *columns, F.col("source").alias("_source"), F.col("lang").alias("_lang"),
        (topic_of(text) if topic is None else topic).alias("_topic"), tokens_of(text).alias("_tokens"),
        F.xxhash64(F.coalesce("doc_id", F.xxhash64(text)), "source", F.lit(seed)).alias("_draw"))
    # Written, as the cells and the draw both need what is read off the texts.
    rows = cut(rows, "read-off")
    dims = ["_source", "_lang", "_topic"]
    cells = rows.groupBy(*dims).agg(F.sum("_tokens").alias("tokens"))
    given = {f"_{k}": v for k, v in (targets or {}).items()}
    powers = {f"_{k}": v for k, v in (EXPONENTS if exponents is None else exponents).items()}
    raked = rake(cells, dims, given, powers)
    if budget is None:
        budget = raked.agg(F.sum("tokens")).first()[0] or 0
    wanted = F.lit(float(budget))
    cells = cut(raked.select(
        *[F.col(d).alias(f"_cell{d}") for d in dims], "weight",
        F.least(F.col("weight") * wanted / F.col("tokens"), F.lit(float(most_copies))).alias("rate"),
        F.greatest(F.col("weight") * wanted - F.col("tokens") * most_copies, F.lit(0.0)).alias("lacking")), "rated")
    same = F.lit(True)
    for dim in dims:
        same = same & F.col(dim).eqNullSafe(F.col(f"_cell{dim}"))
    drawn = (F.shiftrightunsigned("_draw", 11) + F.lit(0.5)) / F.lit(float(2 ** 53))
    whole = F.floor("rate")
    copies = (whole + (drawn < F.col("rate") - whole).cast("long")).cast("long")
    return rows.join(if_small(cells), same).withColumn("copies", copies).select(
        *columns, F.col("_topic").alias("topic"), F.col("_tokens").cast("long").alias("tokens"),
        "weight", "rate", F.least("rate", F.lit(1.0)).alias("probability"), "copies",
        (F.col("copies") > 0).alias("sampled"), "lacking")


def mix(docs, **options):
    """Every row of ``docs`` as ``doc_id, source, lang`` and what ``rated`` adds."""
    return rated(docs, ["doc_id", "source", "lang"], **options)
