"""A training corpus from raw documents: five stages, each written before the next reads it."""

import public_tokenizers
from pyspark.sql import functions as F

from lakework.llm import mixing, ngram_join, packing, pii, toxicity
from lakework.llm.common import cut, if_small
from lakework.scratch import scratch_path
from lakework.sources.tables import read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def remove_toxic(spark, docs, sf_dir):
    """Documents that the classifier, taught by the labels of these documents, lets pass.

    Texts that are null or empty pass, like any other text without telling words.
    """
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    score = toxicity.scorer(model)
    return docs.select(*COLUMNS).withColumn("_score", score(F.col("text"))).where(
        "_score < 0.5").select(*COLUMNS)


def remove_near_copies(spark, docs, sf_dir):
    """One row of each class of near copies (five words, similarity 0.8 or more).

    The one with the smallest ``doc_id`` stays, a null id only where the class has no other.
    Only rows whose own text is linked to that of a kept row go: rows that share a ``doc_id``
    are compared like any others, and rows with a null ``doc_id`` too. Null, empty and blank
    texts are copies of nothing and pass.
    """
    docs = docs.select(*COLUMNS)
    if not docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count():
        classes = ngram_join.near_classes(docs, size=5, percent=80)
        gone = if_small(cut(classes.where("doc_id != component_id").select("doc_id"), "copies"))
        return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)
    # Ids do not tell the rows apart: written numbers stand in for them.
    rows = cut(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    classes = cut(ngram_join.near_classes(
        rows.select(F.col("_row").alias("doc_id"), "text"), size=5, percent=80).select(
        F.col("doc_id").alias("_row"), F.col("component_id").alias("_class")), "classes")
    several = classes.groupBy("_class").count().where("count > 1").select("_class")
    members = cut(classes.join(if_small(several), "_class").join(rows.select(
        "_row", F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", F.xxhash64("text").alias("tie"),
                         "_row").alias("_place")), "_row"), "members")
    first = members.groupBy("_class").agg(F.min("_place").alias("_first"))
    gone = members.join(if_small(first), "_class").where(
        F.col("_row") != F.col("_first._row")).select("_row")
    return rows.join(if_small(cut(gone, "copies")), "_row", "left_anti").select(*COLUMNS)


def redact_personal_data(spark, docs, sf_dir):
    """All documents, with personal data in their texts replaced by the name of its kind."""
    return pii.redact(docs, COLUMNS).withColumn(
        "n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def mix_sources(spark, docs, sf_dir):
    """Documents drawn to the target shares of source, language and topic.

    The sample has as many tokens as the documents; those of cells that ask for more than
    they have stand in it several times.
    """
    drawn = mixing.rated(docs, COLUMNS).where("sampled")
    return drawn.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*COLUMNS)


def pack_sequences(spark, docs, sf_dir):
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", remove_toxic),
    ("near_copies", remove_near_copies),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A trained classifier and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; every stage's result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"stage-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
