"""The toxicity model on labels of every kind, and its swaps against whole sentences."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakework.llm import toxicity

KINDS = [(1, "calm words about rivers and hills"), (2, None), (3, ""), (4, "awful nasty horrid vile words")]
DOCS = "doc_id long, text string"
LABELS = "doc_id long, quality int, toxic int"


def teaching(share):
    """600 documents, of which a share is toxic and says so: enough to tell at any of the shares."""
    rows = [(100 + i, f"{'awful vile' if i < 600 * share else 'calm kind'} words number n{i}") for i in range(600)]
    return rows, [(r[0], 0, int("awful" in r[1])) for r in rows]


@pytest.mark.parametrize("labels", [
    [], [(i, 0, 1) for i in range(40)], [(i, 0, 0) for i in range(40)],
    [(i, 0, int(i % 10 < 6)) for i in range(40)], [(1, 0, None), (None, 0, 1)]])
def test_texts_without_telling_words_pass(spark, labels, tmp_path):
    docs = spark.createDataFrame([*KINDS, *[(i, f"text t{i}") for i in range(5, 40)]], DOCS)
    labels = spark.createDataFrame(labels, LABELS)
    rows = toxicity.scored(docs, toxicity.train(docs, labels)).collect()
    assert len(rows) == 39 and all(r["predicted"] == 0 and 0 <= r["score"] <= toxicity.PRIOR + 1e-9 for r in rows)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    whole = docs.selectExpr("*", "'en' as lang", "'a' as source", "9L as n_chars")
    assert corpus_pipeline.remove_toxic(spark, whole, str(tmp_path)).count() == 39


@pytest.mark.parametrize("share", [0.05, 0.6, 0.9])
def test_any_share_of_toxic_labels(spark, share):
    rows, labels = teaching(share)
    docs = spark.createDataFrame([*KINDS, *rows], DOCS)
    model = toxicity.train(docs, spark.createDataFrame(labels, LABELS))
    found = {r["doc_id"]: r for r in toxicity.scored(docs, model).collect()}
    assert [found[i]["predicted"] for i in (1, 2, 3)] == [0, 0, 0]
    assert all(found[i]["predicted"] == t for i, _, t in labels)


def test_swaps_equal_those_of_whole_sentences():
    sentence = "the women and men saw women, black men and old women men"
    words = re.findall(r"\w+", sentence)
    found = toxicity.swapped(sentence + ". no names here. Gay")
    plain = []
    for words in (words, ["gay"]):
        for i, word in enumerate(words):
            for other in toxicity.NAMES.get(word, ()):
                if other != word:
                    before = toxicity.text_features(" ".join(words))
                    after = toxicity.text_features(" ".join([*words[:i], other, *words[i + 1:]]))
                    plain.append((before - after, after - before))
    assert found == plain


def test_neutral_mentions_of_groups(spark):
    """Held-out neutral mentions of a group that toxic labels name often are left alone."""
    rows = [(i, f"women are awful vile people n{i}" if i % 2 else f"calm words of rivers n{i}") for i in range(120)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, 0, i % 2) for i, _ in rows], LABELS)
    model = toxicity.train(docs, labels)
    neutral = spark.createDataFrame(
        [(1000 + i, f"{who} went to the market") for i, who in enumerate(["women", "the men", "many women"])], DOCS)
    assert toxicity.scored(neutral, model).agg(F.sum("predicted")).first()[0] == 0
    assert abs(model["weights"].get("women$", 0)) < 0.5 * model["weights"]["awful$"]


def test_long_sentence_without_marks(spark):
    """A long text that names groups sends distinct changes only."""
    text = " ".join(["women", "men", "x"] * 20_000)
    docs = spark.createDataFrame([(i, text if i == 3 else "awful" if i % 2 else "fine") for i in range(60)], DOCS)
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(60)], LABELS)
    assert toxicity.scored(docs, toxicity.train(docs, labels)).count() == 60
