"""Toxicity scores from a counterfactually regularised classifier.

A logistic model over the words of a text and their beginnings is fitted on a bounded
sample of labelled documents. In labelled sentences that name a group, the name is swapped
for other names of the same kind, and the squared change of the score is penalised. So the
model cannot lean on the name or on words beside it, and a neutral mention of a group does
not raise the score. The penalty is quadratic in the weights and part of each Newton step.
"""

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lakework.llm.common import cut, share_code

#: Labelled documents that the model is fitted on at most, those with the smallest hashes.
MAX_TRAINING = 12_000
#: Features of the model at most, those that tell most.
MAX_FEATURES = 1_000
#: A feature must stand in so many sampled documents, and deviate by so many spreads.
MIN_DOCUMENTS = 6
MIN_SPREADS = 5.0
RIDGE = 0.5
#: Weight of the counterfactual penalty, per swapped sentence.
SWAP_PENALTY = 1.0
#: The score of a text without telling words is at most this, and so is the share of toxic
#: rows that the model is fitted to. Labelled rows are often picked for being toxic: where
#: more are, the others weigh the more.
PRIOR = 0.2
PREFIXES = (4, 5, 6)
HELD_OUT_FOLDS = 5

#: Names of groups; the words of a line can stand for each other.
GROUPS = [
    "women men girls boys", "woman man girl boy", "she he they",
    "muslims christians jews hindus buddhists atheists", "muslim christian jewish hindu buddhist",
    "gay straight lesbian bisexual queer", "transgender cisgender",
    "black white asian latino african european american",
    "immigrants refugees natives citizens", "old young elderly", "disabled deaf blind",
    "femmes hommes filles garçons", "femme homme fille garçon", "musulmans chrétiens juifs",
    "frauen männer mädchen jungen", "frau mann", "muslime christen juden",
    "mujeres hombres niñas niños", "mujer hombre niña niño", "musulmanes cristianos judíos",
]
NAMES = {name: line.split() for line in GROUPS for name in line.split()}

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"[.!?\n]+")


def held_out(doc_id):
    """Whether a document is kept from learning, as a column; null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_FOLDS == 0, F.lit(False))


def word_features(word):
    """A word and its beginnings."""
    return [f"{word}$", *[word[:k] for k in PREFIXES if len(word) >= k]]


def _beside(words):
    """Names of groups together with the words next to them."""
    return {f"{a} {b}" for a, b in zip(words, words[1:], strict=False) if a in NAMES or b in NAMES}


def text_features(text):
    """The set of features of a text."""
    words = _WORD.findall(text.lower())
    found = set()
    for word in set(words):
        found.update(word_features(word))
    return found | _beside(words) if not NAMES.keys().isdisjoint(words) else found


def swapped(text):
    """For each sentence that names a group and each swap of a name: features lost, features won.

    Only the words at the place and its neighbours decide what a swap changes, besides
    features that the sentence has from elsewhere; those are counted, not built anew.
    """
    changes = []
    lowered = text.lower()
    if NAMES.keys().isdisjoint(_WORD.findall(lowered)):
        return changes
    for sentence in _SENTENCE.split(lowered):
        words = _WORD.findall(sentence)
        named = [i for i, word in enumerate(words) if word in NAMES]
        if not named:
            continue
        held = Counter(f for i in range(len(words)) for f in _at(words, i))
        for i in named:
            around = range(max(0, i - 1), i + 1)
            own = Counter(f for j in around for f in _at(words, j))
            for other in NAMES[words[i]]:
                if other != words[i]:
                    changed = [*words[max(0, i - 1):i], other, *words[i + 1:i + 2]]
                    new = {f for j in range(len(around)) for f in _at(changed, j)}
                    lost = {f for f, n in own.items() if held[f] == n and f not in new}
                    changes.append((lost, {f for f in new if f not in held}))
    return changes


def _at(words, i):
    """The features that a word has, and those of it and the next one."""
    return [*word_features(words[i]), *_beside(words[i:i + 2])]


def fit(rows, labels, swaps, size, ridge=RIDGE, swap_penalty=SWAP_PENALTY, steps=25):
    """Weights of ``size`` features and an intercept, last, by Newton steps.

    ``rows``: feature numbers of each document; ``swaps``: feature numbers that swaps lose
    and win, and how many swaps do so (one unless given); scores before and after should agree.
    """
    x = np.zeros((len(rows), size + 1), dtype=np.float32)
    x[:, size] = 1
    for i, found in enumerate(rows):
        x[i, found] = 1
    y = np.asarray(labels, dtype=np.float64)
    share = min((y.sum() + 1) / (len(y) + 2), PRIOR)
    clean = max(1.0, y.sum() * (1 - PRIOR) / PRIOR / max(1.0, len(y) - y.sum()))
    weight = np.where(y > 0, 1.0, clean)
    held = np.full(size + 1, ridge)
    held[size] = 1e-6
    penalty = np.diag(held)
    for lost, won, *times in swaps:
        at = np.array([*lost, *won], dtype=np.int64)
        change = np.repeat((1.0, -1.0), (len(lost), len(won)))
        penalty[np.ix_(at, at)] += swap_penalty * sum(times or [1]) * np.outer(change, change)
    w = np.zeros(size + 1)
    w[size] = np.log(share / (1 - share))

    def loss(w):
        z = x @ w
        return weight @ np.logaddexp(0, z) - y @ z + w @ penalty @ w / 2

    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
        slope = x.T @ (weight * (p - y)) + penalty @ w
        bend = (x * (weight * p * (1 - p))[:, None].astype(np.float32)).T @ x + penalty
        step = np.linalg.solve(bend.astype(np.float64) + 1e-6 * np.eye(size + 1), slope)
        pace = 1.0
        while pace > 1e-3 and loss(w - pace * step) > now:
            pace /= 2
        w = w - pace * step
        before, now = now, loss(w)
        if before - now < 1e-6 * max(1.0, abs(before)):
            break
    return w


def train(docs, labels, max_training=MAX_TRAINING):
    """A model from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``).

    Only labelled rows outside the held-out fold teach; of those, at most ``max_training``
    ids with the smallest hashes. An id with several labels counts as toxic if one is; null
    labels and ids are left out. Without labels of both kinds the model scores all alike,
    and like a text without telling words: ``PRIOR`` at most, whatever the labels' share.
    """
    share_code(docs.sparkSession)
    chosen = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(
        ~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(max_training)
    # At most max_training short rows.
    sample = cut(docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
                 .join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("text", "toxic"),
                 "labelled")
    n, toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    share = min((toxic + 1) / (n + 2), PRIOR)
    blank = {"weights": {}, "intercept": float(np.log(share / (1 - share)))}
    if not 0 < toxic < n:
        return blank

    @F.pandas_udf("array<string>")
    def all_features(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sorted(text_features(t)))

    expected = F.col("n") * (toxic / n)
    spread = F.sqrt(expected * (1 - toxic / n))
    told = (
        sample.select("toxic", F.explode(all_features("text")).alias("feature"))
        .groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic"))
        .where(F.col("n") >= MIN_DOCUMENTS)
        .withColumn("z", F.abs(F.col("toxic") - expected) / spread).where(F.col("z") >= MIN_SPREADS)
        .orderBy(F.col("z").desc(), "feature").limit(MAX_FEATURES).collect())
    number = {r["feature"]: i for i, r in enumerate(told)}
    if not number:
        return blank
    numbers = lambda found: sorted(number[f] for f in found if f in number)

    @F.pandas_udf("array<int>")
    def coded(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: numbers(text_features(t)))

    @F.pandas_udf("array<struct<lost:array<int>,won:array<int>>>")
    def changes(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [
            {"lost": lost, "won": won} for lost, won in (map(numbers, c) for c in swapped(t))
            if lost or won])

    rows = sample.select("toxic", coded("text").alias("own")).collect()
    # Equal changes are counted; how many there are depends on the features, not on the texts.
    swaps = sample.select(F.explode(changes("text")).alias("c")).groupBy("c.lost", "c.won").agg(
        F.count(F.lit(1)).alias("n")).orderBy("lost", "won").collect()
    w = fit([r["own"] for r in rows], [r["toxic"] for r in rows],
            [(s["lost"], s["won"], s["n"]) for s in swaps], len(number))
    most = float(np.log(PRIOR / (1 - PRIOR)))
    return {"weights": {f: float(w[i]) for f, i in number.items()}, "intercept": min(float(w[-1]), most)}


def scorer(model):
    """A column function from texts to scores between 0 and 1; null texts count as empty."""
    weights, intercept = model["weights"], model["intercept"]
    beside = any(" " in f for f in weights)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        known = {}  # words seen in this batch and the features of the model that they have

        def of(text):
            words = _WORD.findall(text.lower()) if text else []
            found = set()
            for word in set(words):
                own = known.get(word)
                if own is None:
                    own = known[word] = tuple(f for f in word_features(word) if f in weights)
                if own:
                    found.update(own)
            if beside and not NAMES.keys().isdisjoint(words):
                found |= _beside(words) & weights.keys()
            return intercept + sum(weights[f] for f in sorted(found))

        return 1 / (1 + np.exp(-texts.map(of, na_action=None).astype("float64").clip(-60, 60)))

    return score


def scored(docs, model):
    """``doc_id, held_out, score, predicted`` (1 from 0.5 on) for every row of ``docs``.

    Each row is scored by its text alone: null and empty texts get the score of no words,
    equal texts equal scores. An empty table gives no rows.
    """
    share_code(docs.sparkSession)
    score = scorer(model)
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        score(F.col("text").cast("string")).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
