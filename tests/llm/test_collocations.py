"""Collocations against plain counting, and the tries against plain dictionaries."""

import re
from collections import Counter

import numpy as np
import pytest

from lakework.llm import collocations as col

SCHEMA = "doc_id long, text string, lang string, phrase string, n string"


def pieces(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", text)]


def counts(rows):
    """Totals per language, and occurrences of each phrase (language, words)."""
    totals, found = Counter(), Counter()
    for text, lang in rows:
        for words in pieces(text):
            totals["und" if lang is None else lang] += len(words)
            for k in range(1, 6):
                found.update(("und" if lang is None else lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    return totals, found


def plain(rows, least, top):
    totals, found = counts(rows)
    often = {p: n for p, n in found.items() if n >= least}
    scored = []
    for (lang, words), a in often.items():
        if len(words) > 1:
            score, k, left, right = min(
                (1000 * a * totals[lang] // (often[lang, words[:k]] * often[lang, words[k:]]), k,
                 often[lang, words[:k]], often[lang, words[k:]]) for k in range(1, len(words)))
            longer = [n for (other, w), n in often.items() if other == lang and len(w) > len(words) and any(
                w[i:i + len(words)] == words for i in range(len(w) - len(words) + 1))]
            if not longer or 100 * max(longer) < 100 * a:
                scored.append((lang, -score, -a, " ".join(words).encode(), left, right))
    rank, result = Counter(), []
    for lang, score, a, phrase, left, right in sorted(scored):
        rank[lang] += 1
        if rank[lang] <= top:
            result.append((lang, rank[lang], phrase.decode(), -a, left, right, totals[lang], -score))
    return result


def texts(n=60, seed=3):
    random = np.random.default_rng(seed)
    names = ["the", "of", "New", "York", "city", "état", "a", "b", "c", "d\x1ce"]
    for i in range(n):
        words = [names[j] for j in random.zipf(1.4, 40) % len(names)]
        marks = random.choice([" ", "  ", "\t", ", ", ".\n", " ! ", "\x0b"], 40, p=[.7, .05, .05, .05, .05, .05, .05])
        yield i, "".join(w + m for w, m in zip(words, marks)), ["en", None, ""][i % 3], "x", "y"


@pytest.mark.parametrize("top", [5, 2000])
def test_against_plain_counting(spark, top):
    rows = [*texts(), (None, None, "fr", "x", "y"), (1, "", "fr", "x", "y"), *list(texts())[:5],
            (9, "a a a a a a a a . " * 20, "rep", "", ""), (9, "one two three four five six " * 9, "long", "", "")]
    got = col.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), top=top, least=4)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain([(r[1], r[2]) for r in rows], 4, top)
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 9


def test_scores_beyond_64_bits(spark, monkeypatch):
    """Exact where the product passes 2^64."""
    big = 3_000_000_019
    frequent = spark.createDataFrame(
        [("en", "a", 1, big), ("en", "b", 1, big - 2), ("en", "a b", 2, big - 5)],
        "lang string, phrase string, words int, n long")
    totals = spark.createDataFrame([("en", 7 * 10**14 + 1)], "lang string, total long")
    monkeypatch.setattr(col, "phrase_counts", lambda docs, least: (totals, frequent))
    row = col.collocations(frequent).first()
    assert row["score"] == 1000 * (big - 5) * (7 * 10**14 + 1) // (big * (big - 2))


def test_empty_and_rare(spark):
    assert col.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert col.collocations(spark.createDataFrame(list(texts(3)), SCHEMA)).collect() == []


@pytest.mark.parametrize("held, burst, slice_, numbered", [(10**6, 10**4, 1 << 19, 1 << 20), (40, 3, 50, 8)])
def test_tries_that_burst_spill_and_renumber(monkeypatch, held, burst, slice_, numbered):
    for name, value in {"HELD": held, "BURST": burst, "SLICE": slice_, "NUMBERED": numbered}.items():
        monkeypatch.setattr(col, name, value)
    rows = [(t, lang) for _, t, lang, _, _ in texts(40)]
    _, want = counts(rows)
    for bits, lengths in ((None, {1}), (np.full(1 << 12, 255, np.uint8), {2, 3, 4, 5})):
        counter, got, runs = col.Counter(bits), Counter(), 0
        for text, lang in rows:
            tokens = (text.encode() + b"\xff").translate(col._TABLE).replace(b"\xff", b" \xff ").split()
            batches = list(counter.count(("und" if lang is None else lang).encode(), tokens))
            runs += bool(batches)
            for batch in [*batches, *(counter.spill(0) if text is rows[-1][0] else [])]:
                for r in batch.to_pylist():
                    words = tuple(r["phrase"].split(" "))
                    assert r["head"] == " ".join(words[:2]) and r["block"] is None
                    got[r["lang"], words] += r["n"]
        assert got == {p: n for p, n in want.items() if len(p[1]) in lengths}
        assert (runs > 0) == (held == 40)


def test_runs_are_sorted():
    counter = col.Counter(np.full(1 << 12, 255, np.uint8))
    list(counter.count(b"en", [b"b", b"a", b"b", b"c", b"a", b"b"]))
    run = [r["phrase"] for batch in counter.spill(0) for r in batch.to_pylist()]
    assert [p for p in run if p.count(" ") == 1] == ["a b", "b a", "b c", "c a"]


@pytest.mark.parametrize("least", [100, 3])
def test_bitmap_lets_frequent_pairs_through_and_few_others(spark, least):
    """Pairs that are frequent in all tasks together, but in none alone."""
    rare = [b"r%d" % i for i in range(6000)]
    rows = []
    for task in range(4):
        counter = col.Counter(None, least)
        list(counter.count(b"en", [b"new", b"york", b"\xff"] * (-(-least // 4)) + rare[task::4]))
        rows += [tuple(bytearray(v) if isinstance(v, bytes) else v for v in list(r.values())[4:])
                 for b in counter.packed() for r in b.to_pylist()]
    packed = spark.createDataFrame(rows, col.BLOCKS)
    seed = col._hash_of_lang(b"en")
    hashed = lambda a, b: col.pair_hashes(seed, col.word_hashes([a]), col.word_hashes([b]))
    found = packed.orderBy("block").mapInArrow(col._often(least), "hash long").collect()
    assert [r[0] for r in found] == [int(hashed(b"new", b"york")[0])]
    tester = col.Counter(col._bitmap(packed, least))
    assert tester._passes(hashed(b"new", b"york")).all()
    others = np.concatenate([hashed(a, b) for a, b in zip(rare, rare[1:])])
    assert tester._passes(others).mean() < 0.01
