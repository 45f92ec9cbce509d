"""Repetition rules against a plain version, on odd texts and by their SQL."""

import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from lakework.llm import repetition as rep

SCHEMA = "doc_id long, text string, n_words string, kept int"
random = np.random.default_rng(7)
PROSE = " ".join(f"w{x}" for x in random.integers(0, 3000, 400))
TEXTS = [
    None, "", " \n\t ", "one", "a b a b a b", "x y z " * 40, PROSE, PROSE + "\n" + PROSE, "\n".join(["same line here"] * 30),
    PROSE + "\nHEAD LINE\n" + PROSE[:200] + "\nHEAD LINE", "é ü 日本 😀 " * 30, "a" * 9000 + " " + "b " * 3000,
    "# * $ % & | < > ^ " * 10, "one word\x1cstill one\x0btwo\x0cthree", "line\r\nline\r\nline \nline", "The the THE " * 20,
    " ".join(f"u{i}" for i in range(49)), " ".join(f"u{i}" for i in range(50)),
]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    seen, again = set(), []
    for line in lines:
        again += [line] if line in seen else []
        seen.add(line)
    row = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_chars": len(text), "n_lines": len(lines),
           "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": len(again),
           "dup_line_chars": sum(map(len, again))}
    for n in sorted({*rep.MAX_TOP, *rep.MAX_COVERED, 3}):
        grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        times, seen, twice, later = Counter(grams), set(), set(), set()
        for i, g in enumerate(grams):
            twice.update(range(i, i + n) if times[g] > 1 else [])
            later.update(range(i, i + n) if g in seen else [])
            seen.add(g)
        if n == 3:
            row["n_repeat_words"] = len(twice)
        if n in rep.MAX_TOP:
            row[f"top_{n}_chars"] = max((c * sum(map(len, g)) for g, c in times.items() if c > 1), default=0)
        if n in rep.MAX_COVERED:
            row[f"dup_{n}_chars"] = sum(len(words[i]) for i in later)
    row["base_failed"] = len(words) < 50 or 100 * row["n_repeat_words"] > 50 * len(words)
    row["kept"] = not row["base_failed"] and not (
        100 * row["n_dup_lines"] > 30 * row["n_lines"] or 100 * row["dup_line_chars"] > 20 * row["n_chars"]
        or any(100 * row[f"top_{n}_chars"] > p * row["word_chars"] for n, p in rep.MAX_TOP.items())
        or any(100 * row[f"dup_{n}_chars"] > p * row["word_chars"] for n, p in rep.MAX_COVERED.items()))
    return row


def test_against_plain_counts(spark):
    rows = [(i or None, t, "x", 3) for i, t in enumerate(TEXTS + TEXTS)]
    got = [r.asDict() for r in rep.quality(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()]
    want = [{"doc_id": r[0], **plain(r[1])} for r in rows]
    key = lambda r: repr(sorted(r.items()))
    assert sorted(got, key=key) == sorted(want, key=key)


def test_each_rule_can_reject_and_prose_stays(spark):
    texts = {
        "prose": PROSE, "one repeated passage": PROSE + " " + " ".join(PROSE.split()[:12]),
        "half again": PROSE + " " + " ".join(PROSE.split()[:200]),
        "lines": "\n".join(["short"] * 40) + "\n" + PROSE, "bigram": PROSE[:600] + " very, very" * 25}
    docs = spark.createDataFrame(
        [(i, t, "x", 0) for i, t in enumerate(texts.values())], SCHEMA)
    kept = [r["kept"] for r in rep.quality(docs).orderBy("doc_id").collect()]
    assert dict(zip(texts, kept, strict=True)) == {
        "prose": True, "one repeated passage": True, "half again": False, "lines": False, "bigram": False}


@pytest.mark.parametrize("texts", [TEXTS, []])
def test_sql_on_odd_texts(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    if rows:
        con.executemany("insert into documents values (?, ?)", rows)
    want = con.sql(rep.quality_sql()).df().sort_values("doc_id")
    got = rep.quality(spark.createDataFrame(rows, "doc_id long, text string")).toPandas().sort_values("doc_id")
    assert sorted(want.columns) == sorted(got.columns)
    assert got[sorted(got.columns)].values.tolist() == want[sorted(got.columns)].values.tolist()
