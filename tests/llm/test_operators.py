"""Operators on small frames, against plain versions of the same."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lakework.llm import (
    fingerprints, licenses, mixing, ngram_join, packing, pii, shards, token_files, toxicity,
    vector_dedup,
)
from lakework.llm.components import components

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string"
LONG = "one two three. " * 3000


def words(seed, n):
    random = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in random.integers(0, 5000, n))


ROWS = [
    (0, "Plain text, with words.\nMore of them!", "en", "a", 38, 1, "x"),
    (1, None, "en", "a", None, 1, "x"), (2, "", None, None, 0, None, None),
    (3, LONG, "fr", "b", len(LONG), 1, "x"), (4, words(1, 200), "en", "a", 1, 1, "x"),
    (5, words(1, 200), "en", "a", 1, 1, "x"), (6, words(1, 199) + " changed", "en", "a", 1, 1, "x"),
    (7, "é ü ß 日本 …!? <|endoftext|> x", "de", "b", 9, 1, "x"), (8, " \t\n ", "de", "b", 4, 1, "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Repeated rows, a repeated id and null ids."""
    return spark.createDataFrame(
        [*ROWS, ROWS[0], (4, "other", "en", "a", 5, 1, "x"), (None, "no id", None, None, 1, 1, "x")], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def tokens(text):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def checksum(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_token_files_round_trip(spark, docs, tmp_path):
    token_files.write_tokens(docs, str(tmp_path / "t"), VOCABULARY)
    start = 0
    found = {r["doc_id"]: r for r in token_files.token_digests(spark, str(tmp_path / "t")).collect()}
    for doc_id, text, *_ in ROWS:
        ids, r = tokens(text), found[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), checksum(ids))
        start += len(ids)
    some = token_files.read_tokens(spark, str(tmp_path / "t"), 4, 4).collect()
    assert [list(r["tokens"]) for r in some] == [tokens(ROWS[4][1])]
    assert token_files.token_index(spark, str(tmp_path / "t")).count() == len(ROWS)


def test_token_files_of_odd_and_empty_tables(spark, odd, nothing, tmp_path):
    token_files.write_tokens(odd, str(tmp_path / "o"), VOCABULARY)
    assert token_files.token_digests(spark, str(tmp_path / "o")).count() == len(ROWS) + 3
    token_files.write_tokens(nothing, str(tmp_path / "e"), VOCABULARY)
    assert token_files.token_digests(spark, str(tmp_path / "e")).collect() == []


def test_packing_keeps_every_id_once(docs, odd, nothing):
    rows = packing.pack(docs, VOCABULARY, block=4096).collect()
    sequences = {}
    for doc_id, text, *_ in ROWS:
        ids, at = tokens(text), 0
        for r in sorted((r for r in rows if r["doc_id"] == doc_id), key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == checksum(ids[at:at + r["length"]])
            at += r["length"]
        assert at == len(ids)
    for r in sorted(rows, key=lambda r: r["offset"]):
        assert sequences.get(r["sequence_id"], 0) == r["offset"]
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(sequences.values()) <= packing.WINDOW
    assert packing.pack(odd, VOCABULARY).agg(F.sum("length")).first()[0] > sum(sequences.values())
    assert packing.pack(nothing, VOCABULARY).collect() == []


def test_cuts_are_the_cheapest():
    random = np.random.default_rng(3)
    for _ in range(30):
        size = int(random.integers(1, 40))
        ends = np.array(sorted({*random.integers(1, size + 1, 3).tolist(), size}))
        places, cost = packing.cut_points(size, ends, random.integers(1, size + 1, 4), 3, 2, 5)
        price = dict(zip(places.tolist(), cost.tolist(), strict=True))

        def total(cuts, price=price):
            sizes = np.diff(cuts)
            if (sizes > 8).any():
                return np.inf
            return sum(0 if s & (s - 1) == 0 else 8 - s for s in sizes.tolist()) + sum(
                price[c] for c in cuts[1:])

        inner = places[1:-1].tolist()[:11]
        if len(places) - 2 > 11:
            continue
        every = [[0, *some, size] for k in range(len(inner) + 1)
                 for some in itertools.combinations(inner, k)]
        found = packing.best_cuts(places, cost, 8)
        assert total(found.tolist()) == min(map(total, every))


def brute_classes(rows, size, percent):
    sets = {}
    for doc_id, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] = {tuple(found[i:i + size]) for i in range(len(found) - size + 1)} or (
            {tuple(found)} if found else set())
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * len(sets[a] | sets[b]):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {(d, len(s), root(d)) for d, s in sets.items()}


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (1, 70)])
def test_near_classes(spark, size, percent):
    random = np.random.default_rng(size)
    rows = [(i, r[1]) for i, r in enumerate(ROWS)]
    for group in range(12):
        base = words(group, int(random.integers(3, 160))).split()
        for _ in range(8):
            copy = list(base)
            for _ in range(int(random.integers(0, 1 + len(base) // 25))):
                copy[int(random.integers(0, len(copy)))] = f"n{random.integers(0, 9)}"
            rows.append((len(rows), " ".join(copy[:len(copy) - int(random.integers(0, 4))])))
    found = ngram_join.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), size, percent)
    assert {tuple(r) for r in found.collect()} == brute_classes(rows, size, percent)


def test_near_classes_with_a_shared_passage(spark):
    """Texts around one passage, of which a few are near copies and most are not."""
    passage = words(77, 60)
    rows = [(i, f"{words(1000 + i, 5 + i % 90)} {passage} {words(5000 + i, i % 7)}") for i in range(120)]
    rows += [(200 + i, rows[i][1] + " more") for i in range(0, 120, 9)]
    rows += [(400 + i, passage + f" end {i % 3}") for i in range(9)]
    found = ngram_join.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80)
    assert {tuple(r) for r in found.collect()} == brute_classes(rows, 5, 80)


def test_near_classes_of_odd_and_empty_tables(odd, nothing):
    found = ngram_join.near_classes(odd).collect()
    assert sorted(r["doc_id"] for r in found) == [r[0] for r in ROWS]
    assert ngram_join.near_classes(nothing).collect() == []


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (None, 3)]
    found = dict(components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def vectors(spark, extra=()):
    random = np.random.default_rng(5)
    rows = []
    for i in range(400):
        v = random.standard_normal(16)
        rows.append((len(rows), v.tolist(), i % 3))
        for _ in range(i % 4):
            rows.append((len(rows), (v + random.standard_normal(16) * 0.2).tolist(), i % 3))
    rows += [(len(rows) + i, v, label) for i, (v, label) in enumerate([
        (None, 0), ([0.0] * 16, 0), ([float("nan")] * 16, 0), ([1.0, None], 0), ([], 0),
        (rows[0][1], None), (rows[0][1], rows[0][2]), ([float("inf")] + [1.0] * 15, 1)])]
    return rows, spark.createDataFrame([*rows, *extra], "vec_id long, embedding array<float>, label int")


def test_near_vectors_recall(spark):
    rows, table = vectors(spark)
    found = {r["vec_id"]: r for r in vector_dedup.near_vectors(table).collect()}
    links = dict.fromkeys(found, 0)
    good = [(i, np.array(np.float32(v), dtype=float), k) for i, v, k in rows
            if k is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    for (i, u, k), (j, v, m) in itertools.combinations(good, 2):
        if k == m and u @ v / np.sqrt((u @ u) * (v @ v)) >= 0.93:
            links[i] += 1
            links[j] += 1
    assert len(found) == len(rows)
    assert all(found[i]["n_links"] <= links[i] for i in links)  # none below the threshold
    assert sum(r["n_links"] for r in found.values()) >= 0.9 * sum(links.values())
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())
    assert vector_dedup.recall_bound(0.93) >= 0.95
    assert vector_dedup.near_vectors(table.limit(0)).collect() == []


def test_links_are_summed_per_vector():
    random = np.random.default_rng(3)
    pairs = np.array(sorted({(int(a), int(b)) for a, b in random.integers(0, 60, (45, 2)) if a < b}))
    a, b = pairs.T * 10
    nodes, others, roots = vector_dedup.summed(a, b, a + 1, b + 1)
    parent = {int(x): int(x) for x in nodes}
    for _ in nodes:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            parent[x] = parent[y] = min(parent[x], parent[y])
    assert dict(zip(nodes.tolist(), roots.tolist(), strict=True)) == parent
    for x, n in zip(nodes, others, strict=True):
        assert n == (b[a == x] + 1).sum() + (a[b == x] + 1).sum()


def test_estimates_are_unbiased():
    random = np.random.default_rng(1)
    u = random.standard_normal((300, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    turned, signs, factors = vector_dedup.coded(u)
    guess, spread = vector_dedup.estimates(turned, signs, factors)
    off = guess - u @ u.T
    assert abs(off[~np.eye(300, dtype=bool)].mean()) < 0.005
    assert (np.abs(off) <= vector_dedup.SPREADS * spread).mean() > 0.999


def test_fingerprints(spark, docs, odd, nothing):
    found = {r["doc_id"]: r for r in fingerprints.fingerprints(docs).collect()}
    order = sorted(ROWS, reverse=True, key=lambda r: r[0])
    for i, row in enumerate(order):
        text, after = row[1] or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        r = found[row[0]]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert found[4]["fingerprint"] == found[5]["fingerprint"] != found[3]["fingerprint"]
    assert found[5]["near_next"] == 1.0 and found[6]["near_next"] > 0.9
    assert found[1]["fingerprint"] == "" and found[2]["near_next"] == 1.0
    assert fingerprints.fingerprints(odd).count() == len(ROWS) + 3
    assert fingerprints.fingerprints(nothing).collect() == []


def test_hilbert_neighbours(spark):
    cells = spark.createDataFrame(list(itertools.product(range(4), repeat=3)), "x int, y int, z int")
    for name in ("x", "y", "z"):
        cells = cells.withColumn(f"a{name}", F.col(name))
    rows = shards.hilbert_index(cells, ["ax", "ay", "az"], bits=2).orderBy("curve").collect()
    assert [r["curve"] for r in rows] == list(range(64))
    for a, b in itertools.pairwise(rows):
        assert sum(abs(a[k] - b[k]) for k in "xyz") == 1


def test_hilbert_shards(docs, odd, nothing):
    by = ["source", "lang", "n_chars", "doc_id"]
    rows = shards.hilbert_shards(odd, by, 4).collect()
    counts = [sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(4)]
    assert all(c == list(range(len(c))) for c in counts)
    assert max(map(len, counts)) - min(map(len, counts)) <= 1
    for r in shards.hilbert_shards(docs, by, 4).collect():
        text = (ROWS[r["doc_id"]][1] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 1, zlib.crc32(text))
    assert shards.hilbert_shards(nothing, by, 4).collect() == []


def test_licences(spark, nothing):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
           " and associated documentation files (the Software).\nThe above copyright notice and this"
           " permission notice shall be included in all copies or substantial portions of the Software.\n"
           "Something else.\nTHE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND.")
    rows = [(1, "Words. Released under the MIT License. More."), (2, mit), (3, None), (4, ""),
            (5, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License."),
            (6, mit.replace("Something else.", "A.\nB.\nC.\nD.")), (7, "licence " * 5000)]
    found = {r[0]: tuple(r)[1:] for r in licenses.licences(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: ("MIT", 1, 0), 2: ("MIT", 1, 0), 3: ("", 0, 0), 4: ("", 0, 0),
                     5: ("Apache-2.0,MIT", 2, 0), 6: ("", 0, 3), 7: ("", 0, 0)}
    assert licenses.licences(nothing).collect() == []


def test_personal_data(spark, odd, nothing):
    card = "4532015112830366"
    rows = [(1, f"a.b@c.org and 1.2.3.4, {card}; +1 (743) 555-3824"), (2, None), (3, "300.1.1.1 1234567812345678"),
            (4, "a@b.c._x@d.e 4532 0151 1283 0366"), (5, "9" * 30_000 + " " + "a." * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.personal_data(docs).collect()}
    assert [found[1][f"n_{k}"] for k in pii.KINDS] == [1, 1, 1, 1]
    assert [found[3][f"n_{k}"] for k in pii.KINDS] == [0, 0, 0, 0]
    assert [found[4][f"n_{k}"] for k in pii.KINDS] == [2, 0, 1, 0]
    spans = "email:0:9,ip:14:21,card:23:39,phone:41:58"
    assert found[1]["spans"] == spans
    assert found[1]["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
    clean = {r["doc_id"]: r["text"] for r in pii.redact(docs, ["doc_id", "text"]).collect()}
    assert clean[1] == "[EMAIL] and [IP], [CARD]; [PHONE]" and clean[2] is None
    assert pii.personal_data(odd).count() == len(ROWS) + 3
    assert pii.personal_data(nothing).collect() == []


def test_reliabilities_find_the_good_labelers():
    strong = {(0, 1 + 3 + 9 + 27 * 2 + 81 * 2): 500, (0, 0 + 0 + 9 + 27 * 2 + 81 * 0): 300}
    _, posterior = pii.reliabilities(strong)
    assert posterior[0, 1 + 3 + 9 + 54 + 162] > 0.9 and posterior[0, 9 + 54] < 0.1


def test_raking_meets_all_marginals(spark, docs, odd, nothing):
    cells = spark.createDataFrame(
        [(s, g, float(1 + 3 * s + g * s)) for s in range(4) for g in range(3)], "s int, g int, tokens double")
    targets = {"s": {0: 0.4, 1: 0.3, 2: 0.2, 3: 0.1}, "g": {0: 0.2, 1: 0.2, 2: 0.6}}
    rows = mixing.rake(cells, ["s", "g"], targets).collect()
    for dim, wanted in targets.items():
        for value, share in wanted.items():
            assert abs(sum(r["weight"] for r in rows if r[dim] == value) - share) < 1e-5
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(ROWS) + 3 and all(0 <= r["probability"] <= 1 for r in rows)
    assert mixing.mix(nothing).collect() == []


def test_swaps_are_penalised():
    rows, labels = [[0, 1]] * 20 + [[2]] * 20 + [[0, 3]] * 3, [1] * 20 + [0] * 20 + [0] * 3
    free = toxicity.fit(rows, labels, [], 4)
    held = toxicity.fit(rows, labels, [([0], [3])] * 50, 4)
    assert abs(held[0] - held[3]) < abs(free[0] - free[3])


def test_toxicity_on_held_out_rows(spark, odd, nothing):
    folder = "/root/testdata/sf0.1"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.train(documents, labels)
    rows = toxicity.scored(documents, model).join(labels, "doc_id").where("held_out").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.01
    assert toxicity.scored(odd, model).count() == len(ROWS) + 3
    assert toxicity.scored(nothing, toxicity.train(nothing, labels)).collect() == []


def test_pipeline(spark, tmp_path):
    text = "Gentle words about nothing in particular, number {} of many others we keep."
    rows = [(i, text.format(" ".join(f"k{i}x{j}" for j in range(40))), "en", "a", 100) for i in range(6)]
    rows += [(6, rows[0][1], "en", "a", 100), (7, None, None, None, None), (8, "mail a@b.org", "en", "b", 12)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        kept[name] = docs
    assert {r[0] for r in kept["toxicity"].collect()} == set(range(9))
    assert {r["doc_id"] for r in kept["near_copies"].collect()} == {0, 1, 2, 3, 4, 5, 7, 8}
    redacted = {r["doc_id"]: r for r in kept["personal_data"].collect()}
    assert redacted[8]["text"] == "mail [EMAIL]" and redacted[8]["n_chars"] == 12
    assert kept["personal_data"].columns == corpus_pipeline.COLUMNS
    drawn = {r["doc_id"] for r in kept["mixing"].collect()}
    assert drawn and {r["doc_id"] for r in kept["packing"].collect()} == drawn


def test_near_copies_lose_no_other_text(spark):
    text = lambda k: " ".join(f"{k}x{j}" for j in range(40))
    rows = [
        (1, text("a")), (1, text("b")), (2, None), (2, text("c")), (3, ""), (3, text("d")),
        (4, text("e")), (4, text("e")), (None, text("f")), (None, text("a")), (5, text("b") + " more"),
        (None, text("g")), (None, text("g")), (0, text("d")), (6, None), (6, None)]
    docs = spark.createDataFrame(
        [(i, t, "en", "a", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.remove_near_copies(spark, docs, None)
    assert kept.columns == corpus_pipeline.COLUMNS
    assert sorted(((r[0], r[1]) for r in kept.collect()), key=repr) == sorted([
        (1, text("a")), (1, text("b")), (2, None), (2, text("c")), (3, ""), (0, text("d")),
        (4, text("e")), (None, text("f")), (None, text("g")), (6, None), (6, None)], key=repr)


def test_a_stray_source_hardly_changes_the_mix(spark):
    rows = [(i, words(i, 100), "en" if i % 3 else "fr", "hot" if i % 3 == 1 else f"s{i % 19}", 1)
            for i in range(600)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rated = [mixing.mix(spark.createDataFrame(r, schema)).collect() for r in (
        rows, [*rows, (600, "w12", "en", "stray", None)])]
    kept = [sum(r["probability"] for r in found if r["source"] != "stray") / 600 for found in rated]
    assert kept[0] > 0.9 and abs(kept[0] - kept[1]) < 0.01
    for found in rated:
        tokens = sum(r["tokens"] for r in found)
        assert abs(sum(r["rate"] * r["tokens"] for r in found) - tokens) < 1e-3 * tokens
        assert abs(sum(r["copies"] * r["tokens"] for r in found) - tokens) < 0.1 * tokens
        own, got = {}, {}
        for r in found:
            own[r["source"]] = own.get(r["source"], 0) + r["tokens"]
            got[r["source"]] = got.get(r["source"], 0) + r["rate"] * r["tokens"]
        norm = sum((n / tokens) ** 0.9 for n in own.values())
        for source, n in own.items():
            assert abs(got[source] / tokens - (n / tokens) ** 0.9 / norm) < 1e-4
    stray = next(r for r in rated[1] if r["source"] == "stray")
    assert stray["rate"] > 1 and stray["copies"] in (int(stray["rate"]), int(stray["rate"]) + 1)
    few = mixing.mix(spark.createDataFrame(rows, schema), budget=6060).collect()
    assert abs(sum(r["rate"] * r["tokens"] for r in few) - 6060) < 10


def licences_of(spark, texts):
    rows = licenses.licences(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    return [r["licences"] for r in rows.orderBy("doc_id").collect()]


def test_licences_of_ordinary_notices(spark):
    notices = {
        "This project is licensed under the MIT License.": "MIT",
        "This software is released under the MIT license.": "MIT",
        "The code is distributed under the terms of the MIT licence (see LICENSE).": "MIT",
        "This program is licensed under the GNU General Public License version 3.": "GPL-3.0",
        "This work is licensed under the GNU General Public License, version 3 or later.": "GPL-3.0",
        "Released under the GPLv2.": "GPL-2.0",
        "Our tool is available under version 2 of the GNU General Public License only.": "GPL-2.0",
        "This file is licensed under the Apache License, Version 2.0 (the License).": "Apache-2.0",
        "The library is provided under the Apache-2.0 license.": "Apache-2.0",
        "The package is licensed under the 3-Clause BSD License, see the file COPYING.": "BSD",
        "It is licensed under the GNU Lesser General Public License v2.1 or later.": "LGPL",
        "Distributed under the terms of the GNU Affero General Public License, version 3.": "AGPL",
        "These pictures are licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.":
            "CC-BY-SA-4.0",
        "Licensed under either the Apache License, Version 2.0 or the MIT license at your option.": "Apache-2.0,MIT",
        "This project is not licensed under the MIT License.": "",
        "A licence is a permission, and MIT is a school.": "",
        "Licensed under the GNU General Public License version 2.1.": "",
    }
    assert dict(zip(notices, licences_of(spark, notices), strict=True)) == notices


def test_sql_of_licences_is_as_registered():
    assert hashlib.sha256(licenses.licences_sql().encode()).hexdigest() == "1c1aca3e77f953e6452102d5670cc3605265c1352d92c3d487bf0c2759624ef6"


# The standard public notices that must be recognised.
MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY ARE DISCLAIMED."""
BSD3 = BSD2.replace("THIS SOFTWARE", """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE""")
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this file,
You can obtain one."""


def test_licences_of_wrapped_notices(spark):
    notices = {"MIT": MIT, "BSD-2-Clause": BSD2, "BSD-3-Clause": BSD3, "Apache-2.0": APACHE, "GPL": GPL,
               "MPL-2.0": MPL, "All-Rights-Reserved": "Some words.  All  Rights\nReserved"}
    for leader in ("", " * ", "# ", "// ", "    "):
        for end in ("\n", "\r\n"):
            texts = [end.join((leader + line).rstrip() for line in n.split("\n")) for n in notices.values()]
            assert licences_of(spark, texts) == list(notices)
    found = licenses.licences(spark.createDataFrame([(1, MIT), (2, BSD3)], "doc_id long, text string"))
    assert sorted(tuple(r)[1:3] for r in found.collect()) == [("BSD-3-Clause", 1), ("MIT", 1)]
    assert licences_of(spark, ["// SPDX-License-Identifier: MIT\n// Copyright 2020 Some One"]) == ["MIT"]


def test_fingerprints_are_generalised_jaccard(spark):
    random = np.random.default_rng(5)
    skewed = lambda k: " ".join(["the"] * 200 + [f"{k}w{i}" for i in range(100)])
    texts = [skewed(k) for k in range(30)]
    for k in range(400):
        base = [f"k{k}y{x}" for x in random.integers(0, 6, 9)]
        texts += [" ".join(base), " ".join(base[:6] + [f"k{k}z{x}" for x in random.integers(0, 3, 3)])]
    # The next document is the one before in this list.
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in fingerprints.fingerprints(docs).collect()}

    def jaccard(a, b):
        a, b = Counter(a.split()), Counter(b.split())
        return sum((a & b).values()) / sum((a | b).values())

    def off(ids, name, other):
        return np.array([rows[i][name] - jaccard(texts[i], other(i)) for i in ids])

    edit = lambda i: texts[i][:len(texts[i]) - len(texts[i]) // 3] + texts[i - 1][:len(texts[i]) // 3]
    before = lambda i: texts[i - 1]
    pairs = range(31, len(texts), 2)
    for found in (off(range(1, 30), "near_next", before), off(range(1, 30), "near_edited", edit),
                  off(pairs, "near_next", before), off(pairs, "near_edited", edit)):
        assert abs(found.mean()) < 4 * 0.5 / np.sqrt(64 * len(found)) + 1e-3, found.mean()
        assert np.abs(found).max() < 5 * 0.5 / np.sqrt(64)
    assert {len(r["fingerprint"]) for r in rows.values()} == {6 * fingerprints.SAMPLES}


def test_fingerprints_fold_words_within_a_row(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "SAMPLES", 4)
    docs = spark.createDataFrame([(i, f"w{i} w w") for i in range(4)], "doc_id long, text string")
    plan = fingerprints.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Aggregate\(keys=\[([^\]]*)\]", plan)
    # An aggregate by words would hold those of all documents of a task at once.
    assert keys and not [k for k in keys if "word" in k], keys


def test_draws_shared_by_several_texts_are_those_of_each_text(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "SAMPLES", 8)
    rows = [(0, "a b b c c c", "c B a b c c d", "x"), (1, "a a", "a", "A a"), (2, None, " ", "a b"),
            (3, "", None, None), (4, words(2, 300), words(2, 200) + " w1 w1", words(3, 40)),
            (None, "a b", "b a", "a b b")]
    texts = spark.createDataFrame(rows, "row long, one string, two string, three string")
    names = ["one", "two", "three"]

    def of(names):
        found = fingerprints.fingerprints_of(texts, ["row"], {f"of_{n}": F.col(n) for n in names}).collect()
        assert len(found) == len(rows)
        return {r["row"]: r for r in found}

    together = of(names)
    for name in names:
        alone = of([name])
        for row in together:
            assert together[row][f"of_{name}"] == alone[row][f"of_{name}"], (row, name)
    assert together[None]["of_one"] == together[None]["of_two"] != together[None]["of_three"]
    assert together[1]["of_one"] == together[1]["of_three"] and len(together[1]["of_two"]) == 8
    assert together[2]["of_one"] == together[2]["of_two"] == together[3]["of_three"] == []
