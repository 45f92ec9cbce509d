"""Operators over whole given tables against plain versions, and odd tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakework.llm import (
    fingerprints, licenses, mixing, ngram_join, packing, pii, shards, token_files, vector_dedup,
)
from lakework.llm.catalogue import QUERIES, vocabulary

SMALL = "/root/testdata/sf0.01"


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_spans(text):
    """Base spans by the plain patterns, kinds as listed, by start."""
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(re.sub(r"\D", "", s)) <= 19 and luhn(re.sub(r"\D", "", s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(re.sub(r"\D", "", s)) <= 15),
    ]
    return [(kind, m.start(), m.end()) for kind, pattern, fits in kinds
            for m in re.finditer(pattern, text, re.ASCII) if fits(m.group())]


def test_base_spans_of_all_documents(spark):
    texts = dict(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op6_personal_data"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    seen = Counter()
    for r in rows:
        spans = plain_spans(texts[r["doc_id"]] or "")
        for kind in pii.KINDS:
            assert r[f"n_{kind}"] == sum(k == kind for k, _, _ in spans)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r["spans"].split(","))
        seen.update(k for k, _, _ in spans)
    assert min(seen[k] for k in pii.KINDS) > 0


def test_shards_are_runs_of_a_plain_sort_and_skip_by_minimum_and_maximum(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = QUERIES["op1_hilbert_shards"](spark, SMALL).collect()
    texts = {r["doc_id"]: r for r in docs.collect()}
    ordered = sorted(rows, key=lambda r: (r["curve"], r["doc_id"], r["size"], r["text_crc32"]))
    n = len(ordered)
    slots = Counter()
    for rank, r in enumerate(ordered):
        assert r["shard"] == rank * 8 // n and r["slot"] == slots[r["shard"]]
        slots[r["shard"]] += 1
        data = (texts[r["doc_id"]]["text"] or "").encode()
        assert r["size"] == len(data) + 1 and r["text_crc32"] == zlib.crc32(data)
    assert max(slots.values()) - min(slots.values()) <= 1
    # Of the shards that a reader of one source or one language would open, the curve leaves out some.
    for column, most in (("lang", 6.5), ("source", 6.5)):
        span = defaultdict(list)
        for r in rows:
            span[r["shard"]].append(texts[r["doc_id"]][column])
        wanted = sorted({texts[r["doc_id"]][column] for r in rows})
        opened = [sum(min(v) <= w <= max(v) for v in span.values()) for w in wanted]
        assert np.mean(opened) < most, (column, opened)


def test_sources_with_a_long_common_beginning_and_one_odd_value(spark):
    rows = [(i, "t", "en", f"https://crawl.example.org/segment-{i % 40:02d}", 5) for i in range(800)]
    rows += [(800, "t", "en", "", 5), (801, "t", "en", None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    coded = shards.quantised(docs, ["source"]).select("source", "_axis0").distinct().collect()
    codes = {r["source"]: r["_axis0"] for r in coded}
    assert codes[None] == 0 and len(set(codes.values())) == 16
    known = sorted(s for s in codes if s is not None)
    assert [codes[s] for s in known] == sorted(codes[s] for s in known)


def test_given_targets_are_met_within_the_budget(spark):
    rows = QUERIES["op8_mixing_targets"](spark, SMALL).collect()
    total = sum(r["tokens"] for r in rows)
    cells = {}
    for r in rows:
        cells.setdefault((r["source"], r["lang"], r["topic"]), [r["weight"], 0, r["rate"], r["lacking"]])[1] += r["tokens"]
    assert abs(sum(w for w, *_ in cells.values()) - 1) < 1e-6
    langs = Counter()
    for (_, lang, _), (weight, *_) in cells.items():
        langs[lang] += weight
    for lang, share in {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2}.items():
        assert abs(langs[lang] - share) < 1e-4
    for weight, tokens, rate, lacking in cells.values():
        assert rate <= mixing.MOST_COPIES and abs(rate * tokens + lacking - weight * total) < 1e-3 * total
    drawn = sum(r["copies"] * r["tokens"] for r in rows)
    assert abs(drawn + sum(lacking for *_, lacking in cells.values()) - total) < 0.1 * total
    assert all(r["copies"] <= mixing.MOST_COPIES and (r["copies"] > 0) == r["sampled"] for r in rows)


def test_a_tiny_cell_is_not_repeated_without_bound(spark):
    docs = spark.createDataFrame(
        [(0, "one", "xx", "s", 3), *[(i, "many words " * 50, "en", "s", 3) for i in range(1, 200)]],
        "doc_id long, text string, lang string, source string, n_chars long")
    rows = mixing.mix(docs, targets={"lang": {"xx": 0.2, "en": 0.8}}).collect()
    tiny = next(r for r in rows if r["doc_id"] == 0)
    assert tiny["copies"] == mixing.MOST_COPIES and tiny["lacking"] > 1000


def test_token_files_are_written_as_described(spark, tmp_path):
    """Footers: dictionary for ids, delta for numbers, small row groups, page indexes."""
    path = str(tmp_path / "tokens")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    token_files.write_tokens(docs, path, vocabulary())
    names, groups = Counter(), 0
    for file in tmp_path.glob("tokens/*.parquet"):
        data = pq.ParquetFile(file)
        groups = max(groups, data.metadata.num_row_groups)
        for g in range(data.metadata.num_row_groups):
            group = data.metadata.row_group(g)
            assert group.total_byte_size < 2 * token_files.ROW_GROUP_BYTES
            for c in range(group.num_columns):
                column = group.column(c)
                ids = column.path_in_schema.startswith("tokens")
                assert column.has_dictionary_page == ids, column.path_in_schema
                assert ("DELTA_BINARY_PACKED" in column.encodings) == (not ids), column.encodings
                assert column.has_offset_index and column.has_column_index
                assert column.compression == "ZSTD"
                names[column.path_in_schema] += 1
    assert len(names) == 5
    # A few documents: the reader opens the row groups and pages that hold them.
    some = token_files.read_tokens(spark, path, 100, 102)
    assert sorted(r["doc_id"] for r in some.collect()) == [100, 101, 102]
    found = pq.ParquetFile(next(iter(sorted(tmp_path.glob("tokens/*.parquet")))))
    low = found.metadata.row_group(0).column(0).statistics
    assert low.has_min_max and low.min <= low.max


@pytest.fixture(scope="module")
def clashing(spark):
    """Repeated, null and clashing: the columns that operators make have other meanings here."""
    rows = [(1, "Same text of five words here", "en", "a", 1, "x", 0.5, None, 1)] * 3
    rows += [(None, "no id", None, None, None, None, None, None, None), (2, None, "fr", "b", 2, "y", 1.0, 3, 2),
             (3, "", "fr", "b", 0, "y", 1.0, 3, 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long,"
                                 " shard string, score double, rank long, row long")


@pytest.mark.parametrize("name", [
    "licenses", "fingerprints", "packing", "personal", "mixing", "shards"])
def test_clashing_columns_and_repeated_rows(spark, clashing, name):
    operator = {
        "licenses": licenses.licences, "fingerprints": fingerprints.fingerprints,
        "packing": lambda d: packing.pack(d, vocabulary()), "personal": pii.personal_data,
        "mixing": mixing.mix, "shards": lambda d: shards.hilbert_shards(d, ["source", "n_chars"], 3)}[name]
    plain = clashing.select("doc_id", "text", "lang", "source", "n_chars")
    got, want = (sorted(map(str, operator(d).collect())) for d in (clashing, plain))
    assert got == want and len(got) >= 6
    assert operator(clashing.where("1 = 0")).collect() == []


def test_pipeline_on_an_empty_table_and_with_other_columns(spark, clashing, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, docs, least in (("none", clashing.where("1 = 0"), 0), ("odd", clashing, 3)):
        (tmp_path / name).mkdir()
        for step, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            if step != "packing":
                assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            docs.write.parquet(str(tmp_path / name / step))
            docs = spark.read.parquet(str(tmp_path / name / step))
        assert docs.count() >= least


def test_vectors_with_repeated_and_null_ids_and_a_large_group(spark):
    random = np.random.default_rng(4)
    base = random.normal(size=32)
    near = [(i, (base + random.normal(size=32) * 0.02).tolist(), 1, "x") for i in range(300)]
    rows = [*near, near[5], (None, base.tolist(), 1, "x"), (900, base.tolist(), None, "x"), (901, None, 1, "x")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, n_links string")
    found = {r["vec_id"]: r for r in vector_dedup.near_vectors(vectors).collect()}
    assert {found[i]["component_id"] for i in range(300)} == {0}
    assert found[900]["n_links"] == 0 and found[901]["kept"]


def test_join_with_a_large_group_of_exact_copies(spark):
    rows = [(i, "the very same words in all of these texts") for i in range(3000)]
    rows += [(5000 + i, f"entirely other words number n{i} k{i} j{i} l{i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r["component_id"] for r in ngram_join.near_classes(docs, size=3, percent=90).collect()}
    assert all(found[i] == 0 for i in range(3000)) and all(found[5000 + i] == 5000 + i for i in range(50))
