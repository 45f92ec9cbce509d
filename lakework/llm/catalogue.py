"""One query per operator over its whole table, and SQL where it can say the same."""

import public_tokenizers

from lakework.llm import (
    alignment, collocations, fingerprints, licenses, mixing, ngram_join, packing, pii,
    repetition, shards, token_files, toxicity, vector_dedup,
)
from lakework.scratch import scratch_path
from lakework.sources.tables import read_table

QUERIES = {}
ORACLES = {}


def query(sql=None):
    """Register a ``(spark, folder) -> DataFrame`` function under its own name."""
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function
    return register


def vocabulary():
    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op4_packing(spark, folder):
    return packing.pack(read_table(spark, folder, "documents"), vocabulary())


@query(r"""
    with recursive words as (
        select doc_id, list_filter(regexp_split_to_array(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
        from documents),
    sets as (
        select doc_id, list_distinct(case
            when w is null or len(w) = 0 then []
            when len(w) < 3 then [list_aggregate(w, 'string_agg', ' ')]
            else list_transform(range(1, len(w) - 1),
                lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as s
        from words),
    sized as (select doc_id, s, len(s) as n from sets),
    tokens as (select doc_id, n, unnest(s) as t from sized),
    links as (
        select a.doc_id as a, b.doc_id as b
        from tokens a join tokens b on a.t = b.t and a.doc_id < b.doc_id
            and 10 * a.n >= 9 * b.n and 10 * b.n >= 9 * a.n
        group by a.doc_id, b.doc_id, a.n, b.n
        having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
    ends as (select a, b from links union select b, a from links),
    reached(node, other) as (
        select doc_id, doc_id from sized
        union select r.node, e.b from reached r join ends e on r.other = e.a)
    select s.doc_id, s.n::bigint as n_shingles, min(r.other) as component_id
    from sized s join reached r on r.node = s.doc_id
    group by s.doc_id, s.n
""")
def op5_ngram_join(spark, folder):
    return ngram_join.near_classes(read_table(spark, folder, "documents"), size=3, percent=90)


@query()
def op7_token_files(spark, folder):
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(read_table(spark, folder, "documents"), path, vocabulary())
    return token_files.token_digests(spark, path)


@query()
def op9_fingerprints(spark, folder):
    return fingerprints.fingerprints(read_table(spark, folder, "documents"))


@query("""
    with recursive usable as (
        select vec_id, label, embedding::double[] as e from embeddings
        where label is not null and embedding is not null and len(embedding) > 0
            and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
            and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
    links as (
        select a.vec_id as a, b.vec_id as b from usable a join usable b
        on a.label = b.label and a.vec_id < b.vec_id and len(a.e) = len(b.e)
            and list_cosine_similarity(a.e, b.e) >= 0.93),
    ends as (select a, b from links union select b, a from links),
    reached(node, other) as (
        select vec_id, vec_id from embeddings
        union select r.node, e.b from reached r join ends e on r.other = e.a)
    select v.vec_id, (select count(*) from ends where a = v.vec_id) as n_links,
        min(r.other) as component_id, v.vec_id = min(r.other) as kept
    from embeddings v join reached r on r.node = v.vec_id
    group by v.vec_id
""")
def op10_vector_dedup(spark, folder):
    return vector_dedup.near_vectors(read_table(spark, folder, "embeddings"))


@query()
def op1_hilbert_shards(spark, folder):
    return shards.hilbert_shards(
        read_table(spark, folder, "documents"), ["source", "lang", "n_chars", "doc_id"], shards=8)


@query()
def op8_mixing(spark, folder):
    return mixing.mix(read_table(spark, folder, "documents"))


@query()
def op8_mixing_targets(spark, folder):
    """Given shares of languages and kinds of text; sources keep the powers of their own."""
    return mixing.mix(read_table(spark, folder, "documents"), targets={
        "lang": {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2},
        "topic": {"prose": 0.9, "numbers": 0.04, "symbols": 0.03, "table": 0.03}})


@query(licenses.licences_sql())
def op3_licences(spark, folder):
    return licenses.licences(read_table(spark, folder, "documents"))


@query()
def op6_personal_data(spark, folder):
    return pii.personal_data(read_table(spark, folder, "documents"))


@query()
def op2_toxicity(spark, folder):
    documents = read_table(spark, folder, "documents")
    return toxicity.scored(documents, toxicity.train(documents, read_table(spark, folder, "labels")))


@query(repetition.quality_sql())
def op11_repetition(spark, folder):
    return repetition.quality(read_table(spark, folder, "documents"))


@query()
def op13_alignment(spark, folder):
    return alignment.alignment(
        read_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"))


@query(collocations.collocations_sql())
def op12_collocations(spark, folder):
    return collocations.collocations(read_table(spark, folder, "documents"))
