from brute import bytes_left, near_classes

import corpus_pipeline
from __spark_entry__ import queries
from leafscore.llm.language_id import UNDETERMINED, fit_languages, held_out, predict
from leafscore.llm.queries import QUERIES
from test_lookups import brute_hits
from test_tokens import RANKS, digests
import tiktoken
import public_tokenizers
from leafscore.llm.tokenizers import read_ranks


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_every_stage_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "suffix_dedup", "decontaminate", "byte_bpe"]

    before = rows_of(docs)
    model = fit_languages(docs.filter(~held_out()))
    names, scores = predict(model, [t for _, t in before])
    want = [r for r, n, s in zip(before, names, scores) if n != UNDETERMINED and s >= 0.35]
    docs = corpus_pipeline.language_id(spark, docs, sf)
    assert docs.columns == columns and sorted(rows_of(docs)) == sorted(want)

    classes = near_classes(want)
    want = [(d, t) for d, t in want if classes[d] == d]
    docs = corpus_pipeline.near_dedup(spark, docs, sf)
    assert docs.columns == columns and sorted(rows_of(docs)) == sorted(want)

    sizes = {r[0]: r[1] - r[2] for r in bytes_left(want, 50)}
    docs = corpus_pipeline.written(corpus_pipeline.suffix_dedup(spark, docs, sf), "test")
    kept = rows_of(docs)
    assert docs.columns == columns and len(kept) == len(want)
    assert all(sizes[d] - 6 <= len(t.encode()) <= sizes[d] or sizes[d] < 6 for d, t in kept if len(t.encode()) != sizes[d])

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    hit = {r[0] for r in brute_hits(kept, items) if r[2]}
    want = [r for r in kept if r[0] not in hit]
    docs = corpus_pipeline.decontaminate(spark, docs, sf)
    assert docs.columns == columns and sorted(rows_of(docs)) == sorted(want)

    own = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    assert sorted(map(tuple, corpus_pipeline.byte_bpe(spark, docs, sf).collect())) == digests(want, own.encode_ordinary)


def test_odd_rows_pass_all_stages(spark, sf, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf)
        docs.collect()


def test_all_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
