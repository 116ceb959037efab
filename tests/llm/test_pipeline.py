import re
import zlib

import numpy as np
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from snapmart.llm import mixing, quality, tokens
from snapmart.llm.oracles import oracles
from snapmart.llm.queries import registry, table
from test_decontamination import brute_force as leaks_of
from test_quality_rules import brute_force as quality_of
from test_similar import brute_force as near_of

import compare


def test_sql_agrees(spark, sf):
    db = compare.connect(sf)
    for name, sql in oracles().items():
        assert compare.differences(registry()[name](spark, sf), db, sql) == "", name


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


def test_stages_against_brute_force(spark, sf):
    """Each stage, given what the one before it kept."""
    stages = dict(corpus_pipeline.STAGES)
    docs = table(spark, sf, "documents")
    columns = docs.columns

    def run(name, docs):
        out = stages[name](spark, docs, sf).persist()
        return out, out.collect()

    rows = {r.doc_id: r for r in docs.collect()}
    labels = [(r.doc_id, r.quality) for r in table(spark, sf, "labels").collect()]
    want = {r[0] for r in quality_of([(r.doc_id, r.text) for r in rows.values()], labels, quality.Settings()) if r[-1]}
    docs, kept = run("quality rules", docs)
    assert docs.columns == columns and {r.doc_id for r in kept} == want
    assert all(r == rows[r.doc_id] for r in kept)

    want = near_of([(r.doc_id, r.text) for r in kept])
    docs, kept = run("near duplicates", docs)
    assert docs.columns == columns and {r.doc_id for r in kept} == want and len(kept) == len(want)

    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    known = {w for _, t in items for w in re.split(r"[\W_]+", t.lower())}
    likely = [r for r in kept if sum(w in known for w in re.split(r"[\W_]+", r.text.lower())) >= 8]
    sample = [(r.doc_id, r.text) for r in likely if len(r.text) < 1500][:80]
    dirty = {r[0] for r in leaks_of(sample, items)}
    before, (docs, kept) = {r.doc_id for r in kept}, run("decontamination", docs)
    left = {r.doc_id for r in kept}
    assert docs.columns == columns and left < before
    assert {d for d, _ in sample} - left == dirty

    plan = {r.doc_id: r.taken for r in mixing.mixed_sizes(docs).collect() if r.taken}
    docs, kept = run("mixing", docs)
    assert docs.columns == columns
    assert {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in kept} == plan

    tokenizer, start = Tokenizer.from_file(tokens.vocabulary_path()), 0
    _, got = run("token ids", docs)
    for r, source in zip(sorted(got, key=lambda r: r.start), sorted(kept, key=lambda r: r.doc_id), strict=True):
        ids = tokenizer.encode(source.text, add_special_tokens=False).ids + [1]
        assert (r.doc_id, r.start, r.n_tokens) == (source.doc_id, start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_run_is_the_stages_in_order(spark):
    folder = "/root/testdata/sf0.001"
    once = sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()))
    assert once and once == sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "near duplicates", "decontamination", "mixing", "token ids"]


def test_odd_rows_through_all_stages(spark, sf, odd, empty, text_rows):
    """NULLs, copies, very long texts, several rows of one id, clashing columns; no rows."""
    for start in (odd, empty):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, stage(spark, docs, sf)
            if name != "token ids":
                assert docs.columns == odd.columns
        left = docs.collect()
        assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and bool(left) == (start is odd)
        # The long text and its near copy are one document.
        assert {r.doc_id for r in left} <= {10, 12, 9, 8, 1, None}
