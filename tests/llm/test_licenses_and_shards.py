import re
from collections import Counter

import pytest

from snapmart.llm import licenses, sharding

import xxhash


@pytest.mark.parametrize("block, name", [
    (text, name) for name, texts in licenses.TEMPLATES.items() for text in texts])
def test_every_wording_is_found(block, name):
    assert licenses.match(block)[0] == name and licenses.match(block)[8]
    changed = "See here: " + block.upper().replace(" THE ", "  the ") + " All rights reserved."
    assert licenses.match(changed)[0] == name and licenses.match(changed)[8]


@pytest.mark.parametrize("block", [
    "the license of this car was old", "copyright", "Licensed to nobody, and nobody is free",
    "This work is licensed under the terms that follow below", "Released under water by the fisher's license"])
def test_other_sentences_are_not_confirmed(block):
    assert not licenses.match(block)[8]


def test_versions_are_told_apart():
    assert licenses.match("Licensed under CC BY 4.0.")[0] == "CC-BY-4.0"
    assert licenses.match("Licensed under CC BY-NC 4.0.")[0] == "CC-BY-NC-4.0"
    assert licenses.match(" \t ") is None


def test_query_against_exact_lines(documents):
    wordings = {text: name for name, texts in licenses.TEMPLATES.items() for text in texts}
    want = Counter(
        (r.doc_id, i, wordings[line]) for r in documents.collect()
        for i, line in enumerate((r.text or "").split("\n")) if line in wordings)
    rows = licenses.scan(documents).collect()
    got = Counter((r.doc_id, r.block_no, r.license) for r in rows if r.confirmed)
    assert want and got >= want
    cued = sum(bool(re.search(licenses.CUE, line)) for r in documents.collect() for line in (r.text or "").split("\n"))
    assert len(rows) == cued


def test_odd_rows(spark, odd, empty):
    assert licenses.scan(odd).count() == 0 and licenses.scan(empty).count() == 0
    rows = spark.createDataFrame(
        [(None, "x\nReleased under the MIT License."), (1, None), (1, "license"), (1, "license")],
        "doc_id bigint, text string")
    got = licenses.scan(rows).collect()
    assert sorted((str(r.doc_id), r.block_no, r.confirmed) for r in got) == [
        ("1", 0, False), ("1", 0, False), ("None", 1, True)]


@pytest.mark.parametrize("slots", [7, 101, 65_537])
def test_table_is_even_and_stable(slots):
    names = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(names, slots)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 7
    shuffled = names[::-1]
    assert [names[i] for i in table] == [shuffled[i] for i in sharding.lookup_table(shuffled, slots)]


def test_few_slots_move_when_a_shard_leaves():
    before = sharding.lookup_table(sharding.SHARDS)
    after = sharding.lookup_table(sharding.SHARDS[:-1])
    gone = len(sharding.SHARDS) - 1
    moved = sum(a != b for a, b in zip(before, after) if a != gone)
    assert moved < 0.02 * sharding.SLOTS


@pytest.mark.parametrize("shards, slots", [((), 7), (("a", "a"), 7), (("a",), 8), (("a", "b", "c"), 2)])
def test_bad_tables(shards, slots):
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, slots)


def slot(doc_id):
    hashed = 42 if doc_id is None else xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little", signed=True), seed=42)
    return (hashed - (1 << 64) if hashed >= 1 << 63 else hashed) % sharding.SLOTS


def test_query_against_the_table(documents):
    table = sharding.lookup_table(sharding.SHARDS)
    got = sharding.sharded(documents, "doc_id")
    rows = {r.doc_id: (r.slot, r.shard, r.text) for r in got.collect()}
    assert rows == {r.doc_id: (slot(r.doc_id), table[slot(r.doc_id)], r.text) for r in documents.collect()}


def test_rows_of_one_key_stay_together(odd, empty, text_rows):
    got = sharding.sharded(odd, "doc_id")
    # The table has columns of these names already.
    assert got.columns == [*odd.columns, "slot_", "shard_"]
    rows = got.collect()
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _, _ in text_rows)
    assert len({(r.doc_id, r.shard_) for r in rows}) == len({d for d, _, _ in text_rows})
    assert all(r.slot_ == slot(r.doc_id) and r.slot == "x" for r in rows)
    assert sharding.sharded(empty, "doc_id").count() == 0
