import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from snapmart.llm import simhash
from snapmart.llm.components import connected_components


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), seed=42)
              for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        self.up[self.find(a)] = self.find(b)


def classes(prints, budget=4):
    """Fingerprint -> set of fingerprints in its component."""
    values, sets = np.unique(np.array(prints, dtype=np.uint64)), Sets()
    for v in values:
        for w in values[np.bitwise_count(values ^ v) <= budget]:
            sets.join(int(v), int(w))
    found = defaultdict(set)
    for v in values.tolist():
        found[sets.find(v)].add(v)
    return {v: frozenset(members) for members in found.values() for v in members}


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_fingerprint_of_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("text", ["", " ", "a", "a b c", "A b\x0bC\x0cd e", "x y z w " * 200, "é ü ñ " * 700])
def test_fingerprint_examples(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.lists(st.integers(0, 63), max_size=5)), min_size=1, max_size=60),
       st.integers(0, 3))
def test_trie_finds_all_components(flips, parts):
    prints = set()
    for centre, bits in flips:
        value = xxhash.xxh64_intdigest(str(centre))
        for b in bits:
            value ^= 1 << b
        prints.add(value)
    values = np.array(sorted(prints), dtype=np.uint64)
    part = np.arange(len(values)) % (parts + 1)
    sets = Sets()
    for offset, width in simhash._blocks(4):
        for i in range(parts + 1):
            for j in range(i, parts + 1):
                chosen = (part == i) | (part == j)
                if not chosen.any():
                    continue
                sides = None if i == j else (part[chosen] == j).astype(np.int8)
                for a, b in zip(*simhash.close_links(values[chosen], sides, offset, width)):
                    sets.join(int(a), int(b))
    got = defaultdict(set)
    for v in values.tolist():
        got[sets.find(v)].add(v)
    assert {frozenset(m) for m in got.values()} == set(classes(values).values())


def test_blocks_cover_all_bits():
    assert [b for o, w in simhash._blocks(4) for b in range(o, o + w)] == list(range(64))


def expected(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    member = classes(prints)
    smallest = {}
    for (doc_id, _), p in zip(rows, prints):
        if doc_id is not None:
            key = member[p]
            smallest[key] = min(smallest.get(key, doc_id), doc_id)
    return sorted(((d, f"{p:016x}", smallest.get(member[p])) for (d, _), p in zip(rows, prints)), key=str)


@pytest.mark.parametrize("part", [20, 100_000])
def test_query_against_all_pairs(spark, documents, part):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = simhash.near_duplicates(documents, part=part)
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_odd_rows(odd, text_rows):
    got = simhash.near_duplicates(odd).collect()
    assert sorted(map(tuple, got), key=str) == expected([(d, t) for d, t, _ in text_rows])


def test_one_of_each_component_stays(odd, text_rows):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    groups = {p: d for d, p, _ in map(tuple, simhash.near_duplicates(odd).collect())}
    member = classes([int(p, 16) for p in groups])
    assert kept.count() == len(set(member.values()))


def test_empty_table(empty):
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0


@pytest.mark.parametrize("links", [
    [(i, i + 1) for i in range(60)],  # a chain
    [(0, i) for i in range(1, 40)] + [(99, i) for i in range(20, 60)],  # two stars that touch
    [(5, 4), (4, 5), (7, 7), (1, 2)], []])
def test_connected_components(spark, links):
    sets = Sets()
    for a, b in links:
        sets.join(a, b)
    got = defaultdict(set)
    for r in connected_components(spark.createDataFrame(links, "x bigint, y bigint")).collect():
        got[r.component].add(r.node)
    want = defaultdict(set)
    for v in sets.up:
        want[sets.find(v)].add(v)
    assert {frozenset(m) for m in got.values()} == {frozenset(m) for m in want.values() if len(m) > 1}
    assert all(c in m for c, m in got.items())
