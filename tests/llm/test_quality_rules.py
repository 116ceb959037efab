import math
import re
from collections import Counter

import xxhash

from snapmart.llm import quality
from snapmart.llm.queries import op2_quality_rules, table


def signed(n):
    return n - (1 << 64) if n >= 1 << 63 else n


def hash_words(words):
    return [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in words]


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return {
        "n_words": n, "word_chars": sum(map(len, words)),
        "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "base_failed": n < 20 or 100 * len(covered) > 30 * n,
    }


def pair_hash(a, b):
    """Two longs, the second hashed with the first's hash as seed."""
    first = xxhash.xxh64_intdigest(a.to_bytes(8, "little"), seed=42)
    return xxhash.xxh64_intdigest(b.to_bytes(8, "little"), seed=first)


def buckets(text, n):
    ones = hash_words(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    return [h & (n - 1) for h in ones + [pair_hash(a, b) for a, b in zip(ones, ones[1:])]]


def brute_force(documents, labels, settings):
    good = sorted({d for d, q in labels if q == 1 and d is not None}, key=lambda d: (
        signed(xxhash.xxh64_intdigest(d.to_bytes(8, "little", signed=True), seed=42)), d))
    trusted = set(good[:settings.trusted_docs])
    raw, target = Counter(), Counter()
    for doc_id, text in documents:
        found = buckets(text, settings.buckets)
        raw.update(found)
        if doc_id in trusted:
            target.update(found)
    share = sum(target.values()) / max(sum(raw.values()), 1)
    k = settings.prior
    ratio = {b: math.floor(math.log((target[b] + k * share) / ((raw[b] + k) * share)) * 1e6 + 0.5)
             for b in raw} if share else {}
    out = []
    for doc_id, text in documents:
        row = base(text)
        found = buckets(text, settings.buckets)
        passed = sum(ratio.get(b, 0) for b in found) >= round(settings.threshold * 1e6) * (2 * row["n_words"] - 1)
        out.append((doc_id, *row.values(), not row["base_failed"] and passed))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def test_query_against_brute_force(spark, sf):
    documents = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    labels = [(r.doc_id, r.quality) for r in table(spark, sf, "labels").collect()]
    want = brute_force(documents, labels, quality.Settings())
    assert rows_of(op2_quality_rules(spark, sf)) == want
    assert 0 < sum(r[-1] for r in want) < len(want)


def test_trusted_sample_is_bounded(spark, sf):
    documents = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    labels = [(r.doc_id, r.quality) for r in table(spark, sf, "labels").collect()]
    few = quality.Settings(trusted_docs=50, buckets=4096)
    got = quality.quality_counts(table(spark, sf, "documents"), table(spark, sf, "labels"), few)
    assert rows_of(got) == brute_force(documents, labels, few)


def test_verdicts_follow_the_labels(spark, sf):
    kept = {r.doc_id: r.kept for r in op2_quality_rules(spark, sf).collect()}
    labels = table(spark, sf, "labels").collect()
    good = [kept[r.doc_id] for r in labels if r.quality == 1]
    bad = [kept[r.doc_id] for r in labels if r.quality == 0]
    assert sum(good) > 0.9 * len(good) and sum(bad) < 0.1 * len(bad)


def test_odd_rows(spark, odd, text_rows):
    labels = [(1, 1, 0), (None, 1, 0), (9, None, None), (10, 0, 0)]
    table_ = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    documents = [(d, t) for d, t, _ in text_rows]
    want = brute_force(documents, [(d, q) for d, q, _ in labels], quality.Settings())
    assert rows_of(quality.quality_counts(odd, table_)) == want
    kept = quality.keep_good(odd, table_)
    assert kept.columns == odd.columns and kept.count() == sum(r[-1] for r in want)


def test_empty_tables(spark, empty, odd):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality.quality_counts(empty, none).count() == 0
    # Without trusted documents all ratios are 0 and only the base rule decides.
    rows = quality.quality_counts(odd, none).collect()
    assert all(r.kept == (not r.base_failed) for r in rows)
