import random
from itertools import combinations
from pathlib import Path

import corpus_pipeline
from pyspark.sql import functions as F
from snapmart import session
from snapmart.llm import bitmaps, components, similar, simhash
from test_simhash import Sets

RNG = random.Random(11)


def prose(n):
    return [f"w{RNG.randrange(3000)}" for _ in range(n)]


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))}


def brute_force(docs):
    """The smallest doc_id of every group that pairs with a similarity of 0.8 or more join."""
    sets, groups = {d: shingles(t) for d, t in docs}, Sets()
    for a, b in combinations(sets, 2):
        if 5 * min(len(sets[a]), len(sets[b])) >= 4 * max(len(sets[a]), len(sets[b])) and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            groups.join(a, b)
    first = {}
    for d in sorted(sets):
        first.setdefault(groups.find(d), d)
    return set(first.values())


def planted():
    """Copies with more and more words changed, around the limit, all with the same notice."""
    notice, docs = "all of this may be used under the terms of the usual license".split(), []
    for _ in range(25):
        text = prose(RNG.choice((3, 5, 25, 60, 150))) + notice
        docs.append(text)
        for changes in range(RNG.randrange(6)):
            copy = list(docs[-1])
            for at in RNG.sample(range(len(copy)), min(changes, len(copy))):
                copy[at] = "other"
            docs.append(copy)
    docs += [["one"], ["ONE"], [], [], notice, notice]
    RNG.shuffle(docs)
    return [(i, " ".join(t)) for i, t in enumerate(docs)] + [(len(docs), None)]


def test_against_all_pairs(spark):
    docs = planted()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = brute_force(docs)
    for sample in (similar.SAMPLE, 10):
        assert {r.doc_id for r in similar.keep_one(frame, sample).collect()} == want
    assert 20 < len(want) < len(docs) - 20


def test_stage_links_pairs_more_than_four_bits_apart(spark, sf):
    stage = dict(corpus_pipeline.STAGES)["near duplicates"]
    text = prose(100)
    near = text[:40] + ["other"] + text[41:90] + ["other"] + text[91:]
    far = [w if i % 12 else "other" for i, w in enumerate(text)]
    docs = [(3, " ".join(text)), (4, " ".join(near)), (5, " ".join(far))]
    kept = stage(spark, spark.createDataFrame(docs, "doc_id bigint, text string"), sf)
    assert {r.doc_id for r in kept.collect()} == {3, 5} == brute_force(docs)


def test_other_columns_and_odd_rows(spark, odd, empty):
    kept = similar.keep_one(odd)
    assert kept.columns == odd.columns and similar.keep_one(empty).count() == 0
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        ["1", "1", "None", "5", "8", "9", "10", "12"])


def test_crowds_and_hubs_lose_no_link(spark, monkeypatch):
    """Many texts share their first shingles: near copies of one text, and short texts that
    are little else than the same notice."""
    base, notice = prose(60), "all of this may be used under the terms of the usual license".split()
    docs = []
    for i in range(150):
        copy = list(base)
        for at in RNG.sample(range(60), RNG.randrange(3)):
            copy[at] = f"x{RNG.randrange(50)}"
        docs.append(" ".join(copy))
        docs.append(" ".join(notice + prose(RNG.randrange(4))))
    docs = [(i, t) for i, t in enumerate(docs)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = brute_force(docs)
    for crowd in (2, similar.CROWD, 10_000):
        monkeypatch.setattr(similar, "CROWD", crowd)
        assert {r.doc_id for r in similar.keep_one(frame).collect()} == want


def test_bitmaps_never_rule_out_a_pair():
    import numpy as np
    rng = np.random.default_rng(3)
    for n in (1, 5, 40, 300, 5000):
        one = np.unique(rng.integers(-2**62, 2**62, n))
        for changed in range(0, n // 5 + 1, max(n // 20, 1)):
            other = np.unique(np.concatenate((one[changed:], rng.integers(-2**62, 2**62, changed // 2))))
            shared = len(np.intersect1d(one, other))
            differ = sum(int(x ^ y).bit_count() for x, y in zip(
                similar.bitmap(one).view(np.uint64).tolist(), similar.bitmap(other).view(np.uint64).tolist()))
            assert shared <= (len(one) + len(other) - differ) / 2


def test_shingles_are_those_of_the_words():
    texts = [b"A b c d e f", b"a  b\tc\nd E f", b"a b", b"b a", b"ab", b"", None, b" \n ", b"a b c d e", b"x" * 700 + b" y"]
    lists = [x.tolist() for x in similar.shingle_lists(texts)]
    assert lists[0] == lists[1] and len(lists[0]) == 2 and lists[8] == lists[0][:1]
    assert [len(x) for x in lists[2:8]] == [1, 1, 1, 0, 0, 0] and len({x[0] for x in lists[2:5]}) == 3


def test_groups_hold_every_pair_once(spark):
    """A crowd around one hub is cut into parts; each has the texts of its own pairs only."""
    pairs = [(0, b, 100) for b in range(1, 200)] + [(b, b + 1, 100) for b in range(300, 310)]
    rows = similar._groups(spark.createDataFrame(pairs, "a bigint, b bigint, size bigint"), most=2_000).collect()
    assert sorted((r.key, p) for r in rows for p in r.partners) == sorted((a, b) for a, b, _ in pairs)
    groups = {}
    for r in rows:
        groups.setdefault((r.home, r.part), []).append(r.key)
        assert r.key < 300 or r.part == 0
    of_hub = [keys for (home, _), keys in groups.items() if home == 0]
    assert len(of_hub) > 5 and all(len(set(keys)) == len(keys) and 0 in keys for keys in of_hub)
    # Apart from the hub every set of the crowd is in one part.
    assert sum(len(keys) - 1 for keys in of_hub) == 199


def test_texts_of_the_kept_are_shuffled_once(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b"), (0, "b"), (2, None)], "doc_id bigint, text string")
    own = F.struct("doc_id", F.xxhash64("text").alias("mark")).alias("best")
    kept = docs.filter("doc_id is null or doc_id > 0").select(own).distinct()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = simhash.only_best(docs, kept)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, rows.collect())) == sorted(map(str, docs.filter(
            "doc_id is null or doc_id > 0").distinct().collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Window and join ask for the same columns, so nothing is dealt again above the join.
    above = plan.partition("LeftSemi")[0]
    assert "Window" in above and "Exchange" not in above


def test_small_tables_are_not_a_file_for_every_shuffle_partition(spark, scratch, monkeypatch):
    """What is stored of few rows takes few files, however many partitions shuffles have."""
    docs = planted()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    settings = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    monkeypatch.setattr(session, "scratch_dir", lambda _: scratch)
    monkeypatch.setattr(components, "remove", lambda *_: None)
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        assert {r.doc_id for r in similar.keep_one(frame).collect()} == brute_force(docs)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {}
    for path in Path(scratch).rglob("part-*.parquet"):
        files.setdefault(path.parent, []).append(path)
    # The sets of texts as they are read have a file for each task of the input.
    assert len(files) > 15 and max(len(f) for k, f in files.items() if not k.name.startswith("shingles")) <= 2


def test_gathered_grows_with_the_rows(spark):
    many = spark.range(0, 1000, 1, 50)
    for rows, want in ((0, 1), (999, 1), (5_000, 6), (10**9, 50)):
        assert session.gathered(many, rows, 1_000).rdd.getNumPartitions() == want
        assert session.gathered(many, rows, 1_000).count() == 1000


def test_plans_do_not_grow_with_the_texts_that_are_looked_for(spark):
    """The driver keeps the text of plans: a bitmap of the corpus is no part of one."""
    documents = spark.range(4_000).select(F.concat(F.lit("text "), "id").alias("text"))
    mark, length = F.xxhash64("text"), {}
    for n in (30, 3_000):
        of = documents.limit(n).select(mark.alias("mark"), mark.alias("key"))
        found = similar._texts(documents, mark, of)
        length[n] = len(found._jdf.queryExecution().toString())
        assert {bytes(r.text).decode() for r in found.collect()} == {f"text {i}" for i in range(n)}
    assert length[3_000] < 1.1 * length[30]


def test_bitmap_as_table_is_the_bitmap(spark, monkeypatch):
    """NULLs, columns named as its own, no hashes, more hashes than the largest bitmap is meant for."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 7 != 0, F.xxhash64("id")).alias("code"), "id", F.lit("x").alias("_chunk"), F.lit("y").alias("_words"))
    for n, most in ((0, bitmaps.MAX_BITS), (1, bitmaps.MAX_BITS), (5_000, bitmaps.MAX_BITS), (5_000, 1 << 14)):
        monkeypatch.setattr(bitmaps, "MAX_BITS", most)
        hashes = spark.range(n).select(F.xxhash64("id").alias("hash"))
        got = bitmaps.in_bitmap_table(rows, bitmaps.bitmap_table(hashes), "code")
        want = rows.filter(bitmaps.in_bitmap(bitmaps.bitmap_of(hashes), F.col("code")))
        assert got.columns == rows.columns and sorted(got.collect()) == sorted(want.collect())
        ids = {r.id for r in got.collect()}
        assert {i for i in range(n) if i % 7} <= ids and (most < bitmaps.MIN_BITS or len(ids) < 1.1 * n + 1)
