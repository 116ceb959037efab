import random
import re
from collections import Counter

import compare
import pyarrow as pa
from snapmart.llm import phrases
from snapmart.llm.oracles import oracles
from snapmart.llm.queries import registry

RNG = random.Random(5)
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(docs, least, best):
    """docs: (lang, text). Counts every phrase of every piece."""
    counts, words = {}, Counter()
    for lang, text in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            found = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(found)
            for n in range(1, 5):
                for i in range(len(found) - n + 1):
                    key = lang, tuple(found[i:i + n])
                    counts[key] = counts.get(key, 0) + 1
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out, longest = {}, {}
    for (lang, longer), f in candidates.items():
        for size in range(2, len(longer)):
            for i in range(len(longer) - size + 1):
                key = lang, longer[i:i + size]
                longest[key] = max(longest.get(key, 0), f)
    for (lang, words_), a in candidates.items():
        cuts = [(2_000_000 * a // (counts[lang, words_[:k]] + counts[lang, words_[k:]]), k) for k in range(1, len(words_))]
        score, k = min(cuts)
        if 100 * longest.get((lang, words_), 0) < 80 * a:
            out.setdefault(lang, []).append(
                (score, a, " ".join(words_), counts[lang, words_[:k]], counts[lang, words_[k:]]))
    rows = set()
    for lang, found in out.items():
        found.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        rows |= {(lang, i + 1, p, a, l, r, words[lang], s) for i, (s, a, p, l, r) in enumerate(found[:best])}
    return rows


def rows_of(frame):
    return [(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in frame.collect()]


def corpus():
    vocabulary = [f"w{i}" for i in range(12)] + ["Ünï", "ÉCOLE", "école"]
    docs = []
    for _ in range(120):
        words = [RNG.choice(vocabulary) for _ in range(RNG.randrange(60))]
        for _ in range(3):
            words[RNG.randrange(len(words) + 1):0] = ["New", "york", "city", "hall"]
        text = "".join(w + RNG.choice([" ", "  ", "\t", " ", " ", ". ", "\n", ", ", " "]) for w in words)
        docs.append((RNG.choice(["en", "en", "de", None]), text))
    return docs + [("en", None), ("fr", ""), (None, "..!? \n"), ("en", "same " * 500)]


def test_against_brute_force(spark):
    docs = corpus()
    frame = spark.createDataFrame(docs, "lang string, text string")
    for least, best in ((5, 40), (30, 2000), (1, 25)):
        got = rows_of(phrases.collocations(frame, least, best))
        assert len(got) == len(set(got)) and set(got) == brute_force(docs, least, best)


def test_tiny_filters_change_nothing(spark):
    docs = corpus()
    frame = spark.createDataFrame(docs, "lang string, text string")
    assert set(rows_of(phrases.collocations(frame, 5, 40, max_bits=64))) == brute_force(docs, 5, 40)


def test_chunks_own_every_word_once():
    parts, words = [], []
    for n in (0, 1, 2, 3, 4, 63, 64, 65, 500):
        for own in (["same"] * n, [f"w{RNG.randrange(40)}" for _ in range(n)]):
            parts.append((RNG.choice(["", " ", ". \t"]) + RNG.choice([" ", "  \t"]).join(own) + RNG.choice(["", "\n"])).encode())
            words.append([w.encode() for w in own])
    part, chunks, owned = phrases.cut_into_chunks(parts)
    at = [0] * len(parts)
    for p, chunk, n in zip(part.tolist(), chunks.to_pylist(), owned.tolist()):
        assert 1 <= n <= phrases.MAX_OWNED and chunk == b" ".join(words[p][at[p]:at[p] + n + 3])
        at[p] += n
    assert at == [len(w) for w in words]


def test_long_texts_are_taken_in_blocks(spark, monkeypatch):
    docs = corpus()
    batch = pa.RecordBatch.from_pydict({
        "lang": [d[0] for d in docs], "text": pa.array([d[1] and d[1].encode() for d in docs], pa.binary())})
    whole = [list(zip(*[c.to_pylist() for c in b.columns])) for b in phrases._parsed(iter([batch]))]
    monkeypatch.setattr(phrases, "BLOCK", 50)
    parts = [list(zip(*[c.to_pylist() for c in b.columns])) for b in phrases._parsed(iter([batch]))]
    assert len(parts) > 100 and sorted(map(str, sum(whole, []))) == sorted(map(str, sum(parts, [])))


def test_equal_passages_are_cut_alike(spark):
    passage = " ".join(f"word{i}" for i in range(200))
    docs = [("en", f"start{i} here {passage} end{i}") for i in range(50)]
    stored = phrases.parse(spark.createDataFrame(docs, "lang string, text string"))
    # All but the ends of the passage are in the dictionary once.
    assert stored.filter("n >= 50").count() > 8 and stored.count() < 50 * 12


def test_scores_are_exact_beyond_64_bits(spark):
    n = 3 * 10 ** 14 + 1
    frequent = spark.createDataFrame(
        [("en", 1, "a", n), ("en", 1, "b", n + 7), ("en", 2, "a b", n - 1)], "lang string, length int, phrase string, n bigint")
    candidates = frequent.filter("length = 2").selectExpr("lang", "length", "phrase", "n a", "split(phrase, ' ') words")
    got = phrases._scored(candidates, frequent).first()
    assert got.score == 2_000_000 * (n - 1) // (2 * n + 7) and (got.l, got.r) == (n, n + 7)


def test_odd_rows(odd, empty):
    assert phrases.collocations(empty).count() == 0
    want = brute_force([(r.lang, r.text) for r in odd.collect()], 2, 10)
    assert set(rows_of(phrases.collocations(odd, 2, 10))) == want


def test_sql(spark, sf):
    db = compare.connect(sf)
    assert compare.differences(registry()["op11_phrases"](spark, sf), db, oracles()["op11_phrases"]) == ""
