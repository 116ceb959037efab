import random
import re
import zlib
from collections import Counter

from snapmart.llm import spelling
from snapmart.llm.queries import registry, table

RNG = random.Random(3)
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts_of(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def brute_force(docs):
    """Every word's near words by taking out letters: two words are an edit apart if one
    less a letter is the other, or both less the letter at one place are equal."""
    counts, near, holes = counts_of(docs), {}, {}
    for w in counts:
        near[w] = set()
        for i in range(len(w)):
            holes.setdefault((i, w[:i] + w[i + 1:]), set()).add(w)
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    for w in counts:
        for short in {w[:i] + w[i + 1:] for i in range(len(w))}:
            if short in counts:
                near[w].add(short)
                near[short].add(w)
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-counts[o], o))
            if counts[best] >= 10 * counts[w]:
                form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return out


def rows_of(frame):
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()]


def misspelt():
    """Documents of a few words with edits of edits, so that chains of forms come up."""
    base = ["wonderful", "strasseneck", "élémentaire", "aaaaaaaa", "ÀÉÎõüÿþ", "bananana"]
    letters = "abcéüßÀ×÷ÿz"
    docs = []
    for word in base:
        words = [word]
        for _ in range(3):
            last = words[-1]
            at = RNG.randrange(len(last))
            words.append(RNG.choice([
                last[:at] + RNG.choice(letters) + last[at:], last[:at] + RNG.choice(letters) + last[at + 1:], last[:at] + last[at + 1:]]))
        for i, w in enumerate(words):
            docs += [(len(docs) + 1, f"{w} {w.upper() if w.isascii() else w},{w}")] * (2000 // 12 ** i or 1)
    for i in range(400):
        docs.append((10_000 + i, " ".join("".join(RNG.choices("abé", k=RNG.randrange(6, 10))) for _ in range(30))))
    return docs + [(None, "wonderful wonderfull"), (None, None), (7, ""), (8, "x" * 100_000 + " " + "y" * 99)]


def test_against_brute_force(spark):
    docs = misspelt()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(8)
    want = brute_force(docs)
    assert any(f and f != r for _, f, r, *_ in want) and sum(n > 3 for *_, n, _ in want) > 50
    got = rows_of(spelling.variants(frame))
    assert len(got) == len(want) and set(got) == want


def test_rounds_and_tiny_filters_change_nothing(spark):
    docs = misspelt()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    words = len(counts_of(docs))
    assert set(rows_of(spelling.variants(frame, max_bits=words * 7))) == brute_force(docs)


def test_pairs_come_up_once(spark):
    words = spark.createDataFrame([(w, 1) for w in ("aaaaaaa", "aaaaaaaa", "aaaaaab", "baaaaaaa", "aaabaaa", "aabaaaa")],
                                  "word string, n bigint")
    pairs = [tuple(sorted((r.word, r.near))) for r in spelling.near_pairs(words).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {("aaaaaaa", "aaaaaaaa"), ("aaaaaaa", "aaaaaab"), ("aaaaaaa", "aaabaaa"), ("aaaaaaa", "aabaaaa"),
                          ("aaaaaaa", "baaaaaaa"), ("aaaaaaaa", "baaaaaaa")}


def test_odd_rows(odd, empty):
    assert spelling.variants(empty).count() == 0
    want = brute_force([(r.doc_id, r.text) for r in odd.collect()])
    assert set(rows_of(spelling.variants(odd))) == want


def test_registered_query_on_whole_table(spark, sf):
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    got = rows_of(registry()["op13_spelling"](spark, sf))
    want = brute_force(docs)
    assert len(got) == len(want) > 1000 and set(got) == want
