import heapq
import random
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapmart.llm import binary, huffman, tokens

PATH = tokens.vocabulary_path()
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return tokens.WordEncoder(PATH, remembered=50)  # forgets all the time


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_words_encode_like_whole_texts(text):
    text = text.encode("utf-8", "ignore").decode()
    own = tokens.encoder(PATH)
    assert np.frombuffer(own.encode(text.encode()), own.kind).tolist() == ids_of(text)


@pytest.mark.parametrize("text", [
    "", " ", "Don't WE'LL 'S can'tt", "é É Ω ΣΑΣ İ ß ẞ ſ Ÿ", "a\xa0b c\x85d\x1cz", "日本語 👍🏽 a​b",
    "<|endoftext|> x<|startoftext|>y <|endoftext", "½ ² ª º µ × ÷ ĳ ŉ ǅ", "12345 6a7 x_y", "(Ʃ ﬁ \x00\x01"])
def test_hard_words(encoder, text):
    assert np.frombuffer(encoder.encode(text.encode()), encoder.kind).tolist() == ids_of(text)


def test_documents_encode_alike(encoder, documents):
    for r in documents.select("text").limit(150).collect():
        assert np.frombuffer(encoder.encode(r.text.encode()), encoder.kind).tolist() == ids_of(r.text)


def test_words_are_remembered_once():
    own = tokens.WordEncoder(PATH)
    ids = own.encode("zebra Zebra, zebra!? caf\u00e9s.".encode())
    assert np.frombuffer(ids, own.kind).tolist() == ids_of("zebra Zebra, zebra!? caf\u00e9s.")
    assert {b"zebra", "caf\u00e9s".encode()} < set(own.words) and set(own.parts) == {",", "!?", "."}


SIGNED = [
    "Ab, ab. ab... é! Él?? ab&&& x** y-z- it's, it'll. 'S a', b'. (c) d) [e] f] _g_ h_ \U0001f44d. i\u0301. j.\u0301 k=\u0338 l= \u0338",
    "<|endoftext|> a<|startoftext|> b. c|> d", None, "", " ", "\t.\n", "ab", "ab.", "ab ,", "a\xa0b. c\x85. d\x1c. ²! ß. ÷. ĳ."]


@pytest.mark.parametrize("at_once", [1, 40, 1 << 20])
def test_texts_encode_together_as_alone(encoder, at_once):
    texts = SIGNED * 3
    got = list(encoder.encode_all([t if t is None else t.encode() for t in texts], at_once))
    assert [np.frombuffer(g, encoder.kind).tolist() for g in got] == [ids_of(t) for t in texts]
    broken = [b"\xff. a\xc3 b\xc3. \xa9. c\xff, d", b"\xe9, ", b""]
    assert list(encoder.encode_all(broken, at_once)) == [encoder.encode(t) for t in broken]
    assert list(encoder.encode_all([])) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aB\u00e9\u00c9\u0301\u0338.,;'&=<|> \t\n\xa01", max_size=25), max_size=4))
def test_signs_encode_as_in_whole_texts(texts):
    own = tokens.encoder(PATH)
    got = own.encode_all([t.encode() for t in texts], 30)
    assert [np.frombuffer(g, own.kind).tolist() for g in got] == [ids_of(t) for t in texts]


def test_words_of_many_texts_are_looked_up_once():
    class Counting(dict):
        def __missing__(self, word):
            asked.append(word)
            return b""

    own, asked = tokens.WordEncoder(PATH), []
    own.words = Counting()
    list(own.encode_all([b"Zebra, apple. zebra", b"apple, Zebra. \xc3\xa9t\xc3\xa9."] * 50))
    assert sorted(filter(None, asked)) == [b",", b".", b"apple", b"zebra", "\u00e9t\u00e9.".encode()]


def cheapest(counts):
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    total = heap[0] if len(heap) == 1 else 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 10 ** 6), min_size=1, max_size=200).filter(any))
def test_codes_are_optimal_and_decode(counts):
    counts = np.array(counts)
    lengths = huffman.code_lengths(counts)
    assert (counts * lengths).sum() == cheapest(counts)
    used = np.flatnonzero(counts)
    assert len(used) == 1 or sum(2.0 ** -int(n) for n in lengths[used]) == 1
    ids = np.random.default_rng(1).choice(used, 300)
    coder = huffman.Coder(lengths)
    assert (coder.read(*coder.write(ids), 300) == ids).all()


def test_length_limit():
    fibonacci = [1, 1]
    while len(fibonacci) < 40:
        fibonacci.append(sum(fibonacci[-2:]))
    lengths = huffman.code_lengths(np.array(fibonacci), 12)
    assert lengths.max() == 12 and sum(2.0 ** -int(n) for n in lengths) == 1
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(5), 2)


def mark_of(text):
    """The hash by which texts of one id are put in order."""
    mark = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), 42)
    return mark - (1 << 64) if mark >> 63 else mark


def expected(rows):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, mark_of(r[1]), (r[1] or "").encode())):
        ids = ids_of(text) + [tokens.END_ID]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[1])


def test_query_against_whole_texts(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert rows_of(binary.stored_ids(documents.repartition(5))) == expected(rows)


def test_files_hold_the_ids(spark, odd, text_rows, tmp_path):
    rows = [(d, t) for d, t, _ in text_rows]
    binary.write_ids(odd, str(tmp_path / "ids"), block_ids=40)  # many blocks
    got = binary.read_ids(spark, str(tmp_path / "ids"), with_ids=True)
    want = expected(rows)
    assert [r[:4] for r in rows_of(got)] == want
    by_crc = {zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got.collect()}
    assert by_crc == {w[3] for w in want}


def test_rows_of_one_id_go_to_several_tasks(spark):
    texts = [f"text {i} " + "word " * (i % 7) for i in range(300)]
    for doc_id in (7, None):
        frame = spark.createDataFrame([(doc_id, t) for t in texts], "doc_id bigint, text string")
        assert rows_of(binary.stored_ids(frame)) == expected([(doc_id, t) for t in texts])
    order = frame.select("doc_id", F.xxhash64("text").alias("mark")).repartitionByRange(4, "doc_id", "mark")
    assert order.select(F.spark_partition_id()).distinct().count() == 4


def test_empty_table(spark, empty):
    assert binary.stored_ids(empty).count() == 0
    assert tokens.context_report(tokens.encoded_lengths(empty)).count() == 0


def report(lengths):
    out = []
    for limit in sorted(set(lengths)):
        within = [n for n in lengths if n <= limit]
        out.append((limit, lengths.count(limit), limit * lengths.count(limit), len(within),
                    len(within) / len(lengths), len(lengths) - len(within), sum(lengths),
                    sum(min(n, limit) for n in lengths), sum(within)))
    return out


def test_context_report(spark, documents, odd, text_rows):
    names = [r.text for r in documents.select("text").collect()]
    got = tokens.context_report(tokens.encoded_lengths(documents)).orderBy("context_limit").collect()
    assert [tuple(r) for r in got] == report([len(ids_of(t)) for t in names])
    got = tokens.context_report(tokens.encoded_lengths(odd)).orderBy("context_limit").collect()
    assert [tuple(r) for r in got] == report([len(ids_of(t)) for _, t, _ in text_rows])


def test_bucket_borders(spark):
    rng = random.Random(2)
    lengths = [rng.choice((0, 1, 1023, 1024, 1025, 2047, 2048, 5000)) for _ in range(200)]
    rows = spark.createDataFrame([(n,) for n in lengths], "length bigint").groupBy("length").count()
    got = tokens.context_report(rows.withColumnRenamed("count", "documents")).orderBy("context_limit")
    assert [tuple(r) for r in got.collect()] == report(lengths)
