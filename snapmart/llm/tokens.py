"""Token ids of texts, and an exact histogram of encoded lengths."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from snapmart.session import materialise

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
# Words a task remembers; twice as many at most.
REMEMBERED = 300_000
# Bytes of text whose words are told apart at once.
AT_ONCE = 1 << 23
CONTEXT_BUCKET = 1_024


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


# Pre-tokens of lower-case words of plain Latin letters; others go to the library.
_PLAIN = re.compile(r"[!-~\xa1-\u012f\u0131-\u017f]+")
_LATIN = "".join(c for c in map(chr, range(0xa1, 0x180)) if c.isalpha())
_DIGIT_LIKE = "".join(c for c in map(chr, range(0xa1, 0x180)) if c.isnumeric())
_PARTS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9{_DIGIT_LIKE}]|[^a-z0-9{_LATIN}{_DIGIT_LIKE}\s]+")
# A lower-case word of common letters, in UTF-8, and the signs behind it.
_COMMON = re.compile(rb"((?:[a-z]|\xc3[\xa0-\xb6\xb8-\xbf])+)([.,;:!?]*)")
# Signs of ASCII but the apostrophe, between a common letter and white space (RE2, on bytes).
_SIGNED = r"([a-z]|\xc3[\xa0-\xb6\xb8-\xbf])([!-&(-/:-@\[-`{-~]+)([\t-\r ])"


class _Recent(dict):
    """A dictionary that works out what it lacks and forgets what has not been used lately."""

    def __init__(self, work_out, limit: int):
        self.work_out, self.limit, self.older = work_out, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.work_out(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class WordEncoder:
    """Encodes texts word by word, with each word's ids remembered.

    The tokenizer cuts at white space before it does anything that looks at more than
    one character, so the ids of a text are those of its words, one after the other.
    Only words between the white space characters 09-0D and 20 are taken apart here;
    any other white space is left to the tokenizer. As it lower-cases all text but its
    special tokens, A-Z are lower-cased first, so fewer words are told apart.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.model = self.tokenizer.model  # a new object at every access
        self.words = _Recent(self._word, remembered)
        self.parts = _Recent(self._part, remembered)
        self.byte_level = _byte_letters()
        self.id_bytes = [
            i.to_bytes(self.kind.itemsize, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.plain = _cuts_like_here(self.tokenizer)

    def _part(self, part: str) -> bytes:
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.byte_level)
        return b"".join([self.id_bytes[token.id] for token in self.model.tokenize(letters)])

    def _word(self, word: bytes) -> bytes:
        if self.plain and (common := _COMMON.fullmatch(word)):
            # Remembered once, as a word; one with signs behind it looks the bare word up.
            if common[2]:
                return self.words[common[1]] + self.parts[common[2].decode()]
            return self._part(word.decode())
        text = word.decode("utf-8", "replace")
        if self.plain and _PLAIN.fullmatch(text) and "<|" not in text:
            found = _PARTS.findall(text.lower())
            return self.parts[found[0]] if len(found) == 1 else b"".join([self.parts[p] for p in found])
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join([self.id_bytes[i] for i in ids])

    def _lowered(self, text: bytes | None) -> bytes:
        text = text or b""
        return text.lower() if self.plain and b"<|" not in text else text

    def encode(self, text: bytes | None) -> bytes:
        """Little-endian ids of a UTF-8 text, ``kind`` wide each; none for NULL."""
        return b"".join(map(self.words.__getitem__, self._lowered(text).split()))

    def encode_all(self, texts: Iterable[bytes | None], at_once: int = AT_ONCE) -> Iterator[bytes]:
        """What :meth:`encode` gives for every text. Each word is looked up once in texts
        of ``at_once`` bytes together."""
        held, size = [], 0
        for text in texts:
            held.append(self._lowered(text))
            size += len(held[-1])
            if size >= at_once:
                yield from self._encode_held(held)
                held, size = [], 0
        if held:
            yield from self._encode_held(held)

    def _encode_held(self, texts: list[bytes]) -> Iterator[bytes]:
        column = pa.array(texts, pa.large_binary())
        if self.plain:
            # Where letters end and signs begin the tokenizer cuts anyway, so that signs
            # can be words of their own.
            cut = pc.replace_substring_regex(column, _SIGNED, r"\1 \2\3")
            column = pc.if_else(pc.match_substring(column, "<|"), column, cut)
        words = pc.ascii_split_whitespace(column.view(pa.large_string()))
        told = words.flatten().dictionary_encode()
        known = told.dictionary.view(pa.large_binary()).to_pylist()
        ids = pa.array([self.words[word] for word in known], pa.large_binary()).take(told.indices)
        _, ends, data = ids.buffers()
        bounds = np.frombuffer(ends, np.int64, len(ids) + 1)[words.offsets.to_numpy()]
        view = memoryview(data or b"")
        for a, b in pairwise(bounds.tolist()):
            yield bytes(view[a:b])


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


def _cuts_like_here(tokenizer) -> bool:
    """Whether the shortcut for plain words agrees with the tokenizer on a probe."""
    probe = "Don't we'll 12½ çÀ-é!! x#y ÿß ªº ×÷ can'tt 'S naïve_2 Œuvre ǅ"
    cut = [p for w in probe.lower().split() for p in _PARTS.findall(w)]
    pre = tokenizer.pre_tokenizer
    if pre is None or tokenizer.normalizer is None:
        return False
    theirs = [p for p, _ in pre.pre_tokenize_str(tokenizer.normalizer.normalize_str(probe))]
    letters = _byte_letters()
    return theirs == [p.encode().decode("latin-1").translate(letters) for p in cut]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker."""
    return WordEncoder(path)


def encoded_lengths(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(length, documents): how many documents have each number of ids. Exact; NULL and
    empty texts have none. A task sends one row per length at most."""
    path = path or vocabulary_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        totals: dict[int, int] = {}
        for batch in batches:
            for ids in own.encode_all(text.as_py() for text in batch.column(0)):
                n = len(ids) // own.kind.itemsize
                totals[n] = totals.get(n, 0) + 1
        yield pa.RecordBatch.from_pydict({
            "length": pa.array(list(totals), pa.int64()),
            "documents": pa.array(list(totals.values()), pa.int64())})

    texts = documents.select(F.col("text").cast("binary").alias("text"))
    counted = texts.mapInArrow(count, "length bigint, documents bigint")
    return counted.groupBy("length").agg(F.sum("documents").alias("documents"))


def context_report(histogram: DataFrame) -> DataFrame:
    """What every context limit means for the corpus, from (length, documents).

    One row per length that occurs, taken as the limit: documents and ids of just that
    length, documents up to it with their share of all (so the first row whose share
    reaches q has the q-quantile), documents beyond it, all ids, and ids left if longer
    documents are cut at the limit or dropped. Limits between two lengths follow from the
    row below: each further id adds ``documents_over`` to the ids left.

    Suffix sums are built within buckets of lengths and then over the buckets, so no
    task gets more than the lengths of a bucket or one row per bucket.
    """
    # A few thousand rows, read for the buckets and for the lengths.
    rows = materialise(histogram, "lengths").withColumns({
        "bucket": F.floor(F.col("length") / CONTEXT_BUCKET),
        "ids": F.col("length") * F.col("documents")})
    buckets = rows.groupBy("bucket").agg(
        F.sum("documents").alias("bucket_documents"), F.sum("ids").alias("bucket_ids"))
    above = Window.orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = buckets.select(
        "bucket",
        F.coalesce(F.sum("bucket_documents").over(above), F.lit(0)).alias("documents_above"),
        F.coalesce(F.sum("bucket_ids").over(above), F.lit(0)).alias("ids_above"),
        F.sum("bucket_documents").over(everything).alias("all_documents"),
        F.sum("bucket_ids").over(everything).alias("all_ids"))
    later = Window.partitionBy("bucket").orderBy(F.col("length").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    joined = rows.withColumns({
        "documents_later": F.coalesce(F.sum("documents").over(later), F.lit(0)),
        "ids_later": F.coalesce(F.sum("ids").over(later), F.lit(0))}).join(offsets, "bucket")
    over = F.col("documents_above") + F.col("documents_later")
    ids_over = F.col("ids_above") + F.col("ids_later")
    return joined.select(
        F.col("length").alias("context_limit"), "documents", "ids",
        (F.col("all_documents") - over).alias("documents_within"),
        ((F.col("all_documents") - over) / F.col("all_documents")).alias("share_within"),
        over.alias("documents_over"), F.col("all_ids"),
        (F.col("all_ids") - ids_over + over * F.col("length")).alias("ids_if_cut"),
        (F.col("all_ids") - ids_over).alias("ids_if_dropped"))
