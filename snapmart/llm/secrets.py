"""Secrets in texts: keywords first, regular expressions at their places, checksums last.

One Aho-Corasick pass over a text finds all keywords. A regular expression is tried only
where its keyword begins, anchored there, and secrets whose format carries a checksum
count only if it is right. Runs of hex digits have no keyword; they are found by a scan.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

# Kinds in the order of spans that start together.
ASSIGN, ACCESS, HEX = "assign", "access", "hex"
GITHUB, NPM, BIP32, AGE, NOSTR = "github", "npm", "bip32", "age", "nostr"
KINDS = (ASSIGN, ACCESS, HEX, GITHUB, NPM, BIP32, AGE, NOSTR)

# Lower-cased keywords of every kind, its expression from the keyword on.
KEYWORDS = {
    ASSIGN: ("password", "passwd", "secret", "token", "apikey", "api_key"),
    ACCESS: ("akia",),
    GITHUB: ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    NPM: ("npm_",),
    BIP32: ("xprv",),
    AGE: ("age-secret-key-1",),
    NOSTR: ("nsec1",),
}
PATTERNS = {
    ASSIGN: re.compile(
        r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    ACCESS: re.compile(r"AKIA[A-Z0-9]+"),
    GITHUB: re.compile(r"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z_])"),
    NPM: re.compile(r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z_])"),
    BIP32: re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![0-9A-Za-z])"),
    AGE: re.compile(r"AGE-SECRET-KEY-1[02-9AC-HJ-NP-Z]{58}(?![0-9A-Za-z])"),
    NOSTR: re.compile(r"nsec1[02-9ac-hj-np-z]{58}(?![0-9A-Za-z])"),
}
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
# A run of enough hex digits; shorter ones would be dropped anyway.
_HEX = re.compile(rf"[0-9a-f]{{{LEAST_HEX},}}")

_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
_BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
_BECH32_STEPS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)


def crc_is_right(match: re.Match) -> bool:
    """Whether the last six characters are the base-62 crc32 of the thirty before."""
    value, digits = zlib.crc32(match[1].encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = _BASE62[digit] + digits
    return digits == match[2]


def base58_is_right(match: re.Match) -> bool:
    """Whether the last four bytes begin the double SHA-256 of the others."""
    value = 0
    for letter in match[0]:
        value = value * 58 + _BASE58.index(letter)
    data = value.to_bytes(82, "big") if value < 1 << 656 else b""
    return hashlib.sha256(hashlib.sha256(data[:-4]).digest()).digest()[:4] == data[-4:]


def bech32_is_right(match: re.Match) -> bool:
    """Whether the remainder of the code over prefix and data is one."""
    prefix, _, data = match[0].lower().rpartition("1")
    values = [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix]
    check = 1
    for value in values + [_BECH32.index(c) for c in data]:
        top = check >> 25
        check = (check & 0x1FFFFFF) << 5 ^ value
        for i, step in enumerate(_BECH32_STEPS):
            check ^= step if top >> i & 1 else 0
    return check == 1


CONFIRM = {
    ASSIGN: lambda m: len(m[2]) >= LEAST_VALUE,
    ACCESS: lambda m: len(m[0]) >= LEAST_ACCESS,
    GITHUB: crc_is_right, NPM: crc_is_right, BIP32: base58_is_right,
    AGE: bech32_is_right, NOSTR: bech32_is_right,
}


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick
    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def find(data: bytes | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all secrets of a UTF-8 text, in code points, by start and kind.

    Of each kind leftmost matches that do not overlap; a match that is then found too
    short, or to have a wrong checksum, still covers its characters.
    """
    if not data:
        return []
    text = data.decode("utf-8", "replace")
    # Lower-casing bytes changes A-Z only, so places stay the same.
    low = text.lower() if text.isascii() else data.lower().decode("utf-8", "replace")
    spans, past = [], dict.fromkeys(KINDS, 0)
    for last, (kind, length) in _automaton().iter(low):
        start = last + 1 - length
        if start >= past[kind] and (match := PATTERNS[kind].match(text, start)):
            past[kind] = match.end()
            if CONFIRM[kind](match):
                spans.append((kind, start, match.end()))
    spans += [(HEX, *match.span()) for match in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


_SPAN = StructType([
    StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())])


@F.pandas_udf(ArrayType(_SPAN))
def _spans(data: pd.Series) -> pd.Series:
    return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in find(x)] for x in data])


def spans_of(text: Column) -> Column:
    """All secrets of a text as an array of (kind, start, end); empty for NULL."""
    return _spans(text.cast("binary"))


def secrets(documents: DataFrame) -> DataFrame:
    """One row per secret: (doc_id, kind, start, end, secret)."""
    found = documents.select("doc_id", "text", F.explode(spans_of(F.col("text"))).alias("span"))
    return found.select("doc_id", "span.*", F.substring(
        "text", (F.col("span.start") + 1).cast("int"),
        (F.col("span.end") - F.col("span.start")).cast("int")).alias("secret"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_counts(documents: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row.

    NULL and empty texts have no spans and the digest of an empty list; repeated rows stay
    repeated, and other columns of ``documents`` are not looked at.
    """
    found = documents.select("doc_id", spans_of(F.col("text")).alias("found"))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind"].isin(ASSIGN, ACCESS, HEX))
    return found.select(
        "doc_id", count(ASSIGN), count(ACCESS), count(HEX),
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"))


def redacted(documents: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``documents`` with every secret of ``text`` replaced by ``mark``; other columns stay."""

    @F.pandas_udf(StringType())
    def cover(data: pd.Series) -> pd.Series:
        out = []
        for x in data:
            if x is None:
                out.append(None)
                continue
            text, parts, past = x.decode("utf-8", "replace"), [], 0
            for _, start, end in find(x):
                if end > past:
                    parts += [text[past:start], mark] if start >= past else []
                    past = end
            out.append("".join(parts) + text[past:])
        return pd.Series(out)

    return documents.withColumn("text", cover(F.col("text").cast("binary")))
