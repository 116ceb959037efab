"""A small table of labelled URLs from which the URL model is trained.

Hosts are made by a rule from words that sites of either kind use and from invented names,
in the same forms and under the same endings, languages and sub-domains, so that only the
words tell the kinds apart.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, SparkSession

# Words of hosts to block, and of ordinary ones.
UNWANTED = (
    "casino", "casinos", "poker", "roulette", "slots", "jackpot", "bets", "betting", "gambling", "pills", "viagra",
    "cialis", "pharmacy-deals", "adult", "xxx", "porn", "escort", "camgirls", "payday", "quickloans", "replica-watches",
    "warez", "cracked-software", "lottery", "ads", "adserver")
ORDINARY = (
    "news", "library", "museum", "university", "school", "weather", "recipes", "garden", "history", "science", "travel",
    "railway", "theatre", "music", "cinema", "football", "chess", "health", "hospital", "bakery", "bicycle", "mountain",
    "river", "harbour", "village", "council", "archive", "journal", "review", "letters", "maps", "photos", "design",
    "software", "linux", "python", "books", "poetry", "languages", "teachers", "parents", "farm", "forest", "birds",
    "planet", "energy", "market", "finance", "law", "kitchen", "coffee", "fashion", "sports", "radio", "knitting", "painting", "sailing", "reading", "hiking", "building",
    "cooking", "things")
_SYLLABLES = ("an", "ber", "do", "el", "fi", "gor", "hen", "is", "ka", "lo", "mar", "nu", "or", "pel", "ri", "sten", "th", "ul", "ver", "wo")
FORMS = ("{}", "{}-win", "free-{}", "cheap-{}", "best-{}", "my{}", "{}24", "{}-x", "online-{}", "{}world")
_ENDINGS, _LANGUAGES, _SUBDOMAINS = ("com", "net", "org"), ("en", "de", "fr", "es"), ("", "www.", "blog.", "m.")
_TAILS = ("", "/", ".html")
BLOCK, ALLOW = "block", "allow"


def _invented() -> list[str]:
    pairs = ["".join(p) for p in product(_SYLLABLES, repeat=2)]
    return [a + b for a, b in zip(pairs, pairs[7:] + pairs[:7])]


def labelled_rows() -> list[tuple[str, str, str]]:
    """(host, path, verdict): every word in every form, with endings, languages and
    sub-domains taken in turn; the same rows every time."""
    named = [(form.format(word), BLOCK) for word in UNWANTED for form in FORMS]
    named += [(form.format(word), ALLOW) for word in ORDINARY for form in FORMS]
    named += [(name, ALLOW) for name in _invented()]
    rows = []
    for i, (name, verdict) in enumerate(named):
        for turn in range(3):
            k = 7 * i + 5 * turn
            host = _SUBDOMAINS[k % 4] + name + (".example." if (i + turn) % 3 else ".") + _ENDINGS[(i + turn) % 3]
            rows.append((host, f"/{_LANGUAGES[(i // 3 + turn) % 4]}/{k * 37 % 9973}{_TAILS[k % 3]}", verdict))
    return rows


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(labelled_rows(), "host string, path string, verdict string")
