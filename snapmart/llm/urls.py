"""URL filters: fixed rules for hosts and paths, and a learned verdict for the rest.

The model is a logistic regression on hashed character n-grams of host and path, each
part with hashes of its own. It is trained from a small table of labelled URLs, that of
:mod:`url_labels` unless another is given.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, functions as F

from snapmart.llm.text import fresh, lower_ascii
from snapmart.llm.url_labels import ALLOW, BLOCK, labelled_urls
from snapmart.session import scratch_path
from snapmart.sources.files import remove

# Host and start of path, and the verdict for that host and its subdomains.
RULES = {"net/": BLOCK, "example.net/en/": ALLOW, "example.com/de/": BLOCK, "org/fr/": ALLOW}


@dataclass(frozen=True)
class Settings:
    """``labelled`` bounds the rows the model is trained on; they are picked by hash."""

    shortest: int = 3
    longest: int = 4
    features: int = 1 << 14
    labelled: int = 4_096
    regularisation: float = 0.001
    iterations: int = 50


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ?, # or the end, A-Z lower-cased; path: from
    there up to ?, # or the end. Both empty for NULL and where there is no ://."""
    whole = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return lower_ascii(F.regexp_extract(whole, pattern, 1)), F.regexp_extract(whole, pattern, 2)


def rule_of(host: Column, path: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits, NULL if none does. The rules are a short fixed list."""
    matches = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):  # a later, longer one wins
        name, _, start = rule.partition("/")
        own_host = (host == name) | host.endswith("." + name)
        matches = F.when(own_host & path.startswith("/" + start), F.lit(rule)).otherwise(matches)
    return matches


def _verdict_of(rule: Column, rules: dict[str, str]) -> Column:
    verdict = F.lit(None).cast("string")
    for name, value in rules.items():
        verdict = F.when(rule == name, F.lit(value)).otherwise(verdict)
    return verdict


def _ngrams(letters: str, mark: str, settings: Settings) -> list[Column]:
    """Runs of ``letters``, an array column, with ``mark`` in front; the last entry is empty."""
    count = F.size(letters) - 1
    return [
        F.transform(
            F.sequence(F.lit(1), F.greatest(count - (n - 1), F.lit(1))),
            lambda at: F.concat(F.lit(mark), F.array_join(F.slice(letters, at, F.lit(n)), "")))
        for n in range(settings.shortest, settings.longest + 1)]


def with_features(df: DataFrame, host: Column, path: Column, settings: Settings, out: str) -> DataFrame:
    """Add the hashed character n-grams of both parts, with the ends of either marked."""
    grams, one, other = fresh(df, "_grams", "_host_letters", "_path_letters")
    letters = {name: F.split(F.concat(F.lit("^"), part, F.lit("$")), "") for name, part in ((one, host), (other, path))}
    listed = df.withColumns(letters).withColumn(grams, F.concat(
        *_ngrams(one, "h", settings), *_ngrams(other, "p", settings)))
    hashing = HashingTF(numFeatures=settings.features, binary=True, inputCol=grams, outputCol=out)
    return hashing.transform(listed).drop(grams, one, other)


def train(labelled: DataFrame, settings: Settings = Settings()) -> LogisticRegressionModel | str:
    """Fit to rows of (host, path, verdict), at most ``settings.labelled`` of them, one per
    different host and path. With one verdict only, that verdict is the model; without any
    row it is to allow."""
    sample = labelled.filter(F.col("verdict").isNotNull()).groupBy("host", "path").agg(
        F.min("verdict").alias("verdict")
    ).orderBy(F.xxhash64("host", "path"), "host", "path").limit(settings.labelled)
    rows = sample.collect()  # bounded by the setting
    verdicts = {row["verdict"] for row in rows}
    if len(verdicts) < 2:
        return verdicts.pop() if verdicts else ALLOW
    # One partition: sums of the optimiser come in one order, so reruns agree.
    table = labelled.sparkSession.createDataFrame(rows, sample.schema).coalesce(1).withColumn(
        "label", (F.col("verdict") == BLOCK).cast("double"))
    ready = with_features(table, F.col("host"), F.col("path"), settings, "features")
    fitted = LogisticRegression(
        maxIter=settings.iterations, regParam=settings.regularisation).fit(ready.select("label", "features"))
    # A fitted model holds on to a summary and so to the session, which tasks cannot be
    # sent; one that was read back has the coefficients only.
    path = scratch_path(labelled.sparkSession, "url_model")
    fitted.write().save(path)
    try:
        return LogisticRegressionModel.load(path)
    finally:
        remove(labelled.sparkSession, path)


def predict(df: DataFrame, model: LogisticRegressionModel | str, settings: Settings, out: str) -> DataFrame:
    """Add the model's verdict for columns ``host`` and ``path``."""
    if isinstance(model, str):
        return df.withColumn(out, F.lit(model))
    features, guess, raw, probability = fresh(df, "_features", "_guess", "_raw", "_probability")
    ready = with_features(df, F.col("host"), F.col("path"), settings, features)
    model = model.copy().setFeaturesCol(features).setPredictionCol(guess)
    model.setRawPredictionCol(raw).setProbabilityCol(probability)
    return model.transform(ready).withColumn(
        out, F.when(F.col(guess) == 1.0, BLOCK).otherwise(ALLOW)).drop(features, guess, raw, probability)


def with_rules(pages: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """(page_id, host, path, rule, ruled) for every row."""
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    return split.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn(
        "ruled", _verdict_of(F.col("rule"), rules))


def judged(pages: DataFrame, labelled: DataFrame | None = None, rules: dict[str, str] = RULES,
           settings: Settings = Settings()) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url).

    The verdict is the rule's, or the model's where no rule fits. ``labelled`` (host,
    path, verdict) trains the model; without it, the table kept with the library does.
    Outcomes of the rules are no labels: they tell endings and languages apart, not sites.
    """
    ruled = with_rules(pages, rules)
    if labelled is None:
        labelled = labelled_urls(pages.sparkSession)
    guessed = predict(ruled, train(labelled, settings), settings, "guess")
    return guessed.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "guess").alias("verdict"))
