"""Rule-driven data-quality checks.

All rules that look at single rows, and freshness, share one aggregation. Rules
about distinct values are aggregated on their own columns only. The verdicts come
out as a DataFrame with one row per rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from snapmart.functions import round_half_away


@dataclass(frozen=True)
class Rule:
    """One check; build it with the functions below."""

    name: str
    kind: str
    columns: tuple[str, ...]
    threshold: float | None = None
    bounds: tuple[float, float] | None = None
    limit_text: str = ""

    @property
    def label(self) -> str:
        return ", ".join(self.columns)


def not_null(column: str, max_null_pct: float = 5.0) -> Rule:
    return Rule(f"not_null_{column}", "NOT_NULL", (column,), max_null_pct, limit_text=str(max_null_pct))


def greater_than(column: str, value: float) -> Rule:
    return Rule(f"gt_{column}_{value}", "GREATER_THAN", (column,), value, limit_text=str(value))


def greater_than_or_equal(column: str, value: float) -> Rule:
    return Rule(f"gte_{column}_{value}", "GREATER_THAN_OR_EQUAL", (column,), value, limit_text=str(value))


def no_duplicates(columns: Sequence[str], max_dup_pct: float = 1.0) -> Rule:
    return Rule(f"no_duplicates_{'_'.join(columns)}", "NO_DUPLICATES", tuple(columns), max_dup_pct)


def value_in_range(column: str, low: float, high: float) -> Rule:
    return Rule(f"range_{column}", "RANGE", (column,), None, (low, high), f"[{low}, {high}]")


def unique_count(column: str, expected_min: int) -> Rule:
    return Rule(f"unique_count_{column}", "UNIQUE_COUNT", (column,), expected_min, limit_text=str(expected_min))


def freshness(column: str, max_lag_minutes: float = 90) -> Rule:
    return Rule(f"freshness_{column}", "FRESHNESS", (column,), max_lag_minutes, limit_text=str(max_lag_minutes))


_BUILDERS = {
    "not_null": not_null,
    "greater_than": greater_than,
    "greater_than_or_equal": greater_than_or_equal,
    "no_duplicates": no_duplicates,
    "in_range": value_in_range,
    "unique_count": unique_count,
    "freshness": freshness,
}


def rules_from_config(entries: Sequence[dict], max_null_pct_allowed: float | None = None,
                      max_duplicate_pct_allowed: float | None = None) -> list[Rule]:
    """Rules from declarations such as ``{"column": "price", "check": "greater_than", "value": 0}``.

    Entries name the check and its column(s); further entries are passed on as
    arguments, ``value`` being the first of them. The two percentages are the limits of
    checks for missing and repeated values that give none of their own.
    """
    limits = {"not_null": max_null_pct_allowed, "no_duplicates": max_duplicate_pct_allowed}
    rules = []
    for entry in entries:
        options = dict(entry)
        check = options.pop("check")
        build = _BUILDERS.get(check)
        if build is None:
            raise ValueError(f"unknown check in {entry}")
        if limits.get(check) is not None and not {"value", "max_pct"} & options.keys():
            options["value"] = limits[check]
        target = options.pop("columns", None) or options.pop("column")
        first = [options.pop("value")] if "value" in options else []
        rules.append(build(target, *first, **options))
    return rules


def default_rules(max_null_pct: float = 5.0, max_dup_pct: float = 1.0, min_entities: int = 50,
                  max_lag_minutes: float = 90, strict_volume: bool = False) -> list[Rule]:
    """The suite for silver; ``strict_volume`` also rejects a volume of zero."""
    required = ["coin_id", "symbol", "name", "current_price", "market_cap", "total_volume"]
    volume = greater_than if strict_volume else greater_than_or_equal
    return [
        *[not_null(c, max_null_pct) for c in required],
        greater_than("current_price", 0),
        volume("total_volume", 0),
        greater_than("market_cap", 0),
        value_in_range("price_change_pct_24h", -100.0, 10000.0),
        no_duplicates(["coin_id", "batch_ingested_at"], max_dup_pct),
        unique_count("coin_id", min_entities),
        freshness("batch_ingested_at", max_lag_minutes),
    ]


def _failing(rule: Rule) -> Column:
    """Condition of a failing row, for rules that look at single rows."""
    value = F.col(rule.columns[0])
    broken = {
        "NOT_NULL": lambda: F.lit(False),
        "GREATER_THAN": lambda: value <= rule.threshold,
        "GREATER_THAN_OR_EQUAL": lambda: value < rule.threshold,
        "RANGE": lambda: (value < rule.bounds[0]) | (value > rule.bounds[1]),
    }
    return value.isNull() | broken[rule.kind]()


_ROW_RULES = ("NOT_NULL", "GREATER_THAN", "GREATER_THAN_OR_EQUAL", "RANGE")
_DISTINCT_RULES = ("NO_DUPLICATES", "UNIQUE_COUNT")


def distinct_rows(df: DataFrame, columns: Sequence[str], out: str = "distinct_rows") -> DataFrame:
    """One row: how many different values the columns take, NULL being a value."""
    return df.groupBy(*columns).agg(F.lit(1).alias("_one")).agg(F.count("*").alias(out))


def measures(rules: Sequence[Rule]) -> list[Column]:
    """Aggregates: the row count, and ``m<i>`` of each rule but those about distinct values.
    Counts can be added up and times compared, so those of parts can be merged."""
    single = [F.count("*").alias("total")]
    for i, rule in enumerate(rules):
        if rule.kind in _ROW_RULES:
            single.append(F.count_if(_failing(rule)).alias(f"m{i}"))
        elif rule.kind == "FRESHNESS":
            single.append(F.max(rule.columns[0]).alias(f"m{i}"))
    return single


def _measured(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row with a column ``m<i>`` per rule and the row count."""
    return df.agg(*measures(rules)).withColumns({
        f"m{i}": distinct_rows(df, rule.columns).scalar()
        for i, rule in enumerate(rules) if rule.kind in _DISTINCT_RULES
    })


def _two_decimals(x: Column) -> Column:
    return F.format_string("%.2f", round_half_away(x, 2))


def _facts_of_rule(rule: Rule, measure: Column, as_of: Column) -> Column:
    """What is known of one rule before the verdict; the measure of freshness is its lag."""
    if rule.kind == "FRESHNESS":
        measure = F.unix_micros(as_of) - F.unix_micros(measure)
    return F.struct(
        F.lit(rule.name).alias("check_name"),
        F.lit(rule.label).alias("column"),
        F.lit(rule.kind).alias("check_type"),
        F.lit(rule.threshold).cast("double").alias("threshold"),
        F.lit(rule.limit_text).alias("limit"),
        measure.cast("bigint").alias("measure"),
    )


def _by_kind(cases: dict[str, Column], otherwise: Column) -> Column:
    chosen = F
    for kind, value in cases.items():
        chosen = chosen.when(F.col("check_type") == kind, value)
    return chosen.otherwise(otherwise)


def _verdicts(rows: DataFrame) -> DataFrame:
    """Verdict columns from one row per rule."""
    total, measure, threshold = F.col("total"), F.col("measure"), F.col("threshold")
    failed, pct, label, limit = F.col("failed_records"), F.col("pct"), F.col("column"), F.col("limit")
    lag = measure / F.lit(60_000_000.0)
    fresh = F.coalesce(lag <= threshold, F.lit(False))
    share = F.coalesce(F.try_divide(failed * F.lit(100.0), total), F.lit(0.0))

    # Rules about the table as a whole fail for all of it or not at all; NULL for others.
    whole = F.col("whole")
    counted = (
        rows.withColumn("whole", _by_kind(
            {"UNIQUE_COUNT": measure >= threshold, "FRESHNESS": fresh}, F.lit(None)))
        .withColumn("failed_records", _by_kind({
            "NO_DUPLICATES": total - measure,
            "UNIQUE_COUNT": F.when(whole, 0).otherwise(1),
            "FRESHNESS": F.when(whole, 0).otherwise(total),
        }, measure))
        .withColumn("pct", F.when(whole, 0.0).when(~whole, 100.0).otherwise(share))
    )
    within = pct <= threshold
    passed = F.coalesce(whole, _by_kind({"NOT_NULL": within, "NO_DUPLICATES": within}, failed == 0))

    where = F.concat(failed, F.lit(" records where "), label)
    message = _by_kind({
        "NOT_NULL": F.concat(failed, F.lit("/"), total, F.lit(" nulls ("), _two_decimals(pct),
                             F.lit("%) — threshold "), limit, F.lit("%")),
        "GREATER_THAN": F.concat(where, F.lit(" <= "), limit),
        "GREATER_THAN_OR_EQUAL": F.concat(where, F.lit(" < "), limit),
        "RANGE": F.concat(failed, F.lit(" records outside "), limit, F.lit(" for "), label),
        "NO_DUPLICATES": F.concat(failed, F.lit(" duplicate rows on ["), label, F.lit("] ("),
                                  _two_decimals(pct), F.lit("%)")),
        "UNIQUE_COUNT": F.concat(measure, F.lit(" distinct values in "), label,
                                 F.lit(" (expected >= "), limit, F.lit(")")),
    }, F.concat(F.lit("Latest record is "), F.format_string("%.1f", round_half_away(lag, 1)),
                F.lit(" min old (threshold: "), limit, F.lit(" min)")))
    return counted.select(
        "check_name", "column", "check_type", passed.alias("passed"), total.alias("total_records"),
        failed.cast("bigint").alias("failed_records"), round_half_away(pct, 4).alias("failure_pct"),
        "threshold",
        F.when((F.col("check_type") == "FRESHNESS") & measure.isNull(), "No timestamp data found.")
        .otherwise(message).alias("message"),
    )


def verdicts_of(measured: DataFrame, rules: Sequence[Rule], as_of: Column | None = None) -> DataFrame:
    """Verdict of every rule, in rule order, from one row of measures."""
    as_of = F.current_timestamp() if as_of is None else as_of
    facts = [_facts_of_rule(rule, F.col(f"m{i}"), as_of) for i, rule in enumerate(rules)]
    return _verdicts(measured.select("total", F.inline(F.array(*facts))))


def run_checks(df: DataFrame, rules: Sequence[Rule], as_of: Column | None = None) -> DataFrame:
    """Verdict of every rule, in rule order."""
    return verdicts_of(_measured(df, rules), rules, as_of)


def build_report(results: DataFrame, dataset: str, as_of: Column | None = None) -> DataFrame:
    """One row: totals of a run with the verdicts nested in it."""
    as_of = F.current_timestamp() if as_of is None else as_of
    return results.agg(
        F.count("*").cast("int").alias("total_checks"),
        F.count_if("passed").cast("int").alias("passed"),
        F.count_if(~F.col("passed")).cast("int").alias("failed"),
        F.bool_and("passed").alias("overall_pass"),
        F.collect_list(F.struct(*results.columns)).alias("results"),
    ).select(
        F.uuid().alias("run_id"),
        F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("run_at"),
        F.lit(dataset).alias("dataset"),
        "total_checks", "passed", "failed", "overall_pass", "results",
    )


def write_report(report: DataFrame, path: str) -> None:
    """Add the report to a folder of JSON reports."""
    report.coalesce(1).write.mode("append").json(path)


def report_lines(report: DataFrame) -> DataFrame:
    """A stored report as text: a head with status, run, data set and totals, then one
    line per rule. ``line_no`` gives their order within a run."""
    status = F.when(F.col("overall_pass"), "✅ PASSED").otherwise("❌ FAILED")
    head = F.array(
        F.concat(F.lit("Data quality: "), status), F.concat(F.lit("Run: "), "run_id"),
        F.concat(F.lit("Dataset: "), "dataset"), F.concat(F.lit("Run at: "), "run_at"),
        F.concat(F.lit("Checks: "), "total_checks", F.lit(", passed: "), "passed", F.lit(", failed: "), "failed"))
    body = F.transform("results", lambda r: F.concat(
        F.when(r["passed"], "✅").otherwise("❌"), F.lit(" ["), r["check_type"], F.lit("] "),
        r["column"], F.lit(": "), r["message"]))
    return report.select("run_id", F.posexplode(F.concat(head, body)).alias("line_no", "line"))


def summary_lines(results: DataFrame, mark_stale: bool = False) -> DataFrame:
    """The verdicts as text, one line per rule; ``mark_stale`` singles out late data."""
    icon = F.when(F.col("passed"), "✅")
    if mark_stale:
        icon = icon.when(F.col("check_type") == "FRESHNESS", "⚠️ STALE")
    return results.select(F.concat(
        icon.otherwise("❌"), F.lit(" ["), "check_type", F.lit("] "), "column", F.lit(": "), "message",
    ).alias("line"))
