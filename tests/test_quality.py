import json
import os

import pytest
from pyspark.sql import functions as F

from snapmart.operators import quality as q



def now():
    return F.lit("2024-06-15 12:00:00").cast("timestamp")


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, x double, t string").withColumn("t", F.col("t").cast("timestamp"))


ROWS = [("a", 1.0, "2024-06-15 10:30:00"), ("a", 0.0, "2024-06-15 10:30:00"),
        (None, None, None), (None, -1.0, "2024-06-15 09:00:00")]


def verdict(spark, rule, rows=ROWS):
    return q.run_checks(frame(spark, rows), [rule], now()).first()


def test_not_null(spark):
    row = verdict(spark, q.not_null("x", 25.0))
    assert row.passed and row.failed_records == 1 and row.failure_pct == 25.0 and row.threshold == 25.0
    assert row.message == "1/4 nulls (25.00%) — threshold 25.0%"
    assert not verdict(spark, q.not_null("x", 24.9)).passed


def test_comparisons_count_null_as_failed(spark):
    row = verdict(spark, q.greater_than("x", 0))
    assert (row.check_name, row.failed_records, row.passed) == ("gt_x_0", 3, False)
    assert row.message == "3 records where x <= 0"
    assert verdict(spark, q.greater_than_or_equal("x", 0)).failed_records == 2
    row = verdict(spark, q.value_in_range("x", -1.0, 0.5))
    assert row.failed_records == 2 and row.threshold is None
    assert row.message == "2 records outside [-1.0, 0.5] for x"


def test_duplicates_treat_null_as_a_value(spark):
    row = verdict(spark, q.no_duplicates(["id"], 50.0))
    assert (row.failed_records, row.failure_pct, row.passed) == (2, 50.0, True)
    row = verdict(spark, q.no_duplicates(["id", "t"]))
    assert (row.failed_records, row.column, row.check_name) == (1, "id, t", "no_duplicates_id_t")


def test_unique_count_counts_null(spark):
    assert verdict(spark, q.unique_count("id", 2)).passed
    row = verdict(spark, q.unique_count("id", 3))
    assert (row.passed, row.failed_records, row.failure_pct, row.threshold) == (False, 1, 100.0, 3.0)
    assert row.message == "2 distinct values in id (expected >= 3)"


def test_freshness(spark):
    row = verdict(spark, q.freshness("t", 90))
    assert row.passed and row.message == "Latest record is 90.0 min old (threshold: 90 min)"
    row = verdict(spark, q.freshness("t", 89.9))
    assert (row.passed, row.failed_records, row.failure_pct) == (False, 4, 100.0)
    row = verdict(spark, q.freshness("t"), [("a", 1.0, None)])
    assert (row.passed, row.failed_records, row.message) == (False, 1, "No timestamp data found.")


def test_empty_table(spark):
    rules = [q.not_null("x"), q.greater_than("x", 0), q.no_duplicates(["id"]), q.unique_count("id", 1),
             q.value_in_range("x", 0, 1), q.freshness("t")]
    rows = q.run_checks(frame(spark, ROWS).limit(0), rules, now()).collect()
    assert [r.passed for r in rows] == [True, True, True, False, True, False]
    assert [r.failure_pct for r in rows[:3]] == [0.0, 0.0, 0.0] and {r.total_records for r in rows} == {0}


def test_suite_has_thirteen_checks_in_order():
    names = [r.name for r in q.default_rules()]
    assert len(names) == 13 and names[0] == "not_null_coin_id" and names[-1] == "freshness_batch_ingested_at"
    assert "gte_total_volume_0" in names
    assert "gt_total_volume_0" in [r.name for r in q.default_rules(strict_volume=True)]


def test_rules_from_config():
    rules = q.rules_from_config([
        {"column": "x", "check": "not_null"}, {"column": "x", "check": "greater_than", "value": 0},
        {"columns": ["id", "t"], "check": "no_duplicates", "max_dup_pct": 2.0},
        {"column": "x", "check": "in_range", "low": 0, "high": 1}])
    assert rules == [q.not_null("x"), q.greater_than("x", 0), q.no_duplicates(["id", "t"], 2.0),
                     q.value_in_range("x", 0, 1)]
    with pytest.raises(ValueError):
        q.rules_from_config([{"column": "x", "check": "is_nice"}])


def test_row_rules_share_one_scan(spark, scratch):
    frame(spark, ROWS).write.parquet(f"{scratch}/t")
    rules = [q.not_null("x"), q.greater_than("x", 0), q.value_in_range("x", 0, 1), q.freshness("t")]
    plan = q.run_checks(spark.read.parquet(f"{scratch}/t"), rules, now())._jdf.queryExecution().executedPlan()
    assert plan.toString().count("FileScan") == 1


def test_report(spark, scratch):
    results = q.run_checks(frame(spark, ROWS), [q.not_null("x", 50.0), q.greater_than("x", 0)], now())
    q.write_report(q.build_report(results, "sample", now()), f"{scratch}/reports")
    name, = [n for n in os.listdir(f"{scratch}/reports") if n.endswith(".json")]
    with open(f"{scratch}/reports/{name}") as f:
        report = json.loads(f.read())
    assert (report["dataset"], report["total_checks"], report["passed"], report["failed"]) == ("sample", 2, 1, 1)
    assert report["overall_pass"] is False and report["run_id"] and report["run_at"].startswith("2024-06-15T12:00")
    assert [r["check_type"] for r in report["results"]] == ["NOT_NULL", "GREATER_THAN"]
    lines = [r.line for r in q.summary_lines(results).collect()]
    assert lines[0].startswith("✅ [NOT_NULL] x: ") and lines[1].startswith("❌ [GREATER_THAN] x: ")


def test_stale_data_is_singled_out(spark):
    results = q.run_checks(frame(spark, ROWS), [q.freshness("t", 1)], now())
    assert q.summary_lines(results, mark_stale=True).first().line.startswith("⚠️ STALE [FRESHNESS]")


def test_percentages_of_the_configuration(spark):
    rows = spark.createDataFrame([("a", 1.0)] * 9 + [(None, 1.0)], "coin_id string, x double")
    declared = [{"column": "coin_id", "check": "not_null"}, {"column": "x", "check": "not_null"},
                {"columns": ["x"], "check": "no_duplicates"}]
    def passed(**limits):
        return [r.passed for r in q.run_checks(rows, q.rules_from_config(declared, **limits)).collect()]
    assert passed() == [False, True, False]
    assert passed(max_null_pct_allowed=10.0, max_duplicate_pct_allowed=95.0) == [True, True, True]


def test_report_as_text(spark):
    rows = spark.createDataFrame([("a",), (None,)], "coin_id string")
    results = q.run_checks(rows, q.rules_from_config([{"column": "coin_id", "check": "not_null"}]))
    lines = [r.line for r in q.report_lines(
        q.build_report(results, "silver")).orderBy("line_no").collect()]
    assert lines[0].endswith("FAILED") and lines[2] == "Dataset: silver"
    assert lines[4] == "Checks: 1, passed: 0, failed: 1" and lines[5].startswith("❌ [NOT_NULL] coin_id: ")
