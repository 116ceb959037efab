from pyspark.sql import functions as F

from samples import record, silver_of
from snapmart.operators.quality import default_rules, run_checks
from snapmart.operators.quality_state import QualityState, hours_read
from snapmart.sources.silver import read_silver, write_silver

RULES = default_rules(min_entities=3)


def as_of():
    return F.lit("2024-06-03 12:00:00").cast("timestamp")


def at(day, hour):
    return f"2024-06-{day:02d}T{hour:02d}:05:00Z"


def rows(spark, day):
    return silver_of(spark, [
        (f"b{day}", at(day, 10), record()), (f"b{day}", at(day, 10), record()), (f"b{day}", at(day, 11), record(id="bb", name=None)),
        (f"b{day}", at(day, 11), record(id=f"c{day}", current_price=-1)), (f"u{day}", None, record(id="undated"))])


def agree(spark, state, silver):
    want = sorted(map(str, run_checks(read_silver(spark, silver), RULES, as_of()).collect()))
    got = state.verdicts(as_of())
    assert sorted(map(str, got.collect())) == want and got.count() == len(RULES)


def test_merged_states_equal_a_run_over_all(spark, scratch):
    silver, state = f"{scratch}/silver", QualityState(spark, f"{scratch}/state", RULES)
    write_silver(rows(spark, 1), silver, mode="append")
    state.refresh(silver)
    agree(spark, state, silver)
    for day in (2, 3):
        write_silver(rows(spark, day), silver, mode="append")
        state.refresh(silver, since=f"2024-06-{day:02d}")
        agree(spark, state, silver)
    # An old hour is written again: only that hour is worked out anew.
    write_silver(rows(spark, 1), silver, mode="append")
    state.refresh(silver, "2024-06-01 10:00:00", "2024-06-02")
    agree(spark, state, silver)
    state.refresh(silver, "2024-06-01 10:00:00", "2024-06-02")
    agree(spark, state, silver)


def test_old_hours_are_not_opened(spark, scratch):
    for day in (1, 2, 3):
        write_silver(rows(spark, day), scratch, mode="append")
    read = hours_read(spark, scratch, since="2024-06-03 11:00:00")
    files = {r[0].split(scratch)[1].rsplit("/", 1)[0] for r in read.select(F.input_file_name()).distinct().collect()}
    assert files == {"/year=2024/month=6/day=3/hour=11", "/" + "/".join(
        f"{c}=__HIVE_DEFAULT_PARTITION__" for c in ("year", "month", "day", "hour"))}

