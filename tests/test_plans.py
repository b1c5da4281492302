"""What the plans look like: shuffles, scans and evaluations."""

import re

from pyspark.sql import functions as F

from listwright.operators import dedupe, emails, joins, ordering, stats
from listwright.plans.consolidate import consolidate, consolidate_emails, stats_total
from listwright.sources import manifest

LINES = "source string, file string, line_no long, original string, unused string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored_lines(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.createDataFrame([("s1", "f", 0, "A", "x")], LINES).write.parquet(path)
    return spark.read.parquet(path)


def registry(spark):
    return spark.createDataFrame([("s1", 0), ("s2", 1)], "slug string, priority int")


def shuffles(plan):
    return len(re.findall(r"Exchange (?:hash|range|Single|RoundRobin)", plan))


def test_consolidate_shuffles_once(spark, tmp_path):
    plan = plan_of(consolidate(stored_lines(spark, tmp_path), registry(spark), keep_original=True))
    # One shuffle of the lines; the registry is counted on the side.
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
    before, after = plan.split("Exchange hashpartitioning(nick", 1)
    assert "partial_min" in after
    assert "unused" not in plan and "Window" not in plan and "Python" not in plan


def test_each_normaliser_step_is_evaluated_once(spark, tmp_path):
    plan = plan_of(dedupe.normalize_names(stored_lines(spark, tmp_path)).select("nick"))
    assert plan.count("regexp_replace(") == 1
    assert plan.count("Contains(") == 1
    assert plan.count("translate(nick") == 3  # letters once, the whitelist is two calls
    assert "ReadSchema: struct<original:string>" in plan


def test_one_shuffle_for_all_email_parts(spark, tmp_path):
    lines = stored_lines(spark, tmp_path)
    names = dedupe.normalize_names(lines)
    assert shuffles(plan_of(consolidate_emails(lines, names))) == 1
    parsed = emails.parse_emails(lines)
    assert "PushedFilters: [IsNotNull(original), StringContains(original,@)]" in plan_of(parsed)
    assert shuffles(plan_of(emails.export_stats(names, parsed))) == 2  # values, one total row


def test_totals_come_from_one_pass(spark, tmp_path):
    plan = plan_of(stats_total(stored_lines(spark, tmp_path), registry(spark)))
    assert plan.count("FileScan") == 1


def test_incremental_reduces_both_sides_first(spark, tmp_path):
    lines = stored_lines(spark, tmp_path).withColumnRenamed("original", "nick")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(dedupe.incremental_new(lines, lines.where("nick > 'a'")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffles(plan) == 2 and plan.count("HashAggregate") == 4


def test_counts_come_before_the_join(spark, tmp_path):
    raw = stored_lines(spark, tmp_path)
    binary = spark.createDataFrame([("f",)], "file string")
    join, scan = plan_of(stats.raw_counts(raw, binary)).split("HashAggregate", 1)
    assert "LeftAnti" in join and "FileScan" in scan


def test_manifest_does_not_read_contents(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.txt").write_text("x")
    plan = plan_of(manifest.scan_manifest(spark, str(tmp_path)))
    assert "content" not in plan


def test_ordinals_are_read_not_computed(spark):
    df = spark.range(100).select(F.col("id").alias("line_no"))
    plan = plan_of(ordering.global_ordinal(df, ("line_no",)))
    assert shuffles(plan) == 0 and "Window" not in plan and "Sort" not in plan


def test_original_forms_come_from_one_pass(spark, tmp_path):
    lines = joins.with_priority(stored_lines(spark, tmp_path), registry(spark), how="left")
    plan = plan_of(joins.original_forms(dedupe.normalize_names(lines)))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
