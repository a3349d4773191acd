"""Exact sums in any order, and answers that follow new lines and new documents."""

import json
import math
import random
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillroll.checks import views
from tillroll.checks.queries import QUERIES
from tillroll.operators import exact, layout
from tillroll.plans import kept, retail
from tillroll.plans.run_report import run_summary
from tillroll.sources import documents
from tillroll.streaming.run_summaries import read_summaries, update_summaries

from .conftest import plan_of


def hard_values():
    rng = random.Random(1)
    return {
        "money": [round(rng.uniform(-1e4, 1e4), 2) for _ in range(4000)],
        "wide": [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-300, 300) for _ in range(1500)],
        "beyond 16 digits": [12_345_678_901_234_567_890.12, 0.01, 0.01] * 7,
        "cancel": [1e300, 1.0, -1e300, 1e-300],
        "minus": [-1.0, 2.0**64, -(2.0**64), -(2.0**-70)],
        "smallest": [5e-324] * 7 + [-5e-324] * 3,
        "largest": [1.7976931348623157e308, -1e292, 1e291],
        "tie up": [1.0, 2.0**-53, 2.0**-200],
        "tie even": [1.0, 2.0**-53],
        "all limbs": [2.0 ** (32 * j) for j in range(-33, 32)] + [-(2.0 ** (32 * j - 1)) for j in range(-33, 32)],
        "zero": [0.0, -0.0],
        "some": [None, 2.5],
        "none": [None, None],
    }


def value_rows():
    return [(k, v) for k, values in hard_values().items() for v in values]


def test_totals_are_the_nearest_doubles(spark):
    frame = spark.createDataFrame(value_rows(), "k string, v double").repartition(5)
    got = {r.k: r.s for r in exact.totals(exact.sum_states(frame, ["k"], "v"), ["k"], "s").collect()}
    for k, values in hard_values().items():
        present = [v for v in values if v is not None]
        assert got[k] == (math.fsum(present) if present else None), k


def test_values_that_are_not_finite(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("up", inf), ("up", 1.0), ("down", -inf), ("both", inf), ("both", -inf), ("nan", nan), ("nan", inf), ("over", 1.7e308), ("over", 1.7e308)]
    frame = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.s for r in exact.totals(exact.sum_states(frame, ["k"], "v"), ["k"], "s").collect()}
    assert got["up"] == got["over"] == inf and got["down"] == -inf
    assert math.isnan(got["both"]) and math.isnan(got["nan"])


def test_equal_bits_over_ten_partitionings(spark):
    frame = spark.createDataFrame(value_rows(), "k string, v double")
    seen = set()
    for n in range(1, 11):
        dealt = frame.repartition(n, F.xxhash64("v", F.lit(n)))
        seen.add(tuple(sorted((r.k, str(r.s)) for r in exact.totals(exact.sum_states(dealt, ["k"], "v"), ["k"], "s").collect())))
    assert len(seen) == 1


def test_merged_states_are_states_of_all(spark):
    """In halves, by finer keys, and merged twice."""
    frame = spark.createDataFrame(value_rows(), "k string, v double").withColumn("half", F.pmod(F.xxhash64("v"), F.lit(2)))
    parts = [exact.sum_states(frame.filter(F.col("half") == h), ["k", "half"], "v", lines=F.lit(1)) for h in (0, 1)]
    merged = exact.merge_states(parts[0].unionByName(parts[1]), ["k"], ["lines"])
    got = exact.totals(exact.merge_states(merged, ["k"], ["lines"]), ["k"], "s", ["lines"])
    whole = exact.totals(exact.sum_states(frame, ["k"], "v", lines=F.lit(1)), ["k"], "s", ["lines"])
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))


# --- answers that follow the lines ------------------------------------------------------


def answers(kind):
    return [[tuple(r) for r in part.collect()] for part in kind]


def test_appended_batches_answer_like_all_lines(spark, sf_dir, tmp_path):
    lines = views.retail_lines(spark, sf_dir)
    path, whole = str(tmp_path / "states"), str(tmp_path / "whole")
    kept.append_lines(lines, whole, "all")
    years = sorted(r[0] for r in lines.select("SourceSheet").distinct().collect())
    for year in years:  # a batch per sheet
        kept.append_lines(lines.filter(F.col("SourceSheet") == year), path, year)
    got, expected = answers(kept.kept_answers(spark, path)), answers(kept.kept_answers(spark, whole))
    assert got == expected and got[1]
    full = answers(retail.answer_all(lines))
    assert got[0] == full[0] and got[2] == full[2]
    kept.compact_states(spark, path, str(tmp_path / "compact"))
    assert answers(kept.kept_answers(spark, str(tmp_path / "compact"))) == got


def test_a_repeated_batch_counts_once(spark, sf_dir, tmp_path):
    lines = views.retail_lines(spark, sf_dir)
    path = str(tmp_path / "states")
    kept.append_lines(lines.limit(100), path, "late")
    kept.append_lines(lines.filter("Quantity > 10"), path, "first")
    kept.append_lines(lines.filter("not Quantity > 10 or Quantity is null"), path, "late")
    assert kept.kept_answers(spark, path).counts.first().raw_count == lines.count()


def test_appending_reads_no_earlier_lines(spark, sf_dir, tmp_path):
    plan = plan_of(kept.line_states(views.retail_lines(spark, sf_dir)))
    assert "states" not in plan
    assert plan.count("Exchange hashpartitioning(sale") == 1


# --- buckets ----------------------------------------------------------------------------


def test_buckets_outlive_a_session(spark, tmp_path, settings):
    """One country on 90 % of the rows; the first grouping has no exchange below it."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    hot = F.col("id") % 10 > 0
    lines = spark.range(0, 50_000, 1, 4).select(
        F.when(hot, "hot").when(F.col("id") % 70 == 0, None).otherwise(F.concat(F.lit("c"), F.col("id") % 7)).alias("country"),
        (F.xxhash64("id") % 10_000 / 4).alias("revenue"),
    )
    path = str(tmp_path / "buckets")
    layout.write_buckets(lines, "kept_lines", path, "country", 8)
    again = layout.open_buckets(spark.newSession(), "kept_lines_again", path, "country", 8)
    answer = retail.country_revenue_of_buckets(again)
    plan = plan_of(answer)
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("keys=[country#", plan.index("Exchange")) < plan.index("slot#")
    below = plan.split("Exchange")[1]
    assert below.count("HashAggregate") == 3 and "partial_sum(orders" in below  # the exchange has a row per country and slot
    assert sorted(map(str, answer.collect())) == sorted(map(str, retail.country_revenue(lines).collect()))
    files = spark.read.parquet(path).filter("country = 'hot'").select("_metadata.file_path").distinct().count()
    assert files > 3  # the hot country is in several buckets
    shares = spark.read.parquet(path).filter("country = 'hot'").groupBy("slot").count().collect()
    assert len(shares) == 8 and max(r["count"] for r in shares) < 1.2 * min(r["count"] for r in shares)


def test_bucketed_tables_join_without_exchange(spark, tmp_path, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    left = spark.range(1000).select((F.col("id") % 50).alias("k"), F.col("id").alias("x"))
    for name in ("bucket_a", "bucket_b"):
        layout.write_buckets(left, name, str(tmp_path / name), "k", 4, hot_share=0.5)
    both = spark.table("bucket_a").join(spark.table("bucket_b").withColumnRenamed("x", "y"), ["k", "slot"])
    assert both.count() == 50 * 20 * 20
    assert "Exchange" not in plan_of(both)


# --- documents --------------------------------------------------------------------------


def test_a_repeated_run_replaces_only_its_own_documents(spark, tmp_path):
    path = str(tmp_path / "documents")
    make = lambda *rows: spark.createDataFrame(rows, "run_label string, row_count long")
    documents.write_documents_by_label(make(("a", 1), ("a", 2), ("b/ü =", 3), ("7", 4)), path)
    documents.write_documents_by_label(make(("a", 9)), path)
    read = documents.read_documents_by_label(spark, path)
    assert sorted((r.run_label, r.row_count) for r in read.collect()) == [("7", 4), ("a", 9), ("b/ü =", 3)]
    one = read.filter("run_label = 'a'")
    assert [r.row_count for r in one.collect()] == [9]
    assert "PartitionFilters: [isnotnull(run_label" in one._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_many_labels_share_files(spark, tmp_path):
    path = tmp_path / "documents"
    make = lambda *rows: spark.createDataFrame(rows, "run_label string, row_count long")
    write = lambda *rows: documents.write_documents_by_label(make(*rows), str(path), labels_apart=3)
    read = lambda: documents.read_documents_by_label(spark, str(path))
    held = lambda: sorted((r.run_label or "-", r.row_count) for r in read().collect())
    write(*[(str(n), n) for n in range(2_000)], (None, 1), (None, 2), ("b/ü =%", 3))
    assert len([p for p in path.rglob("*") if p.is_dir()]) < 10
    assert len(held()) == 2_003
    write(("b/ü =%", 7), (None, 8), ("17", 9))  # few: partitions, before the batch
    assert held() == sorted([(str(n), n) for n in range(2_000) if n != 17] + [("-", 8), ("b/ü =%", 7), ("17", 9)])
    write(("b/ü =%", 4), (None, 5), ("18", 6), ("new", 0), ("new", 1))  # many: a second batch, before both
    expected = [(str(n), n) for n in range(2_000) if n not in (17, 18)]
    expected += [("b/ü =%", 4), ("-", 5), ("17", 9), ("18", 6), ("new", 0), ("new", 1)]
    assert held() == sorted(expected)
    assert [r.row_count for r in read().filter("run_label = '17'").collect()] == [9]


def document(label, number, seconds):
    return json.dumps({"run_label": label, "document_no": number, "total_runtime_sec": seconds, "actions": []})


def test_only_new_documents_are_read(spark, tmp_path):
    source, target, checkpoint = (tmp_path / n for n in ("in", "summary", "checkpoint"))
    source.mkdir()
    for label, seconds in (("a", 1.0), ("b", 2.0), ("c", 3.0)):
        (source / f"{label}_metrics.json").write_text(document(label, 0, seconds))
    (source / "notes.json").write_text("{}")
    follow = lambda: update_summaries(spark, str(source), str(target), str(checkpoint), files_per_batch=2)
    follow()
    assert [r.time_total_sec for r in read_summaries(spark, str(target)).orderBy("run_label").collect()] == [1.0, 2.0, 3.0]
    before = {p: p.stat().st_mtime_ns for p in target.rglob("*.parquet")}
    follow()
    assert {p: p.stat().st_mtime_ns for p in target.rglob("*.parquet")} == before
    # a later file with an old label, and an earlier one that must not win although it comes later
    (source / "d_metrics.json").write_text(document("a", 0, 8.0))
    (source / "a0_metrics.json").write_text(document("c", 0, 9.0))
    follow()
    assert all(p.stat().st_mtime_ns == before[p] for p in before)
    got = {r.run_label: r.time_total_sec for r in read_summaries(spark, str(target)).collect()}
    assert got == {"a": 8.0, "b": 2.0, "c": 3.0}
    whole = run_summary(documents.read_run_documents(spark, str(source)))
    assert sorted(map(str, whole.collect())) == sorted(map(str, read_summaries(spark, str(target)).collect()))


def test_documents_that_arrive_share_files(spark, tmp_path):
    """As many files as blocks of events in each delivery, however many documents they hold."""
    n = F.col("id")
    events = spark.range(3_000).select(
        n.alias("event_id"),
        F.timestamp_seconds(n).cast("timestamp_ntz").alias("ts"),
        F.when(n % 11 != 0, n % 301).alias("user_id"),
        F.lit("view").alias("event_type"),
        (n * 1.0).alias("value"),
        F.lit('{"k": 1}').alias("props"),
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    earlier = set(arrived(spark))
    got = QUERIES["run_summary_followed"](spark, str(tmp_path)).collect()
    expected = QUERIES["run_summary"](spark, str(tmp_path)).filter("run_label is not null").collect()
    assert len(got) > 800 and sorted(map(str, got)) == sorted(map(str, expected))
    (folder,) = set(arrived(spark)) - earlier
    named = [p for p in folder.rglob("*.json") if "_metrics.json" in p.parent.name]
    assert len(named) <= 2 * 3


def arrived(spark):
    return Path(spark.conf.get("spark.checkpoint.dir")).glob("arriving-documents-*")
