import json
import os

import pytest

from jobs import retail_report, run_comparison, workbook_ingest
from tests.test_runs import published, save
from tests.test_workbook import retail_book


def lines_of(folder):
    return [json.loads(x) for p in folder.glob("*.json") for x in p.read_text().splitlines()]


def test_workbook_to_report(spark, tmp_path):
    retail_book(tmp_path / "retail.xlsx")
    for name, options in {"read": [], "given": ["--retail-header"]}.items():
        csv = str(tmp_path / f"{name}.csv")
        arguments = ["--input", str(tmp_path / "retail.xlsx"), "--output", csv, *options]
        workbook_ingest.run(spark, workbook_ingest.parse_args(arguments))
    reports = {}
    for name, options in {"plain": [], "clean": ["--count-clean"], "inferred": ["--infer-schema"]}.items():
        out = tmp_path / name
        arguments = ["--input", str(tmp_path / "read.csv"), "--output", str(out), *options]
        retail_report.run(spark, retail_report.parse_args(arguments))
        reports[name] = lines_of(out / "retail_metrics.json")[0]
        assert len(lines_of(out / "monthly")) == 2
    assert reports["plain"]["row_count"] == reports["inferred"]["row_count"] == 5
    assert reports["clean"]["row_count"] == 3
    assert reports["plain"]["samples"] == reports["clean"]["samples"] == reports["inferred"]["samples"]
    assert [c["country"] for c in reports["plain"]["samples"]["top_countries_by_revenue"]] == ["United Kingdom", "EIRE"]
    given = spark.read.csv(str(tmp_path / "given.csv"), header=True)
    assert given.exceptAll(spark.read.csv(str(tmp_path / "read.csv"), header=True)).count() == 0


def test_comparison(spark, tmp_path):
    save(tmp_path, "a_metrics.json", published("3DataNode"))
    arguments = ["--input", str(tmp_path), "--output", str(tmp_path / "out")]
    run_comparison.run(spark, run_comparison.parse_args(arguments))
    assert lines_of(tmp_path / "out")[0]["time_work_sec"] == 13.466


def test_report_then_comparison(spark, tmp_path):
    retail_book(tmp_path / "retail.xlsx")
    csv = str(tmp_path / "lines.csv")
    workbook_ingest.run(spark, workbook_ingest.parse_args(["--input", str(tmp_path / "retail.xlsx"), "--output", csv]))
    for label, options in {"plain": [], "exact": ["--exact"]}.items():
        arguments = ["--input", csv, "--output", str(tmp_path / "reports" / label), "--run-label", label, *options]
        retail_report.run(spark, retail_report.parse_args(arguments))
    arguments = ["--input", str(tmp_path / "reports"), "--output", str(tmp_path / "comparison")]
    run_comparison.run(spark, run_comparison.parse_args(arguments))
    got = {r["run_label"]: r for r in lines_of(tmp_path / "comparison")}
    assert got.keys() == {"plain", "exact"}
    for row in got.values():
        assert row["time_total_sec"] > row["time_work_sec"] > 0 and row["time_preprocess_sec"] > 0
    staged = os.listdir(spark.conf.get("spark.checkpoint.dir"))
    assert not any(name.startswith(("report-groups", "ingest-records")) for name in staged)


def test_comparison_of_nothing_fails(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "comparison_summary.json").write_text("{}")
    arguments = ["--input", str(tmp_path / "in"), "--output", str(tmp_path / "out")]
    with pytest.raises(FileNotFoundError, match="no run documents"):
        run_comparison.run(spark, run_comparison.parse_args(arguments))
