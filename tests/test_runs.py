import json

import pytest
from pyspark.sql import functions as F

from tillroll.functions import runs as f
from tillroll.operators import runs
from tillroll.plans.retail import country_revenue, monthly_revenue
from tillroll.plans.run_report import run_document, run_summary
from tillroll.schemas import RUN_DOCUMENT
from tillroll.sources.documents import read_run_documents, write_run_documents, write_run_summary

COUNT, CACHE = "count input rows", "materialize cached dataframe"
TOP, MONTHS = "top countries by revenue", "monthly revenue by source sheet"

# Published values: total, count or cache seconds, both query seconds, megabytes.
PUBLISHED = {
    "1DataNode": (37.425, 2.11, 7.183, 7.032, 0.44),
    "1DataNode_opt": (33.997, 21.899, 2.656, 3.305, 17.15),
    "3DataNode": (40.227, 2.668, 6.899, 6.567, 0.36),
    "3DataNode_opt": (35.224, 22.925, 3.164, 2.857, 17.15),
    "3DataNode_2Workers": (38.797, 2.384, 6.914, 5.45, 0.6),
    "3DataNode_2Workers_opt": (34.89, 22.223, 2.952, 2.844, 17.25),
}
WORK = dict(zip(PUBLISHED, (14.215, 5.961, 13.466, 6.021, 12.364, 5.796)))


def action(label, seconds, *used):
    return {
        "label": label,
        "duration_sec": seconds,
        "job_stage_info": {
            "job_ids": [2, 3],
            "jobs": [
                {"job_id": 2, "stage_ids": [4], "stages": [{"stage_id": 4, "name": "count", "num_tasks": 2}]},
                {"job_id": 3, "stage_ids": [], "stages": []},
            ],
        },
        "memory_snapshot": {
            "driver_max_rss_mb": 132.5,
            "executors": [
                {"executor": f"e{i}", "max_mb": 434.4, "used_mb": u, "remaining_mb": 434.4 - u}
                for i, u in enumerate(used)
            ],
        },
    }


def document(label, actions, total=1.0):
    return {"run_label": label, "app_name": "retail", "total_runtime_sec": total, "actions": actions}


def published(label):
    total, prepare, top, months, used = PUBLISHED[label]
    first = action(CACHE if label.endswith("_opt") else COUNT, prepare, 99.0)
    # the second executor's share is any split of the published sum
    return document(label, [first, action(TOP, top, 5.0), action(MONTHS, months, used - 0.1, 0.1)], total)


def measured(spark, *documents):
    df = spark.createDataFrame([json.dumps(d) for d in documents], "string").select(
        F.lit("f").alias("file"), F.from_json("value", RUN_DOCUMENT).alias("d")
    )
    return runs.run_measures(df.select("file", "d.*"))


def save(folder, name, content):
    (folder / name).write_text(json.dumps(content, indent=2))


def test_published_summary(spark, tmp_path):
    for label in reversed(PUBLISHED):
        save(tmp_path, f"{label}_metrics.json", published(label))
    save(tmp_path, "comparison_summary.json", {"1DataNode": {"time_total_sec": 1}})
    got = run_summary(read_run_documents(spark, str(tmp_path))).collect()
    assert [tuple(r) for r in got] == [
        (label, total, prepare, WORK[label], used)
        for label, (total, prepare, _, _, used) in PUBLISHED.items()
    ]
    assert got[0].asDict().keys() == {
        "run_label", "time_total_sec", "time_preprocess_sec", "time_work_sec", "ram_consumption_mb"
    }


def test_first_of_repeated_labels_counts(spark):
    row = measured(spark, document("r", [action(COUNT, 1.0), action(COUNT, 9.0), action(TOP, 2.0), action(TOP, 3.0)])).first()
    assert (row.time_preprocess_sec, row.time_work_sec) == (1.0, 5.0)


def test_cache_of_zero_falls_through_to_the_count(spark):
    row = measured(spark, document("r", [action(CACHE, 0.0), action(COUNT, 4.0)])).first()
    assert row.time_preprocess_sec == 4.0


def test_nothing_to_measure_is_zero(spark):
    bare = {"run_label": "r"}
    nulls = document("r", [{"label": None, "duration_sec": None}], None)
    for row in measured(spark, document("r", [], None), bare, nulls).collect():
        assert tuple(row)[3:] == (0.0, 0.0, 0.0, 0.0)


def test_action_without_label_is_work(spark):
    row = measured(spark, document("r", [{"duration_sec": 2.5}])).first()
    assert row.time_work_sec == 2.5


def test_only_the_last_action_decides_memory(spark):
    acts = [action(TOP, 1.0, 50.0), action(TOP, 1.0, 0.3, 0.25)]
    assert measured(spark, document("r", acts)).first().ram_consumption_mb == 0.55
    assert measured(spark, document("r", [*acts, action(TOP, 1.0)])).first().ram_consumption_mb == 0.0


def test_last_file_wins(spark, tmp_path):
    save(tmp_path, "a_metrics.json", document("same", [action(TOP, 1.0)], 1.0))
    save(tmp_path, "b_metrics.json", document("same", [action(TOP, 2.0)], 0.5))
    got = run_summary(read_run_documents(spark, str(tmp_path))).collect()
    assert [(r.run_label, r.time_total_sec, r.time_work_sec) for r in got] == [("same", 0.5, 2.0)]


def test_last_document_of_one_file_wins_however_fast_it_was(spark, tmp_path):
    slow = document("same", [action(TOP, 9.0)], 9.0) | {"document_no": 1}
    fast = document("same", [action(TOP, 1.0)], 1.0) | {"document_no": 2}
    for lines in ([slow, fast], [fast, slow]):
        (tmp_path / "x_metrics.json").write_text("\n".join(map(json.dumps, lines)))
        got = run_summary(read_run_documents(spark, str(tmp_path), one_per_file=False)).collect()
        assert [(r.run_label, r.time_total_sec, r.time_work_sec) for r in got] == [("same", 1.0, 1.0)]


def test_every_measure_rounds_ties_to_even(spark):
    row = measured(spark, document("r", [action(COUNT, 0.0625), action(TOP, 0.3125, 0.125)], 0.1875)).first()
    assert tuple(row)[3:] == (0.188, 0.062, 0.312, 0.12)


def test_order_known_then_unknown(spark):
    labels = ["zeta", "3DataNode", "alpha", "1DataNode_opt", None]
    df = spark.createDataFrame([(n,) for n in labels], "run_label string")
    got = [(r.run_label, r.run_rank) for r in runs.in_run_order(df).collect()]
    assert got == [("1DataNode_opt", 1), ("3DataNode", 2), (None, 999), ("alpha", 999), ("zeta", 999)]


def test_flat_actions_and_stages(spark):
    docs = spark.createDataFrame(
        [json.dumps(document("r", [action(COUNT, 1.0), action(TOP, 2.0)])), json.dumps(document("none", []))],
        "string",
    ).select(F.lit("f").alias("file"), F.from_json("value", RUN_DOCUMENT).alias("d")).select("file", "d.*")
    flat = runs.flatten_actions(docs).orderBy("run_label", "pos").collect()
    assert [(r.run_label, r.pos, r.label) for r in flat] == [
        ("none", None, None), ("r", 0, COUNT), ("r", 1, TOP)
    ]
    stages = runs.flatten_stages(docs).filter("run_label = 'r'").orderBy("pos", "job_id").collect()
    assert [(r.pos, r.job_id, r.stage_id, r.num_tasks) for r in stages] == [
        (0, 2, 4, 2), (0, 3, None, None), (1, 2, 4, 2), (1, 3, None, None)
    ]


def test_executor_memory(spark):
    df = spark.createDataFrame(
        [([("b", 434_031_820, 433_901_820), ("a", 131_072, 0)],)],
        "status array<struct<executor:string,max_bytes:long,remaining_bytes:long>>",
    )
    got = df.select(F.explode(f.executor_memory(F.col("status"))).alias("e")).select("e.*").collect()
    # 131072 bytes are 0.125 MB: a tie, which goes to the even digit
    assert [tuple(r) for r in got] == [("a", 0.12, 0.12, 0.0), ("b", 413.92, 0.12, 413.8)]


def test_document_of_results(spark, tmp_path):
    lines = spark.createDataFrame(
        [("A", "s", None, 5.0), ("B", "s", None, 7.0)],
        "country string, source_sheet string, invoice_ts timestamp, revenue double",
    )
    made = run_document(
        "mine",
        lines.agg(F.count("*").alias("row_count")),
        country_revenue(lines),
        monthly_revenue(lines),
        app_name=F.lit("retail"),
        optimizations=F.struct(F.lit(True).alias("explicit_schema")),
    )
    write_run_documents(made, str(tmp_path / "out"))
    back = read_run_documents(spark, str(tmp_path / "out"), ".", one_per_file=False).first()
    assert (back.run_label, back.row_count, back.app_name) == ("mine", 2, "retail")
    assert back.optimizations.explicit_schema is True
    assert [tuple(c) for c in back.samples.top_countries_by_revenue] == [("B", 1, 7.0, 7.0), ("A", 1, 5.0, 5.0)]
    assert [tuple(m) for m in back.samples.monthly_revenue_sample] == [("s", None, 2, 12.0)]
    assert back.actions is None


def test_summary_sink(spark, tmp_path):
    save(tmp_path, "a_metrics.json", published("1DataNode"))
    summary = run_summary(read_run_documents(spark, str(tmp_path)))
    write_run_summary(summary, str(tmp_path / "summary"))
    assert spark.read.json(str(tmp_path / "summary")).select(*summary.columns).collect() == summary.collect()


def test_malformed_document_fails(spark, tmp_path):
    (tmp_path / "x_metrics.json").write_text("{not json")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_run_documents(spark, str(tmp_path)).collect()
