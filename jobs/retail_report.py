"""spark-submit job: retail lines as delimited text to both revenue answers.

    spark-submit --py-files tillroll.zip jobs/retail_report.py \
        --input hdfs:///data/lines.csv --output hdfs:///reports/today

Writes `<output>/<run label>_metrics.json` (a folder with one JSON run document: row
count, both samples, and the seconds of each step) and `<output>/monthly` (all months,
not only the earliest twelve). `run_comparison.py` reads such documents.
"""

from __future__ import annotations

import argparse
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tillroll.functions.runs import COUNT_LABEL, GROUPS_LABEL, MONTHS_LABEL, TOP_LABEL
from tillroll.operators.revenue import counts_of_groups, countries_of_groups, in_calendar_order, months_of_groups, top_by_revenue
from tillroll.plans.retail import RetailAnswers, group_lines
from tillroll.plans.run_report import run_document
from tillroll.session import build_session
from tillroll.sources.delimited import read_lines, read_lines_inferred
from tillroll.sources.documents import write_run_documents
from tillroll.sources.staging import delete_staged


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser()
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--app-name", default="tillroll")
    parser.add_argument("--run-label", default="retail")
    parser.add_argument("--infer-schema", action="store_true")
    parser.add_argument("--multi-line", action="store_true")
    parser.add_argument("--exact", action="store_true", help="add up decimals instead of doubles")
    parser.add_argument(
        "--count-clean", action="store_true", help="the document counts clean lines, not raw ones"
    )
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    started = time.perf_counter()
    steps: list[tuple[str, float]] = []

    def timed(label: str, step: Callable):
        begun = time.perf_counter()
        result = step()
        steps.append((label, round(time.perf_counter() - begun, 3)))
        return result

    read = read_lines_inferred if args.infer_schema else read_lines
    raw = timed("create dataframe", lambda: read(spark, args.input, multi_line=args.multi_line))
    # The one scan; what follows reads its small table, and each answer is fetched once.
    # A name of its own, so that no other run's groups go with it, whatever the label.
    scratch = f"report-groups-{uuid.uuid4().hex}"
    groups = timed(GROUPS_LABEL, lambda: group_lines(raw, exact=args.exact, name=scratch))
    try:
        answers = RetailAnswers(
            counts=counts_of_groups(groups),
            countries=top_by_revenue(countries_of_groups(groups)),
            months=in_calendar_order(months_of_groups(groups)),
        )
        counted = "clean_count" if args.count_clean else "raw_count"
        counts = timed(COUNT_LABEL, lambda: answers.counts.select(F.col(counted).alias("row_count")).collect())
        top = timed(TOP_LABEL, answers.countries.collect)
        months = timed(MONTHS_LABEL, answers.months.limit(12).collect)
        answers.months.write.json(f"{args.output}/monthly")
        total = round(time.perf_counter() - started, 3)
        actions = [F.struct(F.lit(x).alias("label"), F.lit(s).alias("duration_sec")) for x, s in steps[1:]]
        document = run_document(
            args.run_label,
            spark.createDataFrame(counts, "row_count long"),
            spark.createDataFrame(top, answers.countries.schema),
            spark.createDataFrame(months, answers.months.schema),
            document_no=F.lit(time.time_ns() // 1000),
            app_name=F.lit(args.app_name),
            input=F.lit(args.input),
            dataframe_creation_sec=F.lit(steps[0][1]),
            total_runtime_sec=F.lit(total),
            actions=F.array(*actions),
        )
        write_run_documents(document.coalesce(1), f"{args.output}/{args.run_label}_metrics.json")
    finally:
        delete_staged(spark, scratch)


if __name__ == "__main__":
    arguments = parse_args()
    session = build_session(arguments.app_name)
    try:
        run(session, arguments)
    finally:
        session.stop()
