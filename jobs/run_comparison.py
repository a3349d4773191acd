"""spark-submit job: run-metrics documents to one comparison table.

    spark-submit --py-files tillroll.zip jobs/run_comparison.py \
        --input hdfs:///reports --output hdfs:///comparison

Reads what `retail_report.py` wrote: every `*_metrics.json`, a file or a folder of
parts, below the input.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tillroll.plans.run_report import run_summary
from tillroll.session import build_session
from tillroll.sources.documents import DOCUMENT_NAMES, read_run_documents, write_run_summary


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser()
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--name", default=DOCUMENT_NAMES, help="regular expression for the paths of documents")
    parser.add_argument("--json-lines", action="store_true", help="several documents per file")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    documents = read_run_documents(spark, args.input, args.name, one_per_file=not args.json_lines)
    if documents.isEmpty():
        raise FileNotFoundError(f"no run documents below {args.input}")
    write_run_summary(run_summary(documents), args.output)


if __name__ == "__main__":
    session = build_session("tillroll-comparison")
    try:
        run(session, parse_args())
    finally:
        session.stop()
