"""spark-submit job: a workbook, or a folder of them, to delimited retail lines.

    spark-submit --py-files tillroll.zip jobs/workbook_ingest.py \
        --input hdfs:///in/retail.xlsx --output hdfs:///data/lines.csv
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tillroll.plans.ingest import ingest_workbooks
from tillroll.schemas import RAW_LINES
from tillroll.session import build_session
from tillroll.sources.delimited import write_lines
from tillroll.sources.staging import delete_staged


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser()
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument(
        "--retail-header",
        action="store_true",
        help="take the eight retail columns by position instead of looking at the headers",
    )
    parser.add_argument(
        "--multi-line", action="store_true", help="allow line breaks in fields; readers need the same option"
    )
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    columns = RAW_LINES.names[:-1] if args.retail_header else None
    scratch = f"ingest-records-{uuid.uuid4().hex}"
    try:
        table = ingest_workbooks(spark, args.input, columns, scratch).drop("workbook", "sheet_no", "row_no")
        write_lines(table, args.output, line_breaks=args.multi_line)
    finally:
        delete_staged(spark, scratch)


if __name__ == "__main__":
    session = build_session("tillroll-ingest")
    try:
        run(session, parse_args())
    finally:
        session.stop()
