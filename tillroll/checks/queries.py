"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.checks import books, views
from tillroll.checks.scratch import use_local_scratch
from tillroll.functions import runs as run_functions
from tillroll.functions import sheet as sheet_functions
from tillroll.operators import layout, runs, sheets
from tillroll.operators.clean import clean_lines, normalize_columns
from tillroll.operators.revenue import row_count
from tillroll.plans import kept, retail
from tillroll.plans.ingest import ingest_workbooks, stacked_sheets
from tillroll.plans.run_report import run_document, run_summary
from tillroll.sources import delimited, documents, sheet_parts, workbook_source
from tillroll.sources.staging import staged, staging_path
from tillroll.streaming import run_summaries

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_local_scratch(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        return function

    return register


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.retail_lines(spark, sf_dir).transform(clean_lines)


# --- retail -------------------------------------------------------------------


@query("raw_row_count")
def raw_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(views.retail_lines(spark, sf_dir))


@query("clean_row_count")
def clean_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(_clean(spark, sf_dir))


@query("normalize_columns")
def normalize_columns_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.retail_text_lines(spark, sf_dir).transform(normalize_columns)


@query("clean_lines")
def clean_lines_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir)


@query("line_revenue")
def line_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.retail_lines(spark, sf_dir).transform(normalize_columns)
    return lines.select("invoice_no", "stock_code", "price", "revenue")


@query("country_revenue")
def country_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.country_revenue(_clean(spark, sf_dir))


@query("monthly_revenue")
def monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.monthly_revenue(_clean(spark, sf_dir))


@query("monthly_revenue_all")
def monthly_revenue_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.monthly_revenue(_clean(spark, sf_dir), k=None)


@query("country_revenue_exact")
def country_revenue_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.answer_all(views.retail_lines(spark, sf_dir), exact=True).countries


@query("csv_infer_roundtrip")
def csv_infer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "lines-csv")
    delimited.write_lines(views.retail_lines(spark, sf_dir), path)
    return delimited.read_lines_inferred(spark, path).transform(clean_lines)


@query("csv_schema_roundtrip")
def csv_schema_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "lines-csv")
    delimited.write_lines(views.retail_lines(spark, sf_dir), path)
    return delimited.read_lines(spark, path).transform(clean_lines)


@query("csv_once_roundtrip")
def csv_once_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "lines-csv")
    delimited.write_lines(views.retail_lines(spark, sf_dir), path)
    return delimited.read_lines_once(spark, path).transform(clean_lines)


@query("csv_rejects")
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines read as typed ones: which columns did not parse, and how many lines came through."""
    path = staging_path(spark, "text-lines-csv")
    delimited.write_lines(views.retail_text_lines(spark, sf_dir), path)
    rows, rejects = delimited.read_lines_checked(spark, path)
    causes = rejects.groupBy(F.array_join("columns", ", ").alias("columns")).agg(F.count("*").alias("lines"))
    measured = F.count("*").alias("lines")
    return (
        causes.withColumn("what", F.lit("rejected"))
        .unionByName(rows.agg(measured).select(F.lit("").alias("columns"), "lines", F.lit("all rows").alias("what")))
        .unionByName(
            rows.filter(F.col("Quantity").isNotNull() & F.col("Price").isNotNull())
            .agg(measured)
            .select(F.lit("").alias("columns"), "lines", F.lit("with quantity and price").alias("what"))
        )
    )


@query("kept_country_revenue")
def kept_country_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(spark, sf_dir).countries


@query("kept_monthly_revenue")
def kept_monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(spark, sf_dir).months


def _kept(spark: SparkSession, sf_dir: str) -> retail.RetailAnswers:
    """Answers from three batches of lines, the second of which came in full only when it was repeated."""
    path = staging_path(spark, "line-states")
    lines = views.retail_lines(spark, sf_dir)
    share = F.pmod(F.xxhash64("Invoice"), F.lit(3))
    kept.append_lines(lines.filter(share == 0), path, "first")
    kept.append_lines(lines.filter((share == 1) & (F.col("Quantity") > 20)), path, "second")
    kept.append_lines(lines.filter(share == 2), path, "third")
    kept.append_lines(lines.filter(share == 1), path, "second")
    return kept.kept_answers(spark, path)


@query("bucketed_country_revenue")
def bucketed_country_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top countries over a bucketed table, opened by its place as another session would."""
    path = staging_path(spark, "lines-by-bucket")
    name = "lines_" + path.rsplit("-", 1)[1]
    lines = _clean(spark, sf_dir).select(*layout.QUERY_COLUMNS)
    layout.write_buckets(lines, name, path, "country", 16)
    return retail.country_revenue_of_buckets(layout.open_buckets(spark, f"{name}_again", path, "country", 16))


@query("layout_by_country")
def layout_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _clean(spark, sf_dir).select(*layout.QUERY_COLUMNS)
    clustered = staged(layout.cluster_by(lines, "country"), "lines-by-country")
    with layout.persisted(clustered) as cached:
        layout.materialize(cached)
        # ten rows, written before the cache goes
        return staged(retail.country_revenue(cached), "country-revenue")


@query("layouts_compared")
def layouts_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both questions over the same lines in each layout: by key, spread evenly, clustered."""
    lines = staged(_clean(spark, sf_dir).select(*layout.QUERY_COLUMNS), "lines-to-lay-out")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    layouts = {
        "by key": layout.partition_by_key(lines, "country", partitions),
        "even": layout.spread_evenly(lines, partitions),
        "clustered": staged(layout.cluster_by(lines, "country"), "lines-by-country"),
    }
    answers = []
    for name, laid_out in layouts.items():
        countries = retail.country_revenue(laid_out).select(
            F.lit(name).alias("layout"),
            F.lit("country").alias("question"),
            F.col("country").alias("name"),
            "orders",
            F.col("total_revenue").alias("revenue"),
        )
        months = retail.monthly_revenue(laid_out).select(
            F.lit(name).alias("layout"),
            F.lit("month").alias("question"),
            F.col("invoice_month").alias("name"),
            "orders",
            F.col("monthly_revenue").alias("revenue"),
        )
        answers += [countries, months]
    return reduce(DataFrame.unionByName, answers)


# --- workbooks ----------------------------------------------------------------


def _workbook_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder of workbook files made from the orders."""
    folder = staging_path(spark, "workbook-files")
    books_made = books.order_workbooks(views.table(spark, sf_dir, "orders"))
    workbook_source.write_files(books_made.withColumn("path", F.concat("path", F.lit(".xlsx"))), folder)
    return folder


def _named(table: DataFrame) -> DataFrame:
    """Workbooks by their bare name."""
    return table.withColumn("workbook", F.regexp_extract("workbook", r"([^/]+)\.xlsx$", 1))


@query("cell_ref_index")
def cell_ref_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = views.cell_refs(spark, sf_dir)
    return refs.withColumn("col", sheet_functions.column_index(F.col("ref")))


@query("shared_strings")
def shared_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.string_runs(spark, sf_dir).transform(sheets.assemble_strings)


@query("date_styles")
def date_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets.date_styles(*views.part_styles(spark, sf_dir))


@query("serial_to_timestamp")
def serial_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    serials = views.event_serials(spark, sf_dir)
    return serials.select(
        "event_id", sheet_functions.serial_to_timestamp(F.col("serial")).alias("ts")
    )


@query("serial_to_text")
def serial_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    serials = views.event_serials(spark, sf_dir)
    return serials.select(
        "event_id",
        sheet_functions.serial_to_text(F.col("serial")).alias("moment"),
        sheet_functions.serial_to_text(F.floor("serial").cast("double")).alias("day"),
    )


@query("workbook_decode")
def workbook_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbook files written from orders, scanned part by part, and stacked again."""
    files = _workbook_files(spark, sf_dir)
    return _named(ingest_workbooks(spark, files)).drop("sheet_no", "row_no")


@query("workbook_unpacked")
def workbook_unpacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files, sheets unpacked and scanned as split text."""
    files = _workbook_files(spark, sf_dir)
    folder = staging_path(spark, "unpacked-workbooks")
    sheet_parts.unpack_sheets(spark, files, folder)
    tables = workbook_source.scan_tables(spark, files)
    cells = staged(sheet_parts.read_sheet_cells(spark, folder), "unpacked-cells")
    return _named(stacked_sheets(tables._replace(cells=cells))).drop("sheet_no", "row_no")


@query("workbook_month_scan")
def workbook_month_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns of one sheet of every workbook; nothing else is read."""
    files = _workbook_files(spark, sf_dir)
    picked = workbook_source.scan_workbooks(spark, files, ["cell"], sheets=["Month 02"], columns=[0, 2])
    body = picked.filter("row_no > 1").groupBy("workbook", "row_no").agg(
        F.min(F.when(F.col("col") == 0, F.col("raw"))).alias("order_id"),
        F.min(F.when(F.col("col") == 2, F.col("raw"))).alias("total"),
    )
    return _named(body).drop("row_no")


@query("cells_to_rows")
def cells_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = views.workbook_tables(spark, sf_dir)
    resolved = sheets.resolve_cells(
        tables.cells,
        sheets.assemble_strings(tables.string_runs),
        sheets.date_styles(tables.styles, tables.formats),
    )
    return sheets.columns_from_cells(resolved, 27)  # up to column AA, the last one used


@query("ragged_rows")
def ragged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = views.table(spark, sf_dir, "part")
    more = F.when(F.col("p_size") > 25, F.concat_ws(" ", "p_type", "p_brand"))
    words = F.split(F.concat_ws(" ", "p_name", more), " ")
    rows = part.select("p_partkey", words.alias("row"))
    return sheets.columns_from_rows(rows, ["c0", "c1", "c2"], keep=["p_partkey"])


@query("sheet_catalog")
def sheet_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets.sheet_catalog(*views.sheet_relations(views.order_sheets(spark, sf_dir)))


@query("sheet_union")
def sheet_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stacked_sheets(views.workbook_tables(spark, sf_dir))


@query("sheet_union_by_name")
def sheet_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks with their columns in different orders, stacked by the names in their headers."""
    stacked = stacked_sheets(views.shuffled_tables(spark, sf_dir), by_name=True)
    return stacked.select("order_id", "customer", "order_date", "total", "priority", "SourceSheet", "workbook", "sheet_no", "row_no")


# --- run metrics --------------------------------------------------------------


@query("run_actions_flat")
def run_actions_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "run-documents")
    documents.write_run_documents(views.run_documents(spark, sf_dir).drop("file"), path)
    scanned = documents.read_run_documents(spark, path, name=".", one_per_file=False)
    return runs.flatten_actions(scanned).select(
        "run_label",
        "pos",
        "label",
        "duration_sec",
        F.get("job_stage_info.job_ids", F.lit(0)).alias("job_id"),
    )


@query("run_stage_tasks")
def run_stage_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.flatten_stages(views.run_documents(spark, sf_dir))


def _measure(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    measures = runs.run_measures(views.run_documents(spark, sf_dir))
    return measures.select("file", "run_label", name)


@query("run_prep_time")
def run_prep_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measure(spark, sf_dir, "time_preprocess_sec")


@query("run_work_time")
def run_work_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measure(spark, sf_dir, "time_work_sec")


@query("run_ram")
def run_ram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measure(spark, sf_dir, "ram_consumption_mb")


PREFERRED_USERS = ["7", "3", "11", "5", "2"]


@query("run_order")
def run_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = views.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("run_label")
    )
    return runs.in_run_order(labels.distinct(), PREFERRED_USERS)


@query("run_summary")
def run_summary_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(views.run_documents(spark, sf_dir), PREFERRED_USERS)


@query("run_summary_written")
def run_summary_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "run-summary")
    summary = run_summary(views.run_documents(spark, sf_dir), PREFERRED_USERS)
    documents.write_run_summary(summary, path)
    return documents.read_run_summary(spark, path)


@query("run_documents_by_glob")
def run_documents_by_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-file documents found by name, beside a summary that has to be passed over."""
    path = staging_path(spark, "run-files")
    made = views.block_documents(spark, sf_dir)
    folder = F.concat("run_label", F.lit("_metrics.json"))
    made.withColumn("run", folder).repartition("run").write.partitionBy("run").json(path)
    made.select("run_label", F.lit(0.0).alias("total_runtime_sec")).write.json(f"{path}/run=comparison_summary.json")
    scanned = documents.read_run_documents(spark, path)
    return scanned.select(
        "run_label",
        F.size("actions").cast("long").alias("n_actions"),
        run_functions.total_time(F.col("total_runtime_sec")).alias("time_total_sec"),
    )


@query("run_executor_memory")
def run_executor_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = views.executor_status(spark, sf_dir)
    memory = run_functions.executor_memory(F.col("status"))
    return status.select("event_id", F.posexplode(memory).alias("position", "e")).select(
        "event_id", "position", "e.executor", "e.max_mb", "e.used_mb", "e.remaining_mb"
    )


@query("run_documents_by_label")
def run_documents_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run's documents, of which some runs are written again; the others stay."""
    path = staging_path(spark, "labelled-documents")
    made = views.run_documents(spark, sf_dir).drop("file")
    again = F.col("run_label").isin(PREFERRED_USERS)
    stale = made.withColumn("row_count", F.when(again, F.lit(-1).cast("long")).otherwise(F.col("row_count")))
    documents.write_documents_by_label(stale, path)
    documents.write_documents_by_label(made.filter(again), path)
    return documents.read_documents_by_label(spark, path).select("run_label", "document_no", "row_count")


@query("run_summary_followed")
def run_summary_followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary over documents that arrive in two deliveries, each read once."""
    path = staging_path(spark, "arriving-documents")
    target, checkpoint = staging_path(spark, "followed-summary"), staging_path(spark, "followed-checkpoint")
    made = views.run_documents(spark, sf_dir).withColumn("delivery", F.pmod(F.xxhash64("file", "document_no"), F.lit(2)))
    for delivery in (1, 0):
        part = made.filter(F.col("delivery") == delivery).drop("delivery")
        # a folder per block, by whose names documents of one run stand in the order of the view
        block = F.format_string("%020d_metrics.json", "document_no")
        named = part.withColumn("run", F.when(F.col("file").isNotNull() & F.col("document_no").isNotNull(), block)).drop("file")
        named.repartition("run").write.mode("append").partitionBy("run").json(path)
        run_summaries.update_summaries(spark, path, target, checkpoint, one_per_file=False)
    return run_summaries.read_summaries(spark, target, PREFERRED_USERS)


@query("run_document_json")
def run_document_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = retail.answer_all(views.retail_lines(spark, sf_dir))
    document = run_document(
        "retail",
        answers.counts.select(F.col("raw_count").alias("row_count")),
        answers.countries,
        answers.months.limit(12),
        app_name=F.lit("tillroll"),
    )
    path = staging_path(spark, "run-document")
    documents.write_run_documents(document, path)
    scanned = documents.read_run_documents(spark, path, name=".", one_per_file=False)
    samples = F.concat(
        F.transform(
            "samples.top_countries_by_revenue",
            lambda c, i: F.struct(
                F.lit("country").alias("sample"),
                i.alias("position"),
                c["country"].alias("name"),
                c["orders"].alias("orders"),
                c["total_revenue"].alias("revenue"),
            ),
        ),
        F.transform(
            "samples.monthly_revenue_sample",
            lambda m, i: F.struct(
                F.lit("month").alias("sample"),
                i.alias("position"),
                m["invoice_month"].alias("name"),
                m["orders"].alias("orders"),
                m["monthly_revenue"].alias("revenue"),
            ),
        ),
    )
    return scanned.select("run_label", "row_count", F.explode(samples).alias("one")).select(
        "run_label", "row_count", "one.*"
    )
