"""Column names and types of every table the package reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: column names and types of the retail line file ------------
RAW_LINES = T.StructType(
    [
        T.StructField("Invoice", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.TimestampType()),
        T.StructField("Price", T.DoubleType()),
        T.StructField("Customer ID", T.StringType()),
        T.StructField("Country", T.StringType()),
        T.StructField("SourceSheet", T.StringType()),
    ]
)

CLEAN_NAMES = {
    "Invoice": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_ts",
    "Price": "price",
    "Customer ID": "customer_id",
    "Country": "country",
    "SourceSheet": "source_sheet",
}

SHEET_COLUMN = "SourceSheet"
# -----------------------------------------------------------------------------

#: One XML fact of a workbook; `kind` says which of the six side tables it belongs to.
WORKBOOK_RECORD = T.StructType(
    [
        T.StructField("workbook", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("row_no", T.LongType()),
        T.StructField("cell_no", T.IntegerType()),
        T.StructField("ref", T.StringType()),
        T.StructField("t", T.StringType()),
        T.StructField("s", T.IntegerType()),
        T.StructField("raw", T.StringType()),
        T.StructField("inline", T.StringType()),
    ]
)

# --- fixed values: field names of a run-metrics document ----------------------
STAGE = T.StructType(
    [
        T.StructField("stage_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("num_tasks", T.LongType()),
    ]
)

JOB = T.StructType(
    [
        T.StructField("job_id", T.LongType()),
        T.StructField("stage_ids", T.ArrayType(T.LongType())),
        T.StructField("stages", T.ArrayType(STAGE)),
    ]
)

EXECUTOR = T.StructType(
    [
        T.StructField("executor", T.StringType()),
        T.StructField("max_mb", T.DoubleType()),
        T.StructField("used_mb", T.DoubleType()),
        T.StructField("remaining_mb", T.DoubleType()),
    ]
)

ACTION = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("duration_sec", T.DoubleType()),
        T.StructField(
            "job_stage_info",
            T.StructType(
                [
                    T.StructField("job_ids", T.ArrayType(T.LongType())),
                    T.StructField("jobs", T.ArrayType(JOB)),
                ]
            ),
        ),
        T.StructField(
            "memory_snapshot",
            T.StructType(
                [
                    T.StructField("driver_max_rss_mb", T.DoubleType()),
                    T.StructField("executors", T.ArrayType(EXECUTOR)),
                ]
            ),
        ),
    ]
)

COUNTRY_RESULT = T.StructType(
    [
        T.StructField("country", T.StringType()),
        T.StructField("orders", T.LongType()),
        T.StructField("total_revenue", T.DoubleType()),
        T.StructField("avg_revenue", T.DoubleType()),
    ]
)

MONTH_RESULT = T.StructType(
    [
        T.StructField("source_sheet", T.StringType()),
        T.StructField("invoice_month", T.StringType()),
        T.StructField("orders", T.LongType()),
        T.StructField("monthly_revenue", T.DoubleType()),
    ]
)

RUN_DOCUMENT = T.StructType(
    [
        T.StructField("run_label", T.StringType()),
        T.StructField("document_no", T.LongType()),  # our own: order among documents of one file
        T.StructField("app_name", T.StringType()),
        T.StructField("master", T.StringType()),
        T.StructField("input", T.StringType()),
        T.StructField("dataframe_creation_sec", T.DoubleType()),
        T.StructField("total_runtime_sec", T.DoubleType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("actions", T.ArrayType(ACTION)),
        T.StructField(
            "samples",
            T.StructType(
                [
                    T.StructField("top_countries_by_revenue", T.ArrayType(COUNTRY_RESULT)),
                    T.StructField("monthly_revenue_sample", T.ArrayType(MONTH_RESULT)),
                ]
            ),
        ),
        T.StructField(
            "optimizations",
            T.StructType(
                [
                    T.StructField("explicit_schema", T.BooleanType()),
                    T.StructField("repartition", T.StringType()),
                    T.StructField("persistence", T.StringType()),
                ]
            ),
        ),
    ]
)
# -----------------------------------------------------------------------------
