"""Inputs in the package's layouts, derived from the given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.staging import staged
from tillroll.sources.workbooks import WorkbookTables

# --- fixed values: columns of the given tables that the views read ---------------
_TABLES = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_returnflag string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
# -----------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table by its fixed schema; no footer is read before the query runs."""
    return spark.read.schema(_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def retail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw retail lines, one per lineitem row.

    The joins are outer lookups on dimension keys, so no line is lost. The
    order side is narrowed to its country first: lineitem is shuffled at most
    twice (part, order), never on the customer key. Nothing is hinted; Catalyst
    broadcasts a side only under its size threshold, and adaptive execution
    splits a skewed key of the lookups.
    """
    order_country = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", "o_orderdate")
        .join(
            table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
            F.col("o_custkey") == F.col("c_custkey"),
            "left",
        )
        .join(
            table(spark, sf_dir, "nation").select("n_nationkey", "n_name"),
            F.col("c_nationkey") == F.col("n_nationkey"),
            "left",
        )
    )
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_type", "p_size", "p_retailprice"
    )
    year = F.year("o_orderdate")
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag")
        .join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(order_country, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .select(
            F.col("l_orderkey").cast("string").alias("Invoice"),
            F.col("l_partkey").cast("string").alias("StockCode"),
            # a quote and a comma in every description, to exercise the CSV dialect
            F.concat("p_name", F.lit(', "'), "p_type", F.lit('"')).alias("Description"),
            F.when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
            .when(F.col("l_linenumber") == 7, None)
            .otherwise(F.col("l_quantity"))
            .cast("int")
            .alias("Quantity"),
            F.col("o_orderdate").cast("timestamp").alias("InvoiceDate"),
            F.when(F.col("p_size") == 1, 0.0)
            .when(F.col("p_size") == 2, None)
            .otherwise(F.col("p_retailprice"))
            .alias("Price"),
            F.col("o_custkey").cast("string").alias("Customer ID"),
            F.when(F.col("n_name") != "NATION_7", F.col("n_name")).alias("Country"),
            F.concat(
                F.lit("Year "), year.cast("string"), F.lit("-"), (year + 1).cast("string")
            ).alias("SourceSheet"),
        )
    )


def retail_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines as untyped text, with words where a number or date is missing."""
    lines = retail_lines(spark, sf_dir)
    return lines.withColumns(
        {
            "Quantity": F.when(F.col("Quantity").isNull(), F.lit("n/a"))
            .when(F.col("Country").isNull(), F.format_string("%d.0", "Quantity"))
            .otherwise(F.col("Quantity").cast("string")),
            "InvoiceDate": F.when(F.col("Price").isNull(), F.lit("unknown")).otherwise(
                F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm:ss")
            ),
            "Price": F.coalesce(F.col("Price").cast("string"), F.lit("POA")),
        }
    )


# --- workbook tables ----------------------------------------------------------
# One workbook per order status, one sheet per year of the order date, one row
# per order below a header row. `row_no` has gaps, which the operators allow.

_HEADER = ["order_id", "customer", "order_date", "total", "priority"]


def _sheet_no():
    return F.year("o_orderdate") - 1994


def _workbook():
    return F.concat(F.lit("orders-"), F.col("o_orderstatus"))


def _part(sheet_no):
    return F.concat(F.lit("xl/worksheets/sheet"), sheet_no.cast("string"), F.lit(".xml"))


def _cell(letter, row, t=None, s=0, raw=None, inline=None):
    def text(value):
        return F.lit(value).cast("string") if value is None or isinstance(value, str) else value

    return F.struct(
        F.concat(F.lit(letter), row.cast("string")).alias("ref"),
        text(t).alias("t"),
        F.lit(s).alias("s"),
        text(raw).alias("raw"),
        text(inline).alias("inline"),
    )


def _exploded_cells(rows: DataFrame, cells) -> DataFrame:
    placed = rows.select("workbook", "part", "row_no", F.posexplode(cells).alias("cell_no", "cell"))
    return placed.filter(F.col("cell").isNotNull()).select(
        "workbook", "part", "row_no", "cell_no", "cell.*"
    )


def order_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`workbook, sheet_no` of the order workbooks, written once for all that derive from it."""
    orders = table(spark, sf_dir, "orders")
    pairs = orders.select(_workbook().alias("workbook"), _sheet_no().alias("sheet_no")).distinct()
    return staged(pairs, "order-sheets")


def sheet_cells(spark: SparkSession, sf_dir: str, sheets: DataFrame) -> DataFrame:
    """Cells of the order workbooks: plain, shared, date and inline ones, ragged and gapped.

    The customer is missing on every tenth order and the priority on low ones;
    urgent orders have one cell beyond the header.
    """
    orders = table(spark, sf_dir, "orders")
    row = F.col("row_no")
    priority = F.col("o_orderpriority")
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1899-12-30").cast("date"))
    cells = F.array(
        _cell("A", row, raw=F.col("o_orderkey").cast("string")),
        F.when(
            F.col("o_orderkey") % 10 != 0,
            _cell("B", row, t="s", raw=F.col("o_custkey").cast("string")),
        ),
        _cell("C", row, s=2, raw=days.cast("string")),
        _cell("D", row, s=1, raw=F.col("o_totalprice").cast("decimal(18,2)").cast("string")),
        F.when(priority != "5-LOW", _cell("E", row, t="inlineStr", inline=priority)),
        F.when(priority == "1-URGENT", _cell("AA", row, t="str", raw="beyond the header")),
    )
    body = orders.withColumns(
        {"workbook": _workbook(), "part": _part(_sheet_no()), "row_no": F.col("o_orderkey") + 2}
    )
    heads = sheets.withColumn("row_no", F.lit(1).cast("long"))
    # only the first sheet's header counts; the others get texts of their own
    names = F.when(F.col("sheet_no") == 1, F.array(*[F.lit(n) for n in _HEADER])).otherwise(
        F.transform(F.array(*[F.lit(n) for n in _HEADER]), lambda n: F.concat(n, F.lit(" again")))
    )
    head_cells = F.array(
        *[_cell(letter, row, t="inlineStr", inline=names[i]) for i, letter in enumerate("ABCDE")]
    )
    head = heads.withColumn("part", _part(F.col("sheet_no")))
    return _exploded_cells(body, cells).unionByName(_exploded_cells(head, head_cells))


def string_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shared strings of the order workbooks: customer names in two runs each."""
    books = F.explode(F.array(*[F.lit(f"orders-{status}") for status in "FOP"]))
    named = table(spark, sf_dir, "customer").select(
        books.alias("workbook"), F.col("c_custkey").alias("idx"), "c_name"
    )
    cut = F.instr("c_name", "#")
    name = F.col("c_name")
    runs = F.array(F.substring(name, F.lit(1), cut - 1), F.substring(name, cut, F.length(name)))
    return named.select("workbook", "idx", F.posexplode(runs).alias("run_no", "text"))


def order_styles(sheets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Styles and formats of the order workbooks: 0 general, 1 money, 2 a custom date."""
    books = sheets.select("workbook").distinct()
    fmt_ids = F.array(F.lit(0), F.lit(4), F.lit(164))
    styles = books.select("workbook", F.posexplode(fmt_ids).alias("s", "fmt_id"))
    formats = books.select("workbook", F.lit(164).alias("fmt_id"), F.lit("DD/MM/YYYY").alias("code"))
    return styles, formats


def workbook_tables(spark: SparkSession, sf_dir: str) -> WorkbookTables:
    """The order workbooks as if they had been decoded."""
    found = order_sheets(spark, sf_dir)
    styles, formats = order_styles(found)
    sheets, relations, parts = sheet_relations(found)
    return WorkbookTables(
        cells=sheet_cells(spark, sf_dir, found),
        string_runs=string_runs(spark, sf_dir),
        formats=formats,
        styles=styles,
        sheets=sheets,
        relations=relations,
        parts=parts,
    )


def shuffled_tables(spark: SparkSession, sf_dir: str) -> WorkbookTables:
    """The same workbooks; those of open orders have their columns in another order."""
    tables = workbook_tables(spark, sf_dir)
    moved = F.when(F.col("workbook").contains("O"), F.translate("ref", "ABCDE", "DACEB")).otherwise(F.col("ref"))
    return tables._replace(cells=tables.cells.withColumn("ref", moved))


def part_styles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Styles and formats of one workbook per brand, a style per part, a format per size."""
    part = table(spark, sf_dir, "part").withColumn("workbook", F.concat(F.lit("styles-"), "p_brand"))
    styles = part.select(
        "workbook", F.col("p_partkey").cast("int").alias("s"), F.col("p_size").alias("fmt_id")
    )
    code = (
        F.when(F.col("p_type") == "PROMO", F.lit("[$-409]DD-MMM-YY"))
        .when(F.col("p_type") == "ECONOMY", F.lit("0.00"))
        .otherwise(F.col("p_name"))
    )
    return styles, part.select("workbook", F.col("p_size").alias("fmt_id"), code.alias("code"))


def sheet_relations(found: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sheets of the order workbooks, their relative, prefixed and absolute targets, and the parts."""
    sheets = found.withColumn("rel_id", F.concat(F.lit("rId"), F.col("sheet_no").cast("string")))
    part = _part(F.col("sheet_no"))
    target = (
        F.when(F.col("sheet_no") % 3 == 0, F.concat(F.lit("/"), part))
        .when(F.col("sheet_no") % 3 == 1, F.substring(part, 4, 100))
        .otherwise(part)
    )
    year = F.col("sheet_no") + 1994
    named = sheets.select(
        "workbook", "sheet_no", F.concat(F.lit("Year "), year.cast("string")).alias("name"), "rel_id"
    )
    return named, sheets.select("workbook", "rel_id", target.alias("target")), sheets.select("workbook", part.alias("part"))


def cell_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reference of one, two or three letters per part."""
    part = table(spark, sf_dir, "part")

    def letter(number):
        return F.char(F.lit(65) + F.pmod(number, F.lit(26)))

    first = letter(F.col("p_partkey"))
    second = letter(F.col("p_size"))
    third = letter(F.col("p_partkey") + F.col("p_size"))
    letters = (
        F.when(F.col("p_size") <= 16, first)
        .when(F.col("p_size") <= 33, F.concat(first, second))
        .otherwise(F.concat(first, second, third))
    )
    row = (F.col("p_partkey") + 1).cast("string")
    return part.select("p_partkey", F.concat(letters, row).alias("ref"))


def event_serials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's time as days since 1899-12-30."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id", (micros / 86_400_000_000.0 + 25_569.0).alias("serial")
    )


# --- run documents --------------------------------------------------------------

LABEL_OF_EVENT = {
    "view": "count input rows",
    "click": "materialize cached dataframe",
    "purchase": "top countries by revenue",
    "signup": "monthly revenue by source sheet",
}
EVENTS_PER_FILE = 1_000
REPEATED_USERS = [3, 7]


def _stage(stage_id, name, tasks):
    return F.struct(
        stage_id.alias("stage_id"), F.lit(name).alias("name"), tasks.cast("long").alias("num_tasks")
    )


def _executor(name, used):
    limit = F.lit(413.92)
    return F.struct(
        F.lit(name).alias("executor"),
        limit.alias("max_mb"),
        used.cast("double").alias("used_mb"),
        F.round(limit - used, 2).alias("remaining_mb"),
    )


def _action(event):
    """The action of one event: a job of two stages, and two executors unless it is an error."""
    event_id, k, event_type = event["event_id"], event["k"], event["event_type"]
    label = F.lit("other")
    for kind, name in LABEL_OF_EVENT.items():
        label = F.when(event_type == kind, F.lit(name)).otherwise(label)
    stages = F.array(
        _stage(2 * event_id, "scan", k % 12 + 1), _stage(2 * event_id + 1, "result", F.lit(1))
    )
    job = F.struct(
        event_id.alias("job_id"),
        F.array(2 * event_id, 2 * event_id + 1).alias("stage_ids"),
        stages.alias("stages"),
    )
    executors = F.array(_executor("10.0.0.1:7001", k), _executor("10.0.0.2:7001", k / 10))
    no_executors = F.slice(executors, 1, 0)
    return F.struct(
        label.alias("label"),
        event["value"].alias("duration_sec"),
        F.struct(F.array(event_id).alias("job_ids"), F.array(job).alias("jobs")).alias("job_stage_info"),
        F.struct(
            (F.lit(130.0) + k / 100).alias("driver_max_rss_mb"),
            F.when(event_type == "error", no_executors).otherwise(executors).alias("executors"),
        ).alias("memory_snapshot"),
    )


def run_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per user and block of 1,000 event ids, one action per event.

    The block bounds a document at 1,000 actions however many events a user
    has. A document's label is its user and block; only the first two blocks of the
    users in REPEATED_USERS share their user's label, and stand in one file in
    order. Only five narrow fields per event are exchanged; the nested actions are
    built after it.
    """
    events = table(spark, sf_dir, "events").withColumn(
        "k", F.get_json_object("props", "$.k").cast("int")
    )
    documents = events.groupBy("user_id", F.expr(f"event_id div {EVENTS_PER_FILE}").alias("block")).agg(
        F.sort_array(
            F.collect_list(F.struct("ts", "event_id", "event_type", "value", "k"))
        ).alias("events"),
        F.sum("value").alias("total_runtime_sec"),
        F.count("*").alias("row_count"),
    )
    user = F.col("user_id").cast("string")
    repeated = F.col("user_id").isin(REPEATED_USERS) & (F.col("block") < 2)
    of_block = F.concat(user, F.lit("-"), F.col("block").cast("string"))
    label = F.when(repeated, user).otherwise(of_block)
    return documents.select(
        F.concat(F.lit("run-"), label).alias("file"),
        label.alias("run_label"),
        F.col("block").cast("long").alias("document_no"),
        F.lit("retail").alias("app_name"),
        "total_runtime_sec",
        "row_count",
        F.transform("events", _action).alias("actions"),
    )


def block_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per block of 1,000 event ids, one action with label and seconds per event."""
    events = table(spark, sf_dir, "events").select(
        F.expr(f"event_id div {EVENTS_PER_FILE}").alias("block"), "event_id", "event_type", "value"
    )
    action = F.struct("event_id", F.col("event_type").alias("label"), F.col("value").alias("duration_sec"))
    grouped = events.groupBy("block").agg(
        F.sort_array(F.collect_list(action)).alias("actions"), F.sum("value").alias("total_runtime_sec")
    )
    return grouped.select(
        F.concat(F.lit("block-"), F.col("block").cast("string")).alias("run_label"),
        F.transform("actions", lambda a: F.struct(a["label"].alias("label"), a["duration_sec"].alias("duration_sec"))).alias("actions"),
        "total_runtime_sec",
    )


def executor_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two executors' storage status in bytes per event."""
    k = F.get_json_object("props", "$.k").cast("long")
    limit = F.lit(434_031_820).cast("long")

    def status(name, used):
        return F.struct(
            F.lit(name).alias("executor"),
            limit.alias("max_bytes"),
            (limit - used).alias("remaining_bytes"),
        )

    return table(spark, sf_dir, "events").select(
        "event_id",
        F.array(
            status("10.0.0.2:7001", k * 10_007),
            status("10.0.0.1:7001", k * 131_072 + F.col("event_id") % 997),
        ).alias("status"),
    )
