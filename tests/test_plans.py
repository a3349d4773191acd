"""The plans stay the ones meant for large inputs."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tests.test_clean import line
from tillroll.checks import views
from tillroll.checks.queries import QUERIES
from tillroll.operators import sheets
from tillroll.operators.clean import clean_lines
from tillroll.plans.retail import country_revenue, monthly_revenue
from tillroll.schemas import RAW_LINES

LAZY = sorted(QUERIES)


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lines") / "parquet")
    spark.createDataFrame([line()], RAW_LINES).write.parquet(path)
    return spark.read.parquet(path).transform(clean_lines)


def test_filters_and_columns_reach_the_scan(lines, settings):
    settings(spark__sql__maxMetadataStringLength="1000")
    plan = plan_of(country_revenue(lines))
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    for term in ("IsNotNull(Quantity)", "GreaterThan(Quantity,0)", "GreaterThan(Price,0.0)", "IsNotNull(Country)"):
        assert term in pushed
    assert "ReadSchema: struct<Quantity:int,Price:double,Country:string>" in plan


def test_groupings_combine_before_their_only_exchange(lines):
    for query in (country_revenue(lines), monthly_revenue(lines)):
        plan = plan_of(query)
        assert plan.count("Exchange") == 1
        below = plan.split("Exchange")[1]
        assert "partial_sum" in below and "HashAggregate" in below
        assert "TakeOrderedAndProject" in plan


def test_no_text_is_formatted_per_line(lines):
    plan = plan_of(monthly_revenue(lines))
    assert "date_format" not in plan.split("Exchange")[1]


def test_measures_of_documents_need_no_exchange(spark, sf_dir):
    from tillroll.operators.runs import run_measures
    from tillroll.schemas import RUN_DOCUMENT

    documents = spark.createDataFrame([], RUN_DOCUMENT).withColumn("file", F.lit("f"))
    plan = plan_of(run_measures(documents))
    assert "Exchange" not in plan and "Generate" not in plan


@pytest.mark.parametrize("name", LAZY)
def test_no_query_crosses_or_leaves_the_jvm(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition, ENSURE"):
        if name in ("raw_row_count", "clean_row_count", "csv_rejects") and node.startswith("Single"):
            continue  # a global count ends in one partition of partial counts
        if name in ("workbook_month_scan", "workbook_unpacked") and node == "Python":
            plan = plan.replace("(Python) RuntimeFilters", "")  # the scan of containers itself
        assert node not in plan, node


def test_hot_shared_string_is_split(spark, settings):
    """Nine cells in ten use one string: they are split by their bytes, and each string is exchanged once."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="32KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
        spark__sql__shuffle__partitions="16",
    )
    cells = spark.range(0, 60_000, 1, 8).select(
        F.lit("w").alias("workbook"),
        F.lit("p").alias("part"),
        (F.col("id") + 1).alias("row_no"),
        F.lit(0).alias("cell_no"),
        F.concat(F.lit("A"), F.col("id") + 1).alias("ref"),
        F.lit("s").alias("t"),
        F.lit(0).alias("s"),
        F.when(F.col("id") % 10 > 0, "7").otherwise((F.col("id") % 1000).cast("string")).alias("raw"),
        F.lit(None).cast("string").alias("inline"),
    )
    strings = spark.range(1000).select(
        F.lit("w").alias("workbook"), F.col("id").alias("idx"), F.concat(F.lit("text "), "id").alias("text")
    )
    styles = spark.createDataFrame([], "workbook string, s int")
    wide = sheets.columns_from_cells(sheets.resolve_cells(cells, strings, styles), 1)
    rows = {r.row_no: r.c0 for r in wide.collect()}
    plan = plan_of(wide)
    assert "SortMergeJoin(skew=true)" in plan and "Generate" not in plan
    assert "SortAggregate" not in plan
    assert len(rows) == 60_000
    assert sum(text == "text 7" for text in rows.values()) == 54_000
    assert rows[11] == "text 10"


def test_hot_order_is_split(spark, tmp_path, settings):
    """Nine lines in ten are of one order, part and customer."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="32KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
        spark__sql__shuffle__partitions="16",
    )

    def save(name, df):
        df.write.parquet(f"{tmp_path}/{name}.parquet")

    key = F.when(F.col("id") % 10 > 0, 7).otherwise(F.col("id") % 1000)
    save(
        "lineitem",
        spark.range(0, 60_000, 1, 8).select(
            key.alias("l_orderkey"),
            key.alias("l_partkey"),
            F.lit(1).alias("l_linenumber"),
            (F.xxhash64("id") % 50 + 51).cast("double").alias("l_quantity"),
            F.lit("A").alias("l_returnflag"),
        ),
    )
    numbers = spark.range(1000)
    save(
        "orders",
        numbers.selectExpr("id o_orderkey", "id o_custkey", "timestamp_ntz'1995-01-02' o_orderdate"),
    )
    save("customer", numbers.selectExpr("id c_custkey", "int(id % 5) c_nationkey"))
    save("nation", spark.range(5).selectExpr("int(id) n_nationkey", "concat('N', id) n_name"))
    save(
        "part",
        numbers.selectExpr("id p_partkey", "'n' p_name", "'t' p_type", "9 p_size", "1.5D p_retailprice"),
    )
    query = views.retail_lines(spark, str(tmp_path)).transform(clean_lines).transform(country_revenue)
    rows = query.collect()
    assert plan_of(query).count("skew=true") >= 2
    assert sum(r.orders for r in rows) == 60_000
    assert max(r.orders for r in rows) == 54_000
