import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillroll.operators.clean import clean_lines, keep_sales, normalize_columns
from tillroll.schemas import CLEAN_NAMES, RAW_LINES

WHEN = dt.datetime(2009, 12, 1, 7, 45)


def line(**changes):
    row = {
        "Invoice": "489434",
        "StockCode": "85048",
        "Description": "LIGHTS",
        "Quantity": 12,
        "InvoiceDate": WHEN,
        "Price": 6.95,
        "Customer ID": "13085",
        "Country": "EIRE",
        "SourceSheet": "Year 2009-2010",
    }
    row.update(changes)
    return tuple(row[name] for name in RAW_LINES.names)


def typed(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_LINES)


def texts(spark, *rows):
    schema = ", ".join(f"`{name}` string" for name in RAW_LINES.names)
    return spark.createDataFrame(list(rows), schema)


def test_names_and_types(spark):
    df = typed(spark, line()).transform(normalize_columns)
    assert df.columns == [*CLEAN_NAMES.values(), "revenue"]
    kinds = dict(df.dtypes)
    assert kinds["quantity"] == "int"
    assert kinds["price"] == kinds["revenue"] == "double"
    assert kinds["invoice_ts"] == "timestamp"
    assert kinds["customer_id"] == "string"
    assert df.first().revenue == 83.4


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_malformed_text_is_null_and_never_fails(spark, settings, ansi):
    settings(spark__sql__ansi__enabled=ansi)
    df = texts(
        spark,
        line(Quantity="12", InvoiceDate="2009-12-01 07:45:00", Price="6.95"),
        line(Quantity="xx", InvoiceDate="yesterday", Price="free"),
        line(Quantity="", InvoiceDate="", Price=""),
        line(Quantity="99999999999", InvoiceDate="2009-12-01", Price="1e2"),
    ).transform(normalize_columns)
    good, bad, empty, edge = df.collect()
    assert (good.quantity, good.invoice_ts, good.price) == (12, WHEN, 6.95)
    for row in (bad, empty):
        assert (row.quantity, row.invoice_ts, row.price, row.revenue) == (None,) * 4
    assert edge.quantity is None
    assert edge.invoice_ts == dt.datetime(2009, 12, 1)
    assert edge.price == 100.0


def test_fraction_of_a_quantity_is_cut(spark):
    rows = [line(Quantity=q, InvoiceDate="x", Price="1") for q in ("12.5", " 7.0 ", "-3.9", "1.2.3", ".")]
    got = [r.quantity for r in texts(spark, *rows).transform(normalize_columns).collect()]
    assert got == [12, 7, -3, None, None]


def test_inferred_identifiers_become_text(spark):
    df = typed(spark, line()).withColumn("Customer ID", F.lit(13085)).withColumn("Invoice", F.lit(7))
    row = df.transform(normalize_columns).first()
    assert (row.customer_id, row.invoice_no) == ("13085", "7")


def test_extra_columns_pass_through(spark):
    df = typed(spark, line()).withColumn("row_no", F.lit(5)).transform(clean_lines)
    assert df.first().row_no == 5


def test_every_filter_term_bites(spark):
    kept = typed(
        spark,
        line(),
        line(Quantity=None),
        line(Quantity=0),
        line(Quantity=-1),
        line(Price=None),
        line(Price=0.0),
        line(Price=-2.5),
        line(Country=None),
        line(InvoiceDate=None, **{"Customer ID": None}, Description=None),
    ).transform(clean_lines)
    assert kept.count() == 2  # a missing date or customer is no reason to drop a line


def test_filter_before_or_after_deriving_is_the_same(spark):
    raw = typed(spark, line(), line(Quantity=-4), line(Price=None), line(Quantity=3, Price=0.333))
    after = raw.transform(normalize_columns).transform(keep_sales)
    before = (
        raw.filter("Quantity > 0 and Price > 0 and Country is not null").transform(normalize_columns)
    )
    assert sorted(map(tuple, after.collect())) == sorted(map(tuple, before.collect()))


def test_revenue_rounds_half_up(spark):
    row = typed(spark, line(Quantity=1, Price=1.005)).transform(clean_lines).first()
    assert row.revenue == 1.01
