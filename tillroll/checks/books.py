"""Workbook files made from the given orders, inside tasks."""

from __future__ import annotations

import io
from xml.sax.saxutils import escape
from zipfile import ZipFile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: names of the file format -------------------------------------
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"
# ---------------------------------------------------------------------------------

HEADER = ["order_id", "order_date", "total", "priority", "remark"]
_DATE_STYLE = 1


#: Order keys of a workbook: more orders make more workbooks, not larger ones.
KEYS_PER_BOOK = 20_000


def order_workbooks(orders: DataFrame) -> DataFrame:
    """`path, content`: a workbook per status, year and block of the order keys, a sheet per month.

    Dates are serials under a date style, priorities shared strings, remarks inline
    and missing on every third order.
    """
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1899-12-30").cast("date"))
    block = F.floor(F.col("o_orderkey") / KEYS_PER_BOOK).cast("string")
    rows = orders.select(
        F.concat_ws("-", F.lit("orders"), "o_orderstatus", F.year("o_orderdate").cast("string"), block).alias("path"),
        F.month("o_orderdate").alias("month"),
        "o_orderkey",
        days.alias("days"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("total"),
        "o_orderpriority",
        "o_orderstatus",
    )
    return rows.groupBy("path").applyInPandas(_book, "path string, content binary")


def _part(tag: str, body: str) -> str:
    return f'<?xml version="1.0" encoding="UTF-8"?><{tag} xmlns="{_MAIN}" xmlns:r="{_REL}">{body}</{tag}>'


def _book(orders: pd.DataFrame) -> pd.DataFrame:
    strings = sorted(set(orders["o_orderpriority"]))
    place = {text: i for i, text in enumerate(strings)}
    listed, relations = "", ""
    out = io.BytesIO()
    with ZipFile(out, "w") as book:
        for number, (month, own) in enumerate(orders.sort_values("o_orderkey").groupby("month"), 1):
            head = "".join(f'<c r="{x}1" t="str"><v>{name}</v></c>' for x, name in zip("ABCDE", HEADER))
            body = [f"<row>{head}</row>"]
            for n, o in enumerate(own.itertuples(), 2):
                cells = (
                    f'<c r="A{n}"><v>{o.o_orderkey}</v></c><c r="B{n}" s="{_DATE_STYLE}"><v>{o.days}</v></c>'
                    f'<c r="C{n}"><v>{o.total}</v></c><c r="D{n}" t="s"><v>{place[o.o_orderpriority]}</v></c>'
                )
                if o.o_orderkey % 3:
                    runs = f"<r><t>{escape(o.o_orderstatus)}</t></r><r><t xml:space='preserve'> inline</t></r>"
                    cells += f'<c r="E{n}" t="inlineStr"><is>{runs}</is></c>'
                body.append(f"<row>{cells}</row>")
            book.writestr(f"xl/worksheets/sheet{number}.xml", _part("worksheet", f"<sheetData>{''.join(body)}</sheetData>"))
            listed += f"<sheet name='Month {month:02}' sheetId='{number}' r:id='rId{number}'/>"
            relations += f"<Relationship Id='rId{number}' Target='worksheets/sheet{number}.xml'/>"
        book.writestr("xl/workbook.xml", _part("workbook", f"<sheets>{listed}</sheets>"))
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships xmlns='{_PACKAGE}'>{relations}</Relationships>")
        shared = "".join(f"<si><t>{escape(text)}</t></si>" for text in strings)
        book.writestr("xl/sharedStrings.xml", _part("sst", shared))
        styles = "<cellXfs><xf numFmtId='0'/><xf numFmtId='14'/></cellXfs>"
        book.writestr("xl/styles.xml", _part("styleSheet", styles))
    return pd.DataFrame({"path": orders["path"].iloc[:1], "content": [out.getvalue()]})
