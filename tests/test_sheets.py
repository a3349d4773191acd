import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillroll.functions.sheet import (
    column_index,
    fit_width,
    is_date_code,
    serial_to_text,
    serial_to_timestamp,
)
from tillroll.operators import sheets

CELLS = "workbook string, part string, row_no long, cell_no int, ref string, t string, s int, raw string, inline string"
STRINGS = "workbook string, idx long, text string"
STYLES = "workbook string, s int"
ROWS = "workbook string, sheet_no int, row_no long, row array<string>"


def values(spark, expression, *inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r.got for r in df.select("i", expression(F.col("v")).alias("got")).orderBy("i").collect()]


def test_column_index(spark):
    refs = ["A1", "I5", "Z9", "AA10", "AZ1", "ZZ3", "AAA1", "XFD1048576", "ABCD1", None]
    expected = [0, 8, 25, 26, 51, 701, 702, 16383, 19009, None]
    assert values(spark, column_index, *refs) == expected


@pytest.mark.parametrize("ref", ["12", "a1", "", "$A$1"])
def test_reference_without_letters_fails(spark, ref):
    with pytest.raises(PySparkException, match="Unexpected cell reference"):
        values(spark, column_index, ref)


def test_serials(spark):
    assert values(
        spark, serial_to_timestamp, 0.0, 40148.322916666664, 1.5, -0.25, kind="double"
    ) == [
        dt.datetime(1899, 12, 30),
        dt.datetime(2009, 12, 1, 7, 45),
        dt.datetime(1899, 12, 31, 12),
        dt.datetime(1899, 12, 29, 18),
    ]


def test_serials_match_python_dates(spark):
    serials = [i * 1.000123456789 + 36_500.1 for i in range(500)]
    expected = [dt.datetime(1899, 12, 30) + dt.timedelta(days=s) for s in serials]
    assert values(spark, serial_to_timestamp, *serials, kind="double") == expected


def test_serials_outside_the_calendar_are_null(spark):
    assert values(spark, serial_to_timestamp, 2_958_466.0, -693_594.0, float("nan"), None, kind="double") == [None] * 4
    edges = values(spark, serial_to_timestamp, 2_958_465.0, -693_593.0, kind="double")
    assert edges == [dt.datetime(9999, 12, 31), dt.datetime(1, 1, 1)]


def test_serial_text(spark):
    half_second = 0.5 / 86_400
    assert values(
        spark, serial_to_text, 40148.0, 40148.322916666664, 40148 + half_second, 40148.9999999, kind="double"
    ) == ["2009-12-01", "2009-12-01 07:45:00", "2009-12-01", "2009-12-01 23:59:59"]


def test_date_codes_match_anywhere_in_any_case(spark):
    codes = ["DD/MM/YYYY", "h:mm", "0.00", '"summer"0', "", None, "ss.0"]
    assert values(spark, is_date_code, *codes) == [True, True, False, True, False, False, True]


def test_fit_width(spark):
    df = spark.createDataFrame([(["a"],), (["a", "b", "c"],), ([],)], "r array<string>")
    got = [r.f for r in df.select(fit_width(F.col("r"), 2).alias("f")).collect()]
    assert got == [["a", ""], ["a", "b"], ["", ""]]


def test_strings_join_their_runs_in_order(spark):
    runs = spark.createDataFrame(
        [("w", 0, 2, "c"), ("w", 0, 0, "a"), ("w", 0, 1, "b"), ("w", 1, 0, ""), ("x", 0, 0, "z")],
        "workbook string, idx long, run_no int, text string",
    )
    got = {(r.workbook, r.idx): r.text for r in sheets.assemble_strings(runs).collect()}
    assert got == {("w", 0): "abc", ("w", 1): "", ("x", 0): "z"}


def test_date_styles(spark):
    styles = spark.createDataFrame(
        [("w", 0, 0), ("w", 1, 14), ("w", 2, 164), ("w", 3, 165), ("x", 2, 164), ("w", 4, 47)],
        "workbook string, s int, fmt_id int",
    )
    formats = spark.createDataFrame(
        [("w", 164, "0.0"), ("w", 164, "yyyy"), ("w", 165, "0%"), ("x", 164, "0")],
        "workbook string, fmt_id int, code string",
    )
    got = {tuple(r) for r in sheets.date_styles(styles, formats).collect()}
    assert got == {("w", 1), ("w", 2), ("w", 4)}


def test_catalog(spark):
    found = spark.createDataFrame(
        [("w", 1, "One", "r1"), ("w", 2, "Two", "r2"), ("w", 3, "Three", "r3")],
        "workbook string, sheet_no int, name string, rel_id string",
    )
    relations = spark.createDataFrame(
        [("w", "r1", "worksheets/a.xml"), ("w", "r2", "xl/worksheets/b.xml"),
         ("w", "r3", "/xl/worksheets/c.xml"), ("w", "r9", "styles.xml")],
        "workbook string, rel_id string, target string",
    )
    parts = spark.createDataFrame([("w", f"xl/worksheets/{x}.xml") for x in "abc"], "workbook string, part string")
    got = {r.name: r.part for r in sheets.sheet_catalog(found, relations, parts).collect()}
    assert got == {
        "One": "xl/worksheets/a.xml",
        "Two": "xl/worksheets/b.xml",
        "Three": "xl/worksheets/c.xml",
    }
    with pytest.raises(PySparkException, match="No relation for sheet: Two"):
        sheets.sheet_catalog(found, relations.filter("rel_id <> 'r2'"), parts).collect()
    with pytest.raises(PySparkException, match="No part for sheet: Three"):
        sheets.sheet_catalog(found, relations, parts.filter("part not like '%c.xml'")).collect()


def resolve(spark, *cells):
    strings = spark.createDataFrame([("w", 0, "zero"), ("w", 1, "one")], STRINGS)
    styles = spark.createDataFrame([("w", 5)], STYLES)
    return sheets.resolve_cells(spark.createDataFrame(list(cells), CELLS), strings, styles)


def cell(ref, t=None, s=0, raw=None, inline=None, row=1, no=0, part="p", workbook="w"):
    return (workbook, part, row, no, ref, t, s, raw, inline)


def test_values_by_cell_type(spark):
    cases = {
        "A1": (cell("A1", t="s", raw="1"), "one"),
        "B1": (cell("B1", t="s", raw="0", s=5), "zero"),
        "C1": (cell("C1", t="s"), ""),
        "D1": (cell("D1", t="inlineStr", inline="in"), "in"),
        "E1": (cell("E1", t="inlineStr", raw="3"), "3"),
        "F1": (cell("F1", raw="40148", s=5), "2009-12-01"),
        "G1": (cell("G1", t="n", raw="40148.322916666664", s=5), "2009-12-01 07:45:00"),
        "H1": (cell("H1", raw="40148", s=1), "40148"),
        "I1": (cell("I1"), ""),
        "J1": (cell("J1", t="str", raw="n/a", s=5), "n/a"),
        "K1": (cell("K1", t="str", raw="NaN", s=5), "NaN"),
        "L1": (cell("L1", t="b", raw="1"), "1"),
        "M1": (cell("M1", t="inlineStr", inline=""), ""),
    }
    rows = resolve(spark, *[made for made, _ in cases.values()]).orderBy("col").collect()
    assert [r.value for r in rows] == [value for _, value in cases.values()]


def test_missing_shared_string_fails(spark):
    with pytest.raises(PySparkException, match="No shared string 7"):
        resolve(spark, cell("A1", t="s", raw="7")).collect()


def test_rows_have_gaps_and_fixed_width(spark):
    resolved = resolve(
        spark,
        cell("C1", raw="c", no=1),
        cell("A1", raw="a", no=0),
        cell("B2", raw="first", row=2, no=0),
        cell("B2", raw="second", row=2, no=1),
        cell("E3", raw="beyond", row=3),
        cell(None, row=4),
    )
    wide = sheets.columns_from_cells(resolved, 3).orderBy("row_no").collect()
    assert [(r.c0, r.c1, r.c2) for r in wide] == [
        ("a", "", "c"),
        ("", "second", ""),
        ("", "", ""),
        ("", "", ""),
    ]
    ragged = sheets.rows_from_cells(resolved).orderBy("row_no").collect()
    assert [r.row for r in ragged] == [["a", "", "c"], ["", "second"], ["", "", "", "", "beyond"], []]


def test_header_comes_from_the_first_sheet_that_has_rows(spark):
    rows = spark.createDataFrame(
        [("w", 2, 1, ["id", "", "ID", "name"]), ("w", 3, 1, ["other"]), ("w", 2, 2, ["1"])], ROWS
    )
    assert sheets.header_names(rows) == ["id0", "_c1", "ID2", "name"]
    assert sheets.header_names(rows.filter("false")) == []


def test_headers_must_agree_between_workbooks(spark):
    rows = spark.createDataFrame([("w", 1, 1, ["a"]), ("x", 1, 1, ["b"])], ROWS)
    with pytest.raises(ValueError, match="disagree"):
        sheets.header_names(rows)
    same = spark.createDataFrame([("w", 1, 1, ["a"]), ("x", 1, 1, ["a"]), ("x", 2, 1, ["c"])], ROWS)
    assert sheets.header_names(same) == ["a"]


def test_added_columns_are_reserved(spark):
    assert sheets.column_names(["row_no", "x", "sourcesheet"]) == ["row_no0", "x", "sourcesheet2"]


def test_made_names_are_free(spark):
    for header in (["a", "a", "a1"], ["", "_c0"], ["x", "X", "x1", "x1_1"], ["_c1", ""]):
        names = [name.lower() for name in sheets.column_names(header)]
        assert len(set(names)) == len(names)


def test_every_cell_comes_out_of_wide_rows(spark):
    """As many texts come out as cells went in, on columns up to three letters."""
    letters = ["A", "Z", "AA", "BZ", "ZZ", "AAB"]
    cells = [cell(f"{x}{row}", raw=f"{x}{row}", row=row, no=n) for row in range(1, 40) for n, x in enumerate(letters) if (row + n) % 3]
    rows = sheets.rows_from_cells(resolve(spark, *cells)).collect()
    assert sum(text != "" for r in rows for text in r.row) == len(cells)
    wide = sheets.columns_from_cells(resolve(spark, *cells), 80).collect()
    kept = [c for c in cells if c[4].rstrip("0123456789") in ("A", "Z", "AA", "BZ")]
    assert sum(bool(r[f"c{i}"]) for r in wide for i in range(80)) == len(kept) and len(wide) == 39


def test_hot_style_hot_sheet_and_many_idle_cells(spark):
    """Most cells share one date style in one sheet; results are whole all the same."""
    cells = spark.range(6_000).select(
        F.lit("w").alias("workbook"),
        F.lit("p").alias("part"),
        (F.col("id") + 1).alias("row_no"),
        F.lit(0).alias("cell_no"),
        F.concat(F.lit("A"), F.col("id") + 1).alias("ref"),
        F.when(F.col("id") % 3 == 0, "inlineStr").alias("t"),
        F.when(F.col("id") % 3 != 0, 5).alias("s"),
        F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("raw"),
        F.when(F.col("id") % 3 == 0, "text").alias("inline"),
    )
    strings = spark.createDataFrame([("w", 0, "zero")], STRINGS)
    styles = spark.createDataFrame([("w", 5)], STYLES)
    catalog = spark.createDataFrame([("w", 1, "One", "p")], "workbook string, sheet_no int, name string, part string")
    resolved = sheets.resolve_cells(sheets.place_cells(cells, catalog), strings, styles)
    got = sheets.union_sheets(resolved, ["a"])
    assert got.count() == 5_999
    assert got.filter("a = 'text'").count() == 1_999
    assert got.filter("row_no = 3 and a = '1900-01-01'").count() == 1


def test_used_runs(spark):
    cells = spark.createDataFrame([cell("A1", t="s", raw="1"), cell("B1", raw="0"), cell("C1", t="s")], CELLS)
    runs = spark.createDataFrame(
        [("w", 0, 0, "no"), ("w", 1, 0, "yes"), ("w", 1, 1, "!"), ("x", 1, 0, "other book")],
        "workbook string, idx long, run_no int, text string",
    )
    assert sorted(r.text for r in sheets.used_runs(cells, runs).collect()) == ["!", "yes"]
