import datetime as dt
import random
from zipfile import ZipFile

import pytest

from tests.books import c, shared, sheet, styles, write_book
from tillroll.operators.clean import clean_lines
from tillroll.plans.ingest import ingest_workbooks
from tillroll.plans.retail import country_revenue
from tillroll.schemas import RAW_LINES
from tillroll.sources.delimited import read_lines, write_lines
from tillroll.sources.workbooks import decode_workbooks, read_workbook_records, split_records

HEADER = RAW_LINES.names[:-1]
TEXTS = shared(*HEADER, "EIRE", ("United ", "Kingdom"), 'LAMP 6", RED', "")
EIRE, UK, LAMP, BLANK = 8, 9, 10, 11


def header_row():
    return [c(f"{letter}1", i, t="s") for i, letter in enumerate("ABCDEFGH")]


def line_row(row, invoice, quantity, serial, price, country):
    return [
        c(f"A{row}", invoice),
        c(f"B{row}", inline=["85", "048"], t="inlineStr"),
        c(f"C{row}", LAMP, t="s"),
        c(f"D{row}", quantity),
        c(f"E{row}", serial, s=1),
        c(f"F{row}", price),
        # no customer: a gap
        c(f"H{row}", country, t="s"),
    ]


def retail_book(path, **options):
    first = sheet(
        header_row(),
        line_row(2, 489434, 12, 40148.322916666664, 6.95, UK),
        [],
        line_row(4, 489435, 2, 40149, 1.5, EIRE),
    )
    second = sheet(
        [c("A1", "dropped unread")],
        line_row(2, 500000, 3, 40544.5, 10, UK) + [c("AA2", "beyond")],
        [c("A3", "only an invoice")],
    )
    write_book(
        path,
        {"Year 2009-2010": first, "Empty": sheet(), "Year 2010-2011": second},
        TEXTS,
        styles([0, 164], [(164, "m/d/yyyy h:mm")]),
        **options,
    )


def test_end_to_end(spark, tmp_path):
    retail_book(tmp_path / "retail.xlsx")
    table = ingest_workbooks(spark, str(tmp_path / "retail.xlsx"))
    assert table.columns == [*HEADER, "SourceSheet", "workbook", "sheet_no", "row_no"]
    got = [tuple(r)[:9] for r in table.orderBy("sheet_no", "row_no").collect()]
    lamp = 'LAMP 6", RED'
    assert got == [
        ("489434", "85048", lamp, "12", "2009-12-01 07:45:00", "6.95", "", "United Kingdom", "Year 2009-2010"),
        ("", "", "", "", "", "", "", "", "Year 2009-2010"),
        ("489435", "85048", lamp, "2", "2009-12-02", "1.5", "", "EIRE", "Year 2009-2010"),
        ("500000", "85048", lamp, "3", "2011-01-01 12:00:00", "10", "", "United Kingdom", "Year 2010-2011"),
        ("only an invoice", "", "", "", "", "", "", "", "Year 2010-2011"),
    ]
    lines = table.transform(clean_lines)
    assert [tuple(r) for r in country_revenue(lines).collect()] == [
        ("United Kingdom", 2, 113.4, 56.7),
        ("EIRE", 1, 3.0, 3.0),
    ]


def test_through_delimited_text(spark, tmp_path):
    retail_book(tmp_path / "retail.xlsx")
    table = ingest_workbooks(spark, str(tmp_path), columns=HEADER).select(*RAW_LINES.names)
    write_lines(table, str(tmp_path / "csv"))
    lines = read_lines(spark, str(tmp_path / "csv"))
    assert lines.count() == 5
    assert lines.filter("Invoice = '489434'").first().InvoiceDate == dt.datetime(2009, 12, 1, 7, 45)
    assert lines.transform(clean_lines).count() == 3


def test_many_workbooks_keep_apart(spark, tmp_path):
    for number in range(5):
        write_book(
            tmp_path / f"b{number}.xlsx",
            {"S": sheet([c("A1", 0, t="s")], [c("A2", 1, t="s"), c("B2", 5, s=number % 2)])},
            shared("name", f"book {number}"),
            styles([0, 22]),
        )
    got = ingest_workbooks(spark, str(tmp_path)).orderBy("workbook")
    assert [(r.name, r.SourceSheet) for r in got.collect()] == [(f"book {n}", "S") for n in range(5)]
    named = ingest_workbooks(spark, str(tmp_path), columns=["name", "when"]).orderBy("workbook")
    assert [r.when for r in named.collect()] == ["5", "1900-01-04", "5", "1900-01-04", "5"]


def test_targets_and_foreign_parts(spark, tmp_path):
    write_book(
        tmp_path / "b.xlsx",
        {"One": sheet([c("A1", "h")], [c("A2", "1")]), "Two": sheet([c("A1", "h")], [c("A2", "2")])},
        targets={"One": "/xl/elsewhere/one.xml", "Two": "xl/worksheets/two.xml"},
        extra={
            "xl/worksheets/orphan.xml": sheet([c("A1", "h")], [c("A2", "not catalogued")]),
            "xl/theme/theme1.xml": "<theme><row><c r='A1'><v>9</v></c></row></theme>",
            "docProps/app.xml": "<Properties/>",
            "xl/media/image1.png": "not xml",
        },
    )
    got = ingest_workbooks(spark, str(tmp_path / "b.xlsx")).orderBy("sheet_no")
    assert [(r.h, r.SourceSheet) for r in got.collect()] == [("1", "One"), ("2", "Two")]


def test_lost_part_fails(spark, tmp_path):
    write_book(tmp_path / "whole.xlsx", {"One": sheet([c("A1", "h")]), "Two": sheet([c("A1", "h")], [c("A2", "2")])})
    with ZipFile(tmp_path / "whole.xlsx") as whole, ZipFile(tmp_path / "cut.xlsx", "w") as cut:
        for name in whole.namelist():
            if not name.endswith("sheet2.xml"):
                cut.writestr(name, whole.read(name))
    assert ingest_workbooks(spark, str(tmp_path / "whole.xlsx")).count() == 1
    with pytest.raises(Exception, match="No part for sheet: Two"):
        ingest_workbooks(spark, str(tmp_path / "cut.xlsx")).collect()


def test_parts_are_decoded_once_whatever_the_fan_out(spark, tmp_path):
    retail_book(tmp_path / "retail.xlsx")
    files = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content")
    kinds = [sorted(map(str, decode_workbooks(files, n).collect())) for n in (1, 2, 7)]
    assert kinds[0] == kinds[1] == kinds[2]


def test_no_strings_and_no_styles_part(spark, tmp_path):
    write_book(tmp_path / "b.xlsx", {"S": sheet([c("A1", "h")], [c("A2", "40148", s=14)])})
    assert ingest_workbooks(spark, str(tmp_path / "b.xlsx")).first().h == "40148"


def test_records(spark, tmp_path):
    retail_book(tmp_path / "retail.xlsx")
    tables = split_records(read_workbook_records(spark, str(tmp_path)))
    assert tables.string_runs.count() == 13
    assert tables.sheets.count() == tables.relations.count() == 3
    assert [r.fmt_id for r in tables.styles.orderBy("s").collect()] == [0, 164]
    assert tables.formats.first().code == "m/d/yyyy h:mm"
    blank = tables.cells.filter("ref is null").collect()
    assert [(r.row_no, r.raw) for r in blank] == [(3, None)]


def test_missing_reference_counts_as_a1(spark, tmp_path):
    write_book(tmp_path / "b.xlsx", {"S": sheet([c("A1", "h")], [c(v="x"), c(v="y")])})
    assert [r.h for r in ingest_workbooks(spark, str(tmp_path / "b.xlsx")).collect()] == ["y"]


def test_more_cells_than_one_batch(spark, tmp_path):
    rows = [[c(f"A{n}", n), c(f"B{n}", n * 2)] for n in range(1, 7001)]
    write_book(tmp_path / "b.xlsx", {"S": sheet(*rows)})
    got = ingest_workbooks(spark, str(tmp_path / "b.xlsx"), columns=["a", "b"])
    assert got.selectExpr("count(*)", "sum(int(a))", "sum(int(b))").first() == (6999, 24503499, 49006998)


def test_not_a_workbook_fails(spark, tmp_path):
    (tmp_path / "b.xlsx").write_bytes(b"nothing of the kind")
    with pytest.raises(Exception, match="not a zip file"):
        ingest_workbooks(spark, str(tmp_path / "b.xlsx"))


def test_blank_first_row_leaves_only_the_sheet_name(spark, tmp_path):
    write_book(tmp_path / "b.xlsx", {"S": sheet([], [c("A2", "1"), c("B2", "2")])})
    got = ingest_workbooks(spark, str(tmp_path / "b.xlsx"))
    assert got.columns[0] == "SourceSheet"
    assert [(r.SourceSheet, r.row_no) for r in got.collect()] == [("S", 2)]


def test_workbook_without_rows(spark, tmp_path):
    write_book(tmp_path / "b.xlsx", {"S": sheet()})
    assert ingest_workbooks(spark, str(tmp_path / "b.xlsx")).count() == 0


def random_book(path, seed):
    """A workbook of cells whose texts are known by construction; returns its data rows."""
    dice = random.Random(seed)
    strings = [dice.choice(["", "plain", "with, comma", 'with "quote"', "ünï"]) + str(n) for n in range(20)]
    letters = ["A", "B", "C", "D", "E", "Z", "AA"]
    width = 5

    def random_cell(ref):
        index, days = dice.randrange(len(strings)), dice.randrange(30_000, 50_000)
        seconds = dice.randrange(1, 86_400)
        day = dt.datetime(1899, 12, 30) + dt.timedelta(days=days)
        return dice.choice(
            [
                (c(ref, index, t="s"), strings[index]),
                (c(ref, index, t="s", s=1), strings[index]),
                (c(ref, inline=[strings[index], "!"], t="inlineStr"), strings[index] + "!"),
                (c(ref, days, s=1), f"{day:%Y-%m-%d}"),
                (c(ref, repr(days + seconds / 86_400), s=2), f"{day + dt.timedelta(seconds=seconds):%Y-%m-%d %H:%M:%S}"),
                (c(ref, days, s=0), str(days)),
                (c(ref, "TRUE", t="str"), "TRUE"),
                (c(ref, s=1), ""),
            ]
        )

    made, expected = {}, []
    header = [c(f"{x}1", f"h{x}", t="str") for x in letters[:width]]
    for number in range(1, dice.randrange(2, 5)):
        name, rows = f"Sheet {number}", []
        if dice.random() < 0.8 or number == 1:
            rows.append(header if number == 1 else [c("A1", "unread")])
            for row_no in range(2, dice.randrange(2, 9)):
                used = [x for x in letters if dice.random() < 0.6]
                drawn = {x: random_cell(f"{x}{row_no}") for x in used}
                rows.append([xml for xml, _ in drawn.values()])
                texts = [drawn[x][1] if x in drawn else "" for x in letters[:width]]
                expected.append((*texts, name, row_no))
        made[name] = sheet(*rows)
    write_book(path, made, shared(*strings), styles([0, 14, 164], [(164, "YYYY hh")]))
    return expected


def test_random_books(spark, tmp_path):
    expected = []
    for seed in range(25):
        expected += [(seed, *row) for row in random_book(tmp_path / f"b{seed:02}.xlsx", seed)]
    table = ingest_workbooks(spark, str(tmp_path)).orderBy("workbook", "sheet_no", "row_no")
    got = [(int(r.workbook[-7:-5]), *r[:6], r.row_no) for r in table.collect()]
    assert len(expected) > 100
    assert got == expected


# --- headers that differ ----------------------------------------------------------------


def differing(tmp_path):
    head = [c("A1", "id", t="str"), c("B1", "name", t="str"), c("C1", t="str")]
    write_book(tmp_path / "a.xlsx", {"S": sheet(head, [c("A2", 1), c("B2", "x", t="str"), c("C2", "n", t="str")], [], [c("F4", "far", t="str")])})
    turned = [c("A1", "name", t="str"), c("B1", "price", t="str"), c("C1", "id", t="str")]
    write_book(tmp_path / "b.xlsx", {"none": sheet(), "S": sheet(turned, [c("A2", "y", t="str"), c("B2", 9), c("C2", 2)]), "T": sheet([c("A1", "other", t="str")], [c("C2", 3)])})


def test_headers_in_another_order_stack_by_name(spark, tmp_path):
    differing(tmp_path)
    got = ingest_workbooks(spark, str(tmp_path), by_name=True).orderBy("workbook", "sheet_no", "row_no")
    assert got.columns == ["id", "name", "_c2", "price", "SourceSheet", "workbook", "sheet_no", "row_no"]
    assert [tuple(r)[:5] for r in got.collect()] == [
        ("1", "x", "n", "", "S"),
        ("", "", "", "", "S"),
        ("", "", "", "", "S"),
        ("2", "y", "", "9", "S"),
        ("3", "", "", "", "T"),
    ]
    chosen = ingest_workbooks(spark, str(tmp_path), columns=["price", "id"], by_name=True).orderBy("workbook", "row_no")
    assert [tuple(r)[:2] for r in chosen.filter("sheet_no = 2").collect()] == [("9", "2")]


def test_by_position_stays_the_default(spark, tmp_path):
    differing(tmp_path)
    with pytest.raises(ValueError, match="disagree on the header"):
        ingest_workbooks(spark, str(tmp_path))


def test_names_that_cannot_be_told_apart(spark, tmp_path):
    for name, head in (("a", "Id"), ("b", "ID")):
        write_book(tmp_path / f"{name}.xlsx", {"S": sheet([c("A1", head, t="str")], [c("A2", 1)])})
    with pytest.raises(ValueError, match="case only"):
        ingest_workbooks(spark, str(tmp_path), by_name=True)


def test_by_name_equals_by_position_where_headers_agree(spark, tmp_path):
    retail_book(tmp_path / "one.xlsx")
    retail_book(tmp_path / "two.xlsx")
    by_name, plain = (ingest_workbooks(spark, str(tmp_path), by_name=flag) for flag in (True, False))
    assert by_name.columns == plain.columns
    assert sorted(map(str, by_name.collect())) == sorted(map(str, plain.collect()))
