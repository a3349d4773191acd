"""Unpacked sheets give the decoder's cells, however Spark cuts them."""

import random

import pytest
from pyspark.sql import functions as F

from tillroll.sources.sheet_parts import read_sheet_cells, unpack_sheets
from tillroll.sources.workbook_source import scan_workbooks
from tillroll.sources.workbooks import split_records

from .books import c, part, sheet, write_book


@pytest.fixture
def folder(tmp_path):
    rng = random.Random(4)
    odd = ["a & b", "<row>", "é😀", " blanks ", "", "line\nbreak", "x" * 7_000]
    rows = []
    for n in range(1, 300):
        cells = [c(f"A{n}", n), c(f"C{n}", rng.choice(odd), t="str", s=rng.choice([None, 3]))]
        if n % 3 == 0:
            cells.append(c(f"E{n}", t="inlineStr", inline=rng.sample(odd, 2)))
        if n % 7 == 0:
            cells = []
        rows.append(cells)
    spread = "".join(f"<row r='{n}' spans='1:2'/>" if n % 2 else f"<row r='{n}' x14ac:dy='0.2'><c r='B{n}'><v>{n}</v></c></row>" for n in range(1, 60))
    write_book(
        tmp_path / "many + rows.xlsx",
        {"large": sheet(*rows), "attributes": part("worksheet", f"<sheetData xmlns:x14ac='a:b'>{spread}<row/></sheetData><extLst/>"), "none": sheet()},
        extra={"xl/other.xml": "<x:other xmlns:x='y:z'><row><c r='A1'/></row></x:other>"},
    )
    write_book(tmp_path / "small.xlsx", {"one": sheet([c(None, 5), c("B1"), c("C1", t="inlineStr", inline=())], [])})
    return str(tmp_path)


def cells_of(frame):
    return sorted(map(str, frame.select("workbook", "part", "row_no", "cell_no", "ref", "t", "s", "raw", "inline").collect()))


@pytest.mark.parametrize("block", ["3k", "128m"])
def test_unpacked_cells_equal_decoded_cells(spark, folder, tmp_path, settings, block):
    expected = cells_of(split_records(scan_workbooks(spark, folder)).cells)
    settings(spark__sql__files__maxPartitionBytes=block, spark__sql__files__openCostInBytes="0")
    target = str(tmp_path / "unpacked")
    written = unpack_sheets(spark, folder, target).collect()
    assert len(written) == 4 and all(r["size"] > 0 for r in written)
    cells = read_sheet_cells(spark, target)
    assert cells_of(cells) == expected
    if block == "3k":
        lines = spark.read.option("recursiveFileLookup", True).text(target, lineSep="</row>")
        assert lines.rdd.getNumPartitions() > 10


def test_rows_are_parsed_without_python(spark, folder, tmp_path):
    target = str(tmp_path / "unpacked")
    unpack_sheets(spark, folder, target)
    plan = read_sheet_cells(spark, target)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_unpacking_again_changes_nothing(spark, folder, tmp_path):
    target = str(tmp_path / "unpacked")
    first = unpack_sheets(spark, folder, target).orderBy("file").collect()
    once = cells_of(read_sheet_cells(spark, target))
    assert unpack_sheets(spark, folder, target).orderBy("file").collect() == first
    assert cells_of(read_sheet_cells(spark, target)) == once


def test_small_sheets_share_files(spark, tmp_path):
    source, target = tmp_path / "books", str(tmp_path / "unpacked")
    source.mkdir()
    rows = [[c(f"A{n}", n)] for n in range(1, 9)]
    for n in range(40):
        write_book(source / f"book {n}.xlsx", {"a": sheet(*rows[: n % 8 + 1]), "b": sheet([c("A1", n)]), "c": sheet([], [])})
    written = unpack_sheets(spark, str(source), target).collect()
    assert len(written) == len({r["file"] for r in written}) == 120
    assert len(list((tmp_path / "unpacked").rglob("*.parquet"))) < 40 and not list((tmp_path / "unpacked").rglob("*.xml"))
    assert cells_of(read_sheet_cells(spark, target)) == cells_of(split_records(scan_workbooks(spark, str(source))).cells)


def test_sheets_that_change_their_size(spark, tmp_path):
    """From the table to a file of its own and back: the last sheet is read, others stay."""
    source, target = tmp_path / "books", str(tmp_path / "unpacked")
    source.mkdir()
    write_book(source / "kept.xlsx", {"a": sheet([c("A1", 1)])})
    for length in (1, 200, 2):
        write_book(source / "changed.xlsx", {"a": sheet(*[[c(f"A{n}", n)] for n in range(1, length + 1)])})
        only = source / "changed.xlsx" if length == 200 else source
        unpack_sheets(spark, str(only), target, small=2_000)
        assert len(list((tmp_path / "unpacked").rglob("*.xml"))) == (length == 200)
        assert cells_of(read_sheet_cells(spark, target)) == cells_of(split_records(scan_workbooks(spark, str(source))).cells)
