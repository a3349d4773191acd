"""The workbook data source: what tasks read, and that nothing is lost."""

import json

import pytest
from pyspark.sql import functions as F

from tillroll.plans.ingest import ingest_workbooks
from tillroll.schemas import WORKBOOK_RECORD
from tillroll.sources import workbook_source
from tillroll.sources.workbook_source import SCAN, WorkbookReader, scan_workbooks, write_files
from tillroll.sources.workbooks import read_workbook_records

from .books import c, part, shared, sheet, styles, write_book
from .conftest import plan_of


@pytest.fixture
def folder(tmp_path):
    for n in range(3):
        head = [c("A1", 0, t="s"), c("B1", 1, t="s"), c("AA1", "far", t="str")]
        rows = [[c(f"A{i}", i), c(f"B{i}", 40_000 + i, s=1), c(f"C{i}", t="inlineStr", inline=("x", "y"))] for i in range(2, 40 + n)]
        write_book(
            tmp_path / f"book {n}.xlsx",
            {"first": sheet(head, [], *rows), "sec & ond": sheet(head, *rows[:5]), "none": sheet()},
            strings=shared("id", ("wh", "en"), ""),
            style_part=styles([0, 14, 164], [(164, "yyyy")]),
            extra={"docProps/app.xml": "<Properties/>"},
        )
    (tmp_path / "notes.txt").write_text("not a workbook")
    return str(tmp_path)


def facts(frame):
    name = F.regexp_extract("workbook", "([^/]+)$", 1)
    columns = [c for c in WORKBOOK_RECORD.names if c != "workbook"]
    return sorted(map(str, frame.select(name.alias("workbook"), *columns).collect()))


@pytest.mark.parametrize("size", [0, 2_000, 1 << 30])
def test_same_records_as_the_whole_container(spark, folder, size):
    assert facts(scan_workbooks(spark, folder, partition_bytes=size)) == facts(read_workbook_records(spark, folder))


def test_one_partition_per_part(spark, folder):
    """Three books of three sheets, strings, another part, the lists and the directory."""
    assert scan_workbooks(spark, folder, partition_bytes=0).rdd.getNumPartitions() == 3 * (3 + 1 + 1 + 2)
    assert scan_workbooks(spark, folder).rdd.getNumPartitions() == 1


def test_no_container_in_a_plan(spark, folder, tmp_path):
    scan = scan_workbooks(spark, folder)
    assert "Exchange" not in plan_of(scan) and "binary" not in plan_of(scan)


def units(folder, **options):
    reader = WorkbookReader({"path": folder, "partitionBytes": "0", **{k: json.dumps(v) for k, v in options.items()}})
    return reader, [u for p in reader.partitions() for u in p.units]


def test_options_choose_parts(folder):
    chosen = units(folder, kinds=["cell"], sheets=["first", "gone"])[1]
    assert [(u.what, u.sheet) for u in chosen] == [("sheet", "first")] * 3
    assert [u.what for u in units(folder, kinds=["style"])[1]] == ["lists"] * 3
    assert not units(folder, kinds=[])[1]


def test_the_last_row_ends_the_parsing(tmp_path):
    """Behind the last row asked for, a broken sheet is not even noticed."""
    rows = "".join(f"<row><c r='A{n}'/></row>" for n in range(1, 90_000))
    broken = part("worksheet", f"<sheetData>{rows}").replace("</worksheet>", "</wrong>")
    write_book(tmp_path / "broken.xlsx", {"one": broken})
    reader, _ = units(str(tmp_path), kinds=["cell"], lastRow=2)
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 2
    whole, _ = units(str(tmp_path), kinds=["cell"])
    with pytest.raises(Exception, match="mismatched tag"):
        [b for p in whole.partitions() for b in whole.read(p)]


@pytest.mark.parametrize(
    "options, condition",
    [
        ({"kinds": ["cell"], "sheets": ["sec & ond"], "columns": [0, 26]}, "kind = 'cell' and sheet = 'sec & ond' and col in (0, 26)"),
        ({"kinds": ["cell"], "last_row": 3}, "kind = 'cell' and row_no <= 3"),
        ({"columns": [1]}, "kind <> 'cell' or col = 1"),
        ({"kinds": ["string", "part"]}, "kind in ('string', 'part')"),
        ({"kinds": ["sheet", "style"]}, "kind in ('sheet', 'style')"),
        ({"sheets": []}, "kind <> 'cell'"),
    ],
)
def test_chosen_scans_equal_filtered_rows(spark, folder, options, condition):
    whole = scan_workbooks(spark, folder).filter(condition)
    got = scan_workbooks(spark, folder, **options, partition_bytes=0)
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))


def test_filters_of_one_scan_do_not_meet(spark, folder):
    """Several filters over one DataFrame, in one query: each gets its own rows."""
    scan = scan_workbooks(spark, folder)
    of = {r.kind: r["count"] for r in scan.groupBy("kind").count().collect()}
    both = scan.filter("kind = 'style'").union(scan.filter("kind = 'string'"))
    assert {r.kind: r["count"] for r in both.groupBy("kind").count().collect()} == {k: of[k] for k in ("style", "string")}


def test_written_files_come_back(spark, folder, tmp_path):
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(folder)
    copies = files.select(F.regexp_extract("path", "([^/]+)$", 1).alias("path"), "content")
    write_files(copies, str(tmp_path / "copies"))
    assert facts(scan_workbooks(spark, str(tmp_path / "copies"))) == facts(scan_workbooks(spark, folder))
    assert sorted(p.name for p in (tmp_path / "copies").iterdir()) == ["book 0.xlsx", "book 1.xlsx", "book 2.xlsx"]


@pytest.mark.parametrize("names", [["a", "../b"], ["a", None], ["same", "same"]])
def test_a_failed_write_leaves_no_file(spark, tmp_path, names):
    rows = spark.createDataFrame([(n, b"x") for n in names], "path string, content binary")
    with pytest.raises(Exception, match="below the folder|several rows"):
        write_files(rows, str(tmp_path / "out"))
    assert not [p for p in (tmp_path / "out").iterdir() if p.is_file()]


def test_missing_and_empty_folders(spark, tmp_path):
    with pytest.raises(Exception, match="FileNotFound|gone"):
        scan_workbooks(spark, str(tmp_path / "gone")).count()
    (tmp_path / "empty").mkdir()
    assert scan_workbooks(spark, str(tmp_path / "empty")).count() == 0


def test_stores_that_only_spark_reads(spark, folder, monkeypatch):
    assert not workbook_source.opens("viewfs://store/books")
    through_parts = ingest_workbooks(spark, folder).drop("workbook")
    monkeypatch.setattr("tillroll.plans.ingest.opens", lambda path: False)
    through_spark = ingest_workbooks(spark, folder).drop("workbook")
    assert sorted(map(str, through_parts.collect())) == sorted(map(str, through_spark.collect()))


@pytest.mark.parametrize("options", [{}, {"kinds": ["cell"], "sheets": ["first"], "columns": [0]}, {"kinds": ["style", "part"]}])
def test_the_driver_opens_a_bounded_number_of_containers(folder, monkeypatch, options):
    monkeypatch.setattr(workbook_source, "_batch", lambda records, schema: sorted(map(str, records)))
    opened, open_units = [], WorkbookReader._units
    monkeypatch.setattr(WorkbookReader, "_units", lambda self, files, uri, place: opened.append(uri) or open_units(self, files, uri, place))

    def records():
        opened.clear()
        reader = WorkbookReader({"path": folder, **{k: json.dumps(v) for k, v in options.items()}})
        planned = reader.partitions()
        return sorted(r for p in planned for batch in reader.read(p) for r in batch), len(opened)

    every, count = records()
    assert count == 3
    monkeypatch.setattr(workbook_source, "OPENED", 1)
    assert records() == (every, 1) and "book 2.xlsx" in opened[0]  # the largest
