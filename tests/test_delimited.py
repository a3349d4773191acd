import datetime as dt

import pytest

from tillroll.checks import views
from tillroll.operators.clean import clean_lines
from tillroll.schemas import RAW_LINES
from tillroll.sources.delimited import read_lines, read_lines_checked, read_lines_inferred, read_lines_once, write_lines

from tests.conftest import plan_of
from tests.test_clean import line

NOON = dt.datetime(2010, 5, 1, 12, 0, 7, 999_000)
MIDNIGHT = dt.datetime(2010, 5, 1)


def write(spark, tmp_path, *rows, **options):
    path = str(tmp_path / "lines")
    write_lines(spark.createDataFrame(list(rows), RAW_LINES), path, **options)
    return path


def test_hard_texts_survive(spark, tmp_path):
    hard = [
        'SIGN 6", "HOME"',
        "back\\slash, and comma",
        "  blanks kept  ",
        "it's 100% plain",
        '"',
    ]
    path = write(spark, tmp_path, *[line(Description=text) for text in hard])
    for read in (read_lines, read_lines_inferred):
        assert sorted(r.Description for r in read(spark, path).collect()) == sorted(hard)


def test_line_break_needs_multi_line(spark, tmp_path):
    with pytest.raises(Exception, match="Line break inside a field"):
        write(spark, tmp_path / "refused", line(Description="two\nlines"))
    path = write(spark, tmp_path, line(Description="two\nlines"), line(), line_breaks=True)
    got = read_lines(spark, path, multi_line=True)
    assert sorted(r.Description for r in got.collect()) == ["LIGHTS", "two\nlines"]
    assert got.transform(clean_lines).count() == 2


def test_empty_text_and_null_come_back_as_null(spark, tmp_path):
    path = write(spark, tmp_path, line(Country=""), line(Country=None), line(Country="EIRE"))
    countries = [r.Country for r in read_lines(spark, path).collect()]
    assert sorted(map(str, countries)) == ["EIRE", "None", "None"]


def test_times_are_written_like_a_sheet_shows_them(spark, tmp_path):
    path = write(spark, tmp_path, line(InvoiceDate=NOON), line(InvoiceDate=MIDNIGHT))
    dates = sorted(r.InvoiceDate for r in spark.read.csv(path, header=True).collect())
    assert dates == ["2010-05-01", "2010-05-01 12:00:07"]
    back = sorted(r.InvoiceDate for r in read_lines(spark, path).collect())
    assert back == [MIDNIGHT, NOON.replace(microsecond=0)]


def test_explicit_schema_applies_by_position_and_forgives_bad_fields(spark, tmp_path):
    (tmp_path / "f.csv").write_text(
        "a,b,c,d,e,f,g,h,SourceSheet\r\n"
        "1,2,text,many,2010-05-01,cheap,7,EIRE,s\r\n"
        "1,2,text,4,not a date,2.5,7,EIRE,s\r\n"
    )
    first, second = read_lines(spark, str(tmp_path / "f.csv")).collect()
    assert (first.Quantity, first.Price, first.InvoiceDate) == (None, None, MIDNIGHT)
    assert (second.Quantity, second.Price, second.InvoiceDate) == (4, 2.5, None)


def test_inferred_and_explicit_scans_agree_after_cleaning(spark, tmp_path):
    rows = [line(Quantity=q, InvoiceDate=t) for q in (3, -1, None) for t in (NOON, MIDNIGHT)]
    path = write(spark, tmp_path, *rows)
    explicit = read_lines(spark, path).transform(clean_lines)
    inferred = read_lines_inferred(spark, path).transform(clean_lines)
    assert explicit.dtypes == inferred.dtypes
    assert sorted(map(tuple, explicit.collect())) == sorted(map(tuple, inferred.collect()))


def test_header_is_in_every_part(spark, tmp_path):
    df = spark.createDataFrame([line()] * 8, RAW_LINES).repartition(4)
    write_lines(df, str(tmp_path / "parts"))
    parts = list((tmp_path / "parts").glob("*.csv"))
    assert len(parts) == 4
    assert all(p.read_text(encoding="utf-8").startswith("Invoice,StockCode") for p in parts)


# --- types from one scan ----------------------------------------------------------------


def kinds(frame):
    return [(f.name, f.dataType.simpleString()) for f in frame.schema.fields]


def test_types_of_the_views_equal_sparks(spark, sf_dir, tmp_path):
    for name, view in (("lines", views.retail_lines), ("texts", views.retail_text_lines)):
        path = str(tmp_path / name)
        write_lines(view(spark, sf_dir), path)
        once, twice = read_lines_once(spark, path), read_lines_inferred(spark, path)
        assert kinds(once) == kinds(twice)
        assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


COLUMNS = {
    "ints": ["1", "-2", "+3", "", "2147483647"],
    "longs": ["1", "2147483648", "", "-5", "0"],
    "decimals": ["1", "99999999999999999999", "0", "", "-7"],
    "doubles": ["1", "2.5", "1e3", "-.5", "7."],
    "mixed numbers": ["99999999999999999999", "0.5", "", "1", "2"],
    "odd doubles": ["1.5", "NaN", "Inf", "-Inf", "2d"],
    "blank doubles": [" 1", "2 ", "3", "", "4"],
    "dates": ["2010-05-01", "2010-12-31", "", "1999-01-01", "2000-02-29"],
    "bad dates": ["2010-05-01", "2010-02-30", "", "x", "2000-02-29"],
    "times": ["2010-05-01 10:11:12", "2010-05-01", "", "2010-05-01T01:02:03.5Z", "2010-05-02 00:00"],
    "booleans": ["true", "FALSE", "", "True", "false"],
    "numbers and booleans": ["true", "1", "", "0", "false"],
    "dates and numbers": ["2010-05-01", "1", "", "2", "3"],
    "nothing": ["", "", "", "", ""],
    "text": ["a", "1", "", "true", "2010-05-01"],
    "codes": ["00012", "85048", "1", "", "77"],
}


def test_types_of_edge_columns_equal_sparks(spark, tmp_path):
    body = [",".join(COLUMNS)] + [",".join(row) for row in zip(*COLUMNS.values())]
    (tmp_path / "f.csv").write_text("\n".join(body) + "\n")
    once, twice = read_lines_once(spark, str(tmp_path)), read_lines_inferred(spark, str(tmp_path))
    assert kinds(once) == kinds(twice)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_types_merge_over_files_and_headers_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,t\n1,x\n2,\n")
    (tmp_path / "b.csv").write_text("n,t\n3.5,y\n")
    assert kinds(read_lines_once(spark, str(tmp_path))) == [("n", "double"), ("t", "string")]
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "h.csv").write_text("n,t\n")
    empty = read_lines_once(spark, str(tmp_path / "empty"))
    assert kinds(empty) == [("n", "string"), ("t", "string")] and empty.count() == 0


def test_the_input_is_parsed_once(spark, tmp_path):
    path = write(spark, tmp_path, line(), line(Quantity=3))
    once = read_lines_once(spark, path)
    assert "FileScan parquet" in plan_of(once) and "FileScan csv" not in plan_of(once)


# --- rejects ----------------------------------------------------------------------------


def test_rejects_name_the_columns_and_keep_the_line(spark, tmp_path):
    header = ",".join(f'"{n}"' for n in RAW_LINES.names)
    bad = [
        '1,a,"x, ""y""",many,2010-05-01,2.5,7,EIRE,s',
        "2,a,b,1,yesterday,cheap,7,EIRE,s",
        "3,a,b,1,2010-05-01",
        "4,a,b,1,2010-05-01,2.5,7,EIRE,s,more",
    ]
    good = ["5,a,b,1,2010-05-01,2.5,7,EIRE,s", "6,,,,,,,,"]
    (tmp_path / "f.csv").write_text("\n".join([header, *bad, *good]) + "\n")
    rows, rejects = read_lines_checked(spark, str(tmp_path))
    plain = read_lines(spark, str(tmp_path))
    assert rows.schema == plain.schema
    assert sorted(map(str, rows.collect())) == sorted(map(str, plain.collect()))
    got = {r.line: r.columns for r in rejects.collect()}
    assert got == {bad[0]: ["Quantity"], bad[1]: ["InvoiceDate", "Price"], bad[2]: [], bad[3]: []}
    assert all(r.file.endswith("f.csv") for r in rejects.collect())
