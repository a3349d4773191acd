"""Tiny workbooks, written part by part."""

from xml.sax.saxutils import escape, quoteattr
from zipfile import ZipFile

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def part(tag, body):
    return f'<?xml version="1.0" encoding="UTF-8"?><{tag} xmlns="{MAIN}" xmlns:r="{REL}">{body}</{tag}>'


def shared(*items):
    """Each item is a text or a tuple of rich-text runs."""
    body = "".join(
        "<si>" + (f"<t>{escape(i)}</t>" if isinstance(i, str) else "".join(f"<r><t>{escape(t)}</t></r>" for t in i)) + "</si>"
        for i in items
    )
    return part("sst", body)


def styles(fmt_ids, custom=()):
    formats = "".join(f"<numFmt numFmtId='{i}' formatCode={quoteattr(c)}/>" for i, c in custom)
    xfs = "".join(f"<xf numFmtId='{i}'/>" for i in fmt_ids)
    return part("styleSheet", f"<numFmts>{formats}</numFmts><cellXfs>{xfs}</cellXfs>")


def c(ref=None, v=None, t=None, s=None, inline=None):
    attributes = "".join(f' {k}="{x}"' for k, x in (("r", ref), ("t", t), ("s", s)) if x is not None)
    body = "" if v is None else f"<v>{escape(str(v))}</v>"
    if inline is not None:
        body += "<is>" + "".join(f"<r><t>{escape(x)}</t></r>" for x in inline) + "</is>"
    return f"<c{attributes}>{body}</c>"


def sheet(*rows):
    body = "".join(f"<row>{''.join(cells)}</row>" for cells in rows)
    return part("worksheet", f"<cols><col min='1'/></cols><sheetData>{body}</sheetData>")


def write_book(path, sheets, strings=None, style_part=None, targets=None, extra=None):
    """`sheets` maps names to sheet parts, in workbook order."""
    targets = targets or {}
    listed, relations = "", ""
    with ZipFile(path, "w") as book:
        for number, (name, xml) in enumerate(sheets.items(), 1):
            target = targets.get(name, f"worksheets/sheet{number}.xml")
            listed += f"<sheet name={quoteattr(name)} sheetId='{number}' r:id='rId{number}'/>"
            relations += f"<Relationship Id='rId{number}' Target='{target}'/>"
            stored = target.lstrip("/")
            book.writestr(stored if stored.startswith("xl/") else f"xl/{stored}", xml)
        book.writestr("xl/workbook.xml", part("workbook", f"<sheets>{listed}</sheets>"))
        book.writestr(
            "xl/_rels/workbook.xml.rels", f"<Relationships xmlns='{PACKAGE}'>{relations}</Relationships>"
        )
        if strings:
            book.writestr("xl/sharedStrings.xml", strings)
        if style_part:
            book.writestr("xl/styles.xml", style_part)
        for name, content in (extra or {}).items():
            book.writestr(name, content)
