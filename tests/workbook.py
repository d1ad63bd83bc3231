"""Writes small workbooks: sheets of rows, each cell None, a text or a number."""

import zipfile
from xml.sax.saxutils import escape

HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"


def write_workbook(path, sheets, shared=True):
    strings = []

    def cell(column, number, value):
        at = f"{chr(65 + column)}{number}"
        if value is None:
            return f'<c r="{at}"/>'
        if isinstance(value, str):
            if not shared:
                return f'<c r="{at}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'
            strings.append(value)
            return f'<c r="{at}" t="s"><v>{len(strings) - 1}</v></c>'
        return f'<c r="{at}"><v>{value}</v></c>'

    def sheet(rows):
        body = "".join(
            f'<row r="{n}">' + "".join(cell(c, n, v) for c, v in enumerate(row)) + "</row>"
            for n, row in enumerate(rows, start=1) if row is not None
        )
        return f'{HEAD}<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>'

    parts = {f"xl/worksheets/sheet{i}.xml": sheet(rows) for i, rows in enumerate(sheets.values(), 1)}
    listed = "".join(
        f'<sheet name="{escape(name)}" sheetId="{i}" r:id="rId{i}"/>' for i, name in enumerate(sheets, 1)
    )
    links = "".join(
        f'<Relationship Id="rId{i}" Type="{RELS}/worksheet" Target="worksheets/sheet{i}.xml"/>'
        for i in range(1, len(sheets) + 1)
    )
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("xl/workbook.xml",
                      f'{HEAD}<workbook xmlns="{MAIN}" xmlns:r="{RELS}"><sheets>{listed}</sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels",
                      f'{HEAD}<Relationships xmlns="{PACKAGE}/relationships">{links}</Relationships>')
        if shared:
            items = "".join(f"<si><r><t>{escape(s[:1])}</t></r><r><t>{escape(s[1:])}</t></r></si>" for s in strings)
            book.writestr("xl/sharedStrings.xml", f'{HEAD}<sst xmlns="{MAIN}">{items}</sst>')
        for name, text in parts.items():
            book.writestr(name, text)
