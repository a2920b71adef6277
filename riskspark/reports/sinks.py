"""Sinks of small results: Markdown, HTML, CSV and workbooks. Only aggregates are collected here."""

from __future__ import annotations

import html
import math
import unicodedata
import zipfile
from pathlib import Path
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame

#: Rows of one table that a sink collects; a report section is an aggregate and stays far below it.
MOST_ROWS = 100_000

Rows = tuple[list[str], list[list]]


def rows_of(section) -> Rows:
    """(header, rows) of a DataFrame, of (header, rows), or of a list of dicts."""
    if isinstance(section, DataFrame):
        got = section.limit(MOST_ROWS + 1).collect()
        if len(got) > MOST_ROWS:
            raise ValueError("a report section is too large; write it as a table instead")
        return section.columns, [list(r) for r in got]
    if isinstance(section, list):
        head = list(dict.fromkeys(k for r in section for k in r))
        return head, [[r.get(k) for k in head] for r in section]
    return section


def shown(value) -> str:
    if value is None:
        return ""
    if isinstance(value, float):
        return "" if math.isnan(value) else f"{value:.4f}".rstrip("0").rstrip(".") if math.isfinite(value) else str(value)
    return str(value)


def markdown(title: str, sections: dict[str, object]) -> str:
    """A document of one table for each section; a text section is a paragraph."""
    out = [f"# {title}", ""]
    for name, section in sections.items():
        out += [f"## {name}", ""]
        if section is None:
            continue
        if isinstance(section, str):
            out += [section, ""]
            continue
        head, rows = rows_of(section)
        cell = lambda v: shown(v).replace("|", "\\|").replace("\n", " ")
        out += ["| " + " | ".join(map(cell, head)) + " |", "|" + "---|" * len(head)]
        out += ["| " + " | ".join(map(cell, r)) + " |" for r in rows] + [""]
    return "\n".join(out)


def html_page(title: str, sections: dict[str, object]) -> str:
    parts = [f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>"]
    for name, section in sections.items():
        head, rows = rows_of(section)
        line = lambda cells, tag: "<tr>" + "".join(f"<{tag}>{html.escape(shown(c))}</{tag}>" for c in cells) + "</tr>"
        parts.append(f"<h2>{html.escape(name)}</h2><table>{line(head, 'th')}{''.join(line(r, 'td') for r in rows)}</table>")
    return "\n".join(parts)


def write_csv(df: DataFrame, path: str, single: bool = True) -> None:
    """A folder of CSV with a header; single: one file, for small results."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)


def width(text: str) -> int:
    """Columns that a text takes: wide characters count twice."""
    return sum(2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _letters(n: int) -> str:
    out = ""
    n += 1
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


#: Styles of cells by their place in the style sheet.
PLAIN, HEAD, FOUR, PERCENT = 0, 1, 2, 3
_STYLES = (
    '<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
    '<numFmts count="2"><numFmt numFmtId="164" formatCode="0.0000"/><numFmt numFmtId="165" formatCode="0.00%"/></numFmts>'
    '<fonts count="2"><font><sz val="10"/></font><font><b/><sz val="10"/></font></fonts>'
    '<fills count="3"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill>'
    '<fill><patternFill patternType="solid"><fgColor rgb="FFD9E1F2"/></patternFill></fill></fills><borders count="1"><border/></borders>'
    '<cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="4"><xf/><xf fontId="1" fillId="2" applyFont="1" applyFill="1"/>'
    '<xf numFmtId="164" applyNumberFormat="1"/><xf numFmtId="165" applyNumberFormat="1"/></cellXfs></styleSheet>'
)


def _cell(ref: str, value, style: int) -> str:
    if value is None or isinstance(value, float) and math.isnan(value):
        return ""
    if isinstance(value, (int, float)) and not isinstance(value, bool) and math.isfinite(value):
        return f'<c r="{ref}" s="{style}"><v>{value!r}</v></c>'
    clean = "".join(c for c in str(value) if c in "\t\n" or ord(c) >= 32)
    return f'<c r="{ref}" s="{style if style == HEAD else PLAIN}" t="inlineStr"><is><t xml:space="preserve">{escape(clean)}</t></is></c>'


def _style(name: str) -> int:
    low = name.lower()
    return PERCENT if low.endswith(("rate", "share", "_pct", "prop")) else FOUR


def write_xlsx(path: str, sheets: dict[str, dict[str, object]], bars: tuple[str, ...] = ("bad_rate", "lift")) -> None:
    """A workbook of sheets of titled sections, with header style, number formats, column widths and data bars; an empty title takes no row."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for i, sections in enumerate(sheets.values(), 1):
            lines, widths, rules, at = [], {}, [], 1
            for name, section in sections.items():
                if name:
                    lines.append(f'<row r="{at}">{_cell(f"A{at}", name, HEAD)}</row>')
                    at += 1
                parts = section if isinstance(section, list) and section and isinstance(section[0], tuple) else [("", section)]
                for label, part in parts:
                    if part is None:
                        continue
                    if label:
                        lines.append(f'<row r="{at}">{_cell(f"A{at}", label, HEAD)}</row>')
                        at += 1
                    head, rows = rows_of(part)
                    lines.append(f'<row r="{at}">' + "".join(_cell(f"{_letters(c)}{at}", h, HEAD) for c, h in enumerate(head)) + "</row>")
                    for k, r in enumerate(rows, at + 1):
                        lines.append(f'<row r="{k}">' + "".join(_cell(f"{_letters(c)}{k}", v, _style(head[c]) if isinstance(v, float) else PLAIN) for c, v in enumerate(r)) + "</row>")
                    for c, h in enumerate(head):
                        widths[c] = min(40, max([widths.get(c, 8), width(h) + 2, *(width(shown(r[c])) + 2 for r in rows[:200])]))
                        if h in bars and rows:
                            rules.append(f"{_letters(c)}{at + 1}:{_letters(c)}{at + len(rows)}")
                    at += len(rows) + 2
            cols = "".join(f'<col min="{c + 1}" max="{c + 1}" width="{w}" customWidth="1"/>' for c, w in sorted(widths.items()))
            bar = "".join(
                f'<conditionalFormatting sqref="{r}"><cfRule type="dataBar" priority="{k}"><dataBar><cfvo type="min"/><cfvo type="max"/><color rgb="FF638EC6"/></dataBar></cfRule></conditionalFormatting>'
                for k, r in enumerate(rules, 1)
            )
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{main}">{f"<cols>{cols}</cols>" if cols else ""}<sheetData>{"".join(lines)}</sheetData>{bar}</worksheet>')
        names = list(sheets)
        z.writestr("xl/styles.xml", _STYLES)
        z.writestr("xl/workbook.xml", f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{main}" xmlns:r="{office}"><sheets>' + "".join(f'<sheet name={_quoted(n[:31])} sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1)) + "</sheets></workbook>")
        links = "".join(f'<Relationship Id="rId{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{package}/relationships">{links}<Relationship Id="rId{len(names) + 1}" Type="{office}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("_rels/.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(names) + 1))
        z.writestr("[Content_Types].xml", f'<?xml version="1.0" encoding="UTF-8"?><Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
                   f'<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{kinds}</Types>')


def _quoted(text: str) -> str:
    from xml.sax.saxutils import quoteattr

    return quoteattr("".join("_" if c in r"[]:*?/\\" else c for c in text))


def save_text(path: str, text: str) -> None:
    Path(path).write_text(text, encoding="utf-8")
