"""Excel workbooks (xlsx), many files in parallel, one task per workbook."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator
from decimal import Decimal
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_BATCH = 10_000


def double_text(value: float) -> str:
    """A number as the load writes it: integral values without decimals, others in shortest decimal form.

    Very large and very small values use ``E`` notation, as the JVM prints doubles.
    """
    if value == int(value):
        return str(int(value))
    if 1e-3 <= abs(value) < 1e7:
        return repr(value)
    sign, digits, exponent = Decimal(repr(value)).as_tuple()
    fraction = "".join(map(str, digits[1:])).rstrip("0") or "0"
    return f"{'-' if sign else ''}{digits[0]}.{fraction}E{exponent + len(digits) - 1}"


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_MAIN}t"))


def _cell(cell, shared: list[str]) -> str:
    formula = cell.find(f"{_MAIN}f")
    if formula is not None:
        return formula.text or ""
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return _text(cell)
    value = cell.findtext(f"{_MAIN}v")
    if value is None or kind == "e":
        return ""
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "true" if value == "1" else "false"
    if kind == "str":
        return value
    return double_text(float(value))


def _column_number(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]*", reference)[0]:
        number = number * 26 + ord(letter) - ord("A") + 1
    return number


def sheet_rows(content: bytes, sheet_index: int, has_header: bool) -> Iterator[str]:
    """Rows of one sheet as JSON text. Absent cells are skipped, so later cells move left."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = [_text(si) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
        sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{_MAIN}sheets")
        rel_id = list(sheets)[sheet_index].get(_REL_ID)
        rels = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        target = next(r.get("Target") for r in rels if r.get("Id") == rel_id)
        name = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        headers = None
        with book.open(name) as stream:
            for _, row in ElementTree.iterparse(stream):
                if row.tag != f"{_MAIN}row":
                    continue
                cells = list(row)
                values = [_cell(c, shared) for c in cells]
                if headers is None:
                    if has_header:
                        headers = values
                        row.clear()
                        continue
                    width = max((_column_number(c.get("r", "")) for c in cells), default=0) or len(cells)
                    headers = [f"field_{i}" for i in range(width)]
                padded = values + [None] * (len(headers) - len(values))
                pairs = zip(headers, padded)
                yield "{" + ",".join(f"{_quoted(h)}:{_quoted(v)}" for h, v in pairs) + "}"
                row.clear()


def _quoted(text: str | None) -> str:
    return json.dumps(text, ensure_ascii=False)


def parse_workbooks(files: DataFrame, sheet_index: int = 0, has_header: bool = True) -> DataFrame:
    """Rows of one sheet of each workbook in ``path, content`` rows, as ``path, raw_json``."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"]):
                rows: list[str] = []
                for text in sheet_rows(content, sheet_index, has_header):
                    rows.append(text)
                    if len(rows) == _BATCH:
                        yield pd.DataFrame({"path": name, "raw_json": rows})
                        rows = []
                if rows:
                    yield pd.DataFrame({"path": name, "raw_json": rows})

    return files.select("path", "content").mapInPandas(parse, "path string, raw_json string")


def read_workbooks(spark: SparkSession, path: str, sheet_index: int = 0, has_header: bool = True) -> DataFrame:
    """Rows of one sheet of each workbook under a path or glob: ``path, raw_json``.

    Numbers without a fraction print without decimals, booleans as text, formulas as their text, blanks as ``""``.
    """
    return parse_workbooks(spark.read.format("binaryFile").load(path), sheet_index, has_header)
