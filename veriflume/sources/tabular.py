"""Citation tables from CSV files and workbooks whose encoding, delimiter and extension cannot be trusted."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from urllib.parse import quote
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Encodings in the order in which they are tried, and the first bytes of workbooks.
ENCODINGS = ("utf-8", "utf-8-sig", "cp1252", "latin1", "mac_roman", "utf-16", "utf-16-le", "utf-16-be")
MAGIC = (b"PK", b"\xd0\xcf\x11\xe0")
# Cell texts that mean a missing value.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
CELLS = "path string, sheet_name string, row_index long, cells array<struct<name:string,value:string>>, error string"


def list_files(spark: SparkSession, root: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """``group_id, path, length, content`` of the files under a root; the group is the first folder below it.

    The content column is only read where a plan uses it. Dot-files and files in dot-folders are left out.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    rows = reader.load(root).withColumn("_rel", relative(F.col("path"), plain_root(root)))
    rows = rows.withColumn("_rel", F.when(F.col("_rel") != "", F.col("_rel")).otherwise(F.element_at(F.split("path", "/"), -1)))  # the root is one file
    return rows.where(~F.col("_rel").rlike(r"(^|/)\.")).select(F.split("_rel", "/")[0].alias("group_id"), "path", "length", "content")


def plain_root(root: str) -> str:
    """The root without scheme and authority, with a slash at its end."""
    return re.sub(r"^[a-z0-9]+://[^/]*|^[a-z0-9]+:", "", root.rstrip("/")) + "/"


def relative(path: Column, base: str) -> Column:
    return F.regexp_extract(path, re.escape(base) + "(.*)$", 1)


def extensions(spec: str) -> set[str]:
    """``.pdf,docx`` to a set of lower-case extensions with dots."""
    return {"." + e.strip().lower().lstrip(".") for e in spec.split(",") if e.strip()}


def sniff_delimiter(text: str) -> str:
    """The delimiter that the first line has most often outside quotes; a comma if it has none."""
    head = re.sub(r'"[^"]*"', "", text[:4096]).split("\n", 1)[0]
    best = max(",;\t|", key=head.count)
    return best if best in head else ","


def _value(cell: str | None) -> str | None:
    return None if cell in MISSING else cell


def parse_csv(data: bytes, sweep: bool = True) -> list[list[str | None]]:
    """Rows of strings, the header first. Rows with too many fields are dropped, short ones padded with nulls; below the
    header, cells that mean a missing value are null."""
    last: Exception | None = None
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        data, sweep = data.decode("utf-16").encode(), False
    for encoding in ENCODINGS if sweep else ENCODINGS[:1]:
        try:
            text = data.decode(encoding)
            if "\x00" in text:
                raise ValueError("zero bytes in text")
        except (UnicodeError, ValueError) as e:
            last = e
            continue
        text = text.lstrip("﻿")
        rows = [r for r in csv.reader(io.StringIO(text), delimiter=sniff_delimiter(text)) if r]
        width = len(rows[0]) if rows else 0
        return rows[:1] + [[*map(_value, r), *[None] * (width - len(r))] for r in rows[1:] if len(r) <= width]
    raise ValueError(f"no encoding fits: {last}")


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "p": "http://schemas.openxmlformats.org/package/2006/relationships"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column(ref: str) -> int:
    n = 0
    for ch in re.match("[A-Z]*", ref).group():
        n = n * 26 + ord(ch) - 64
    return n - 1


def workbook_sheets(data: bytes) -> Iterator[tuple[str, str, zipfile.ZipFile]]:
    z = zipfile.ZipFile(io.BytesIO(data))
    rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iterfind(".//m:sheet", _NS):
        target = rels[s.get(_REL)]
        yield s.get("name"), target.lstrip("/") if target.startswith("/") else f"xl/{target}", z


#: Reader of older workbooks (.xls), from bytes to sheets of rows; a caller who has such a library sets it.
old_workbook_reader: Callable[[bytes], dict[str, list[list[str | None]]]] | None = None


def parse_workbook(data: bytes) -> dict[str, list[list[str | None]] | Exception]:
    """All sheets of an .xlsx file, every cell as a string (no library needed), or why a sheet can't be read. Older
    workbooks go to ``old_workbook_reader``; without one they raise, as does a workbook without a readable sheet."""
    if data[:4] == MAGIC[1] and old_workbook_reader:
        return old_workbook_reader(data)
    if data[:2] != MAGIC[0]:
        raise ValueError("only zipped workbooks can be read here")
    out: dict[str, list[list[str | None]] | Exception] = {}
    for name, path, z in workbook_sheets(data):
        try:
            out[name] = _sheet_rows(z, path)
        except Exception as e:
            out[name] = e
    bad = [x for x in out.values() if isinstance(x, Exception)]
    if len(bad) == len(out):
        raise ValueError(f"no readable sheet: {bad[0] if bad else 'none at all'}")
    return out


def _sheet_rows(z: zipfile.ZipFile, path: str) -> list[list[str | None]]:
    shared = []
    if "xl/sharedStrings.xml" in z.namelist():
        shared = ["".join(t.text or "" for t in si.iterfind(".//m:t", _NS)) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
    rows = []
    for row in ElementTree.fromstring(z.read(path)).iterfind(".//m:row", _NS):
        cells: dict[int, str | None] = {}
        for i, c in enumerate(row.iterfind("m:c", _NS)):
            v, inline = c.find("m:v", _NS), c.find("m:is", _NS)
            text = "".join(t.text or "" for t in inline.iterfind(".//m:t", _NS)) if inline is not None else v.text if v is not None else None
            if text is not None and c.get("t") == "s":
                text = shared[int(text)]
            cells[_column(c.get("r")) if c.get("r") else i] = text
        rows.append([cells.get(i) for i in range(max(cells, default=-1) + 1)])
    width = len(rows[0]) if rows else 0
    return rows[:1] + [[*map(_value, r[:width]), *[None] * (width - len(r))] for r in rows[1:]]


def hyperlinks(data: bytes) -> dict[str, list[str]]:
    """Hyperlink targets per sheet of an .xlsx file; whatever can't be read has none."""
    try:
        out = {}
        for name, path, z in workbook_sheets(data):
            folder, _, file = path.rpartition("/")
            rels = f"{folder}/_rels/{file}.rels"
            links = ElementTree.fromstring(z.read(rels)) if rels in z.namelist() else []
            out[name] = [r.get("Target") for r in links if (r.get("Type") or "").endswith("/hyperlink")]
        return out
    except Exception:
        return {}


def read_any(data: bytes, path: str, sweep: bool = True) -> dict[str, list[list[str | None]] | Exception]:
    """Sheets of a table: by magic bytes a workbook, else CSV (sheet ``CSV``)."""
    if data[:2] == MAGIC[0] or data[:4] == MAGIC[1] or not path.lower().endswith(".csv"):
        return parse_workbook(data)
    return {"CSV": parse_csv(data, sweep)}


def read_tables(files: DataFrame, sweep: bool = True) -> DataFrame:
    """One row per table row: its cells by header, in order; a file or sheet that can't be read gives a row with the error.

    ``files``: path, content. The first row of a sheet is its header; unnamed columns are called ``Unnamed: n``.
    """

    def run(batches):
        for pdf in batches:
            rows = []
            for path, content in zip(pdf.path, pdf.content, strict=True):
                try:
                    for sheet, table in read_any(bytes(content), path, sweep).items():
                        if isinstance(table, Exception):
                            rows.append((path, sheet, None, None, f"{type(table).__name__}: {table}"))
                            continue
                        head = [h or f"Unnamed: {i}" for i, h in enumerate(table[0])] if table else []
                        rows += [(path, sheet, i, [{"name": h, "value": v} for h, v in zip(head, r, strict=True)], None) for i, r in enumerate(table[1:])]
                except Exception as e:
                    rows.append((path, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "sheet_name", "row_index", "cells", "error"])

    return files.select("path", "content").mapInPandas(run, CELLS)


def sheet_frame(cells: DataFrame, path: str, sheet: str) -> DataFrame:
    """One sheet as a table of string columns."""
    rows = cells.where((F.col("path") == path) & (F.col("sheet_name") == sheet))
    head = rows.orderBy("row_index").select(F.transform("cells", lambda c: c["name"]).alias("h")).first()
    names = head["h"] if head else []
    return rows.orderBy("row_index").select("row_index", *[F.col("cells")[i]["value"].alias(n) for i, n in enumerate(names)])


def read_links(files: DataFrame) -> DataFrame:
    """``path, sheet_name, url``: hyperlink targets of the workbooks among ``files`` (path, content)."""

    def run(batches):
        for pdf in batches:
            rows = [(path, sheet, url) for path, content in zip(pdf.path, pdf.content, strict=True) for sheet, urls in hyperlinks(bytes(content)).items() for url in urls]
            yield pd.DataFrame(rows, columns=["path", "sheet_name", "url"])

    return files.select("path", "content").mapInPandas(run, "path string, sheet_name string, url string")


def read_manifests(spark: SparkSession, root: str, subdir: str = "urls") -> DataFrame:
    """``group_id, timestamp, url, saved_as, seq`` of the download logs of the groups under a root; a log that can't be
    read has no rows. seq is the order of the rows of a log.

    Spark's readers pass over files whose name starts with an underscore, so the driver lists the logs, at most one a
    group, and tasks open them.
    """
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/*/{subdir}/_manifest.csv")
    listed = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []
    logs = [(x.getPath().getParent().getParent().getName(), x.getPath().toString()) for x in listed]

    def run(batches):
        from pyarrow import fs

        for pdf in batches:
            rows = []
            for group, path in zip(pdf.group_id, pdf.path, strict=True):
                try:
                    store, at = fs.FileSystem.from_uri(quote(path, safe="/:@"))
                    with store.open_input_stream(at) as f:
                        head, *body = parse_csv(f.read()) or [[]]
                except Exception:
                    continue
                for i, r in enumerate(body):
                    cells = dict(zip(head, r, strict=True))
                    url, saved = ((cells.get(c) or "").strip() or None for c in ("url", "saved_as"))
                    rows.append((group, cells.get("timestamp"), url, saved, i))
            yield pd.DataFrame(rows, columns=["group_id", "timestamp", "url", "saved_as", "seq"])

    files = spark.createDataFrame(logs, "group_id string, path string").repartition(max(1, min(200, len(logs))))
    return files.mapInPandas(run, "group_id string, timestamp string, url string, saved_as string, seq long")
