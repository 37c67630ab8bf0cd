"""File sources: format sniffing and scans of CSV, JSON, JSONL, Parquet, spreadsheets and zipped CSV."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirlake.operators.staging import head_bytes

SAMPLE = 65_536
ENCODINGS = ("utf-8-sig", "utf-8", "cp1252", "latin-1")
DELIMITERS = ",;\t|"


def sniff_csv(sample: bytes) -> tuple[str, str]:
    """(encoding, delimiter) from a file's first bytes; an error if a non-empty file has no header."""
    encoding = "latin-1"
    for name in ENCODINGS:
        try:
            # The sample may end inside a character.
            sample.decode(name) if name in ("cp1252", "latin-1") else sample[: sample.rfind(b"\n") + 1 or None].decode(name)
            encoding = name
            break
        except UnicodeDecodeError:
            continue
    text = sample.decode(encoding, "replace").lstrip("﻿")
    header = text.splitlines()[0] if text.splitlines() else ""
    if sample and not header.strip():
        raise ValueError("no header")
    return encoding, max(DELIMITERS, key=lambda d: (header.count(d), -DELIMITERS.index(d)))


def _encoding(spark: SparkSession, path: str) -> str:
    """utf-8, cp1252 or latin-1, from all lines of all files; Spark reads lines as the bytes that they are."""
    lines = spark.read.option("lineSep", "\n").text(path).select("value")
    none = "[" + "".join(chr(b) for b in range(0x80, 0xA0) if not bytes([b]).decode("cp1252", "ignore")) + "]"
    odd = F.decode(F.col("value").cast("binary"), "ISO-8859-1").rlike(none)
    seen = lines.agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"), F.bool_or(odd).alias("odd")).first()
    if seen.utf8 is not False:
        return "utf-8"
    return "latin-1" if seen.odd else "cp1252"


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All cells as text; a byte-order mark is no part of the header.

    The delimiter is sniffed from the first file's header, the encoding is the first of ``ENCODINGS`` that all lines of
    all files are in: the first file may have a header alone, and any file may begin with plain text.
    """
    encoding, delimiter = sniff_csv(head_bytes(spark, path, SAMPLE))
    if encoding != "latin-1":
        encoding = _encoding(spark, path)
    name = "UTF-8" if encoding.startswith("utf-8") else "ISO-8859-1"
    df = spark.read.option("header", True).option("sep", delimiter).option("encoding", name).option("multiLine", True).option("escape", '"').csv(path)
    df = df.toDF(*(c.lstrip("\ufeff") for c in df.columns))
    if encoding != "cp1252":
        return df
    # Spark reads no windows-1252; it differs from Latin-1 in the control range only.
    there = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
    table = {b: bytes([b]).decode("cp1252") for b in there}
    old, new = "".join(map(chr, there)), "".join(table.values())
    return df.select(*(F.translate(F.col(f"`{c}`"), old, new).alias(c.translate(table)) for c in df.columns))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """(value VARIANT) rows of whole JSON documents.

    A list has its elements, an object the first list among results, data, items and records, or
    itself; a scalar is wrapped as {"value": …}.
    """
    whole = spark.read.option("wholetext", True).text(path).select(F.expr("parse_json(value)").alias("v"))
    kind = F.expr("schema_of_variant(v)")
    lists = F.coalesce(*(F.expr(f"try_variant_get(v, '$.{k}', 'array<variant>')") for k in ("results", "data", "items", "records")))
    rows = F.when(kind.startswith("ARRAY"), F.expr("try_variant_get(v, '$', 'array<variant>')")).when(kind.startswith("OBJECT"), F.coalesce(lists, F.expr("array(v)")))
    wrapped = F.expr("array(to_variant_object(named_struct('value', v)))")
    return whole.select(F.explode(F.coalesce(rows, wrapped)).alias("value"))


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One object for each line that is not blank."""
    return spark.read.json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Columns of all files together, NaN as null."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    return df.select(*(F.when(~F.isnan(c), F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes))


def _country_rows(content: bytes, wanted: frozenset[str], columns: tuple[str, ...]) -> Iterator[dict[str, str]]:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        members = [n for n in z.namelist() if n.lower().endswith(".csv")]
        for name in [n for n in members if "normalized" in n.lower()] or members:
            with z.open(name) as f:
                for row in csv.DictReader(io.TextIOWrapper(f, encoding="utf-8-sig", errors="replace")):
                    if not wanted or any((row.get(c) or "").casefold().strip() in wanted for c in columns):
                        yield {str(k): v for k, v in row.items() if k is not None and not isinstance(v, list)}


COUNTRY_COLUMNS = (
    "Area", "Area Name", "Country", "Country Name", "Geographic Area", "Reporter Country", "Reporter Countries", "Reporting Country",
    "Recipient Country", "Recipient",
)


def read_zip_csv(spark: SparkSession, path: str, aliases: tuple[str, ...] = (), batch: int = 10_000) -> DataFrame:
    """(path, row MAP) rows of the CSV members of zip files, filtered by country alias as they are read."""
    wanted = frozenset(a.casefold().strip() for a in aliases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.map_(pa.string(), pa.string())
        for b in batches:
            for where, content in zip(b["path"].to_pylist(), b["content"], strict=True):
                rows: list = []
                for r in _country_rows(content.as_py(), wanted, COUNTRY_COLUMNS):
                    rows.append(list(r.items()))
                    if len(rows) == batch:
                        yield pa.RecordBatch.from_arrays([pa.array([where] * batch), pa.array(rows, kind)], ["path", "row"])
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([where] * len(rows)), pa.array(rows, kind)], ["path", "row"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, row map<string,string>")


_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _sheet_rows(content: bytes) -> Iterator[tuple[str, int, dict[str, str]]]:
    """(sheet, row index, cells by header) of an xlsx file; empty cells are left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
        names = [s.get("name") for s in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")]
        for i, name in enumerate(names, 1):
            header: dict[str, str] = {}
            at = 0
            for r in ET.fromstring(z.read(f"xl/worksheets/sheet{i}.xml")).iter(f"{_MAIN}row"):
                cells = {}
                for c in r.iter(f"{_MAIN}c"):
                    v = c.find(f"{_MAIN}v")
                    text = "".join(t.text or "" for t in c.iter(f"{_MAIN}t")) if c.get("t") == "inlineStr" else v.text if v is not None else None
                    if text is not None:
                        cells[(c.get("r") or "").rstrip("0123456789")] = shared[int(text)] if c.get("t") == "s" else text
                if not header:
                    header = cells
                    continue
                yield name, at, {header[k]: v for k, v in cells.items() if k in header}
                at += 1


def read_spreadsheet(spark: SparkSession, path: str) -> DataFrame:
    """(path, sheet, row_index, row MAP) of all sheets of xlsx files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for where, content in zip(b["path"].to_pylist(), b["content"], strict=True):
                got = list(_sheet_rows(content.as_py()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([where] * len(got), pa.string()), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.int64()), pa.array([list(g[2].items()) for g in got], pa.map_(pa.string(), pa.string()))],
                    ["path", "sheet", "row_index", "row"],
                )

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, sheet string, row_index long, row map<string,string>")


READERS = {"csv": read_csv, "json": read_json, "jsonl": read_jsonl, "parquet": read_parquet, "xlsx": read_spreadsheet}


def read_any(spark: SparkSession, path: str, kind: str, source_id: str) -> DataFrame:
    """A file's rows by format, with where they came from."""
    if kind not in READERS:
        raise ValueError(f"no reader for {kind}")
    return READERS[kind](spark, path).withColumns({"_prov_source_id": F.lit(source_id), "_prov_path": F.lit(path), "_prov_format": F.lit(kind)})
