"""Files in and out: exports with unknown encoding, sheets, raw JSON, snapshots and backups.

Schemas are declared, never inferred.  Small administrative files are decoded in
tasks, not on the driver; corrupt files raise.
"""

from __future__ import annotations

import csv
import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, columns: list[str], encoding: str = "UTF-8") -> DataFrame:
    """All text, blanks for missing values; a byte order mark in front of the header is harmless."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    raw = spark.read.schema(schema).csv(path, header=True, enforceSchema=True, encoding=encoding, quote='"', escape='"', multiLine=True)
    return raw.na.fill("")


def decode(data: bytes) -> str:
    """UTF-8 with or without mark, else the Western code page."""
    try:
        return data.decode("utf-8-sig")
    except UnicodeDecodeError:
        return data.decode("cp1252", errors="replace")


def located_rows(text: str, first: str, within: int = 40) -> list[dict[str, str]]:
    """Rows below the first line that starts with ``first``; a repeated header gets `` (2)``, rows with an empty first cell are left out."""
    rows = list(csv.reader(io.StringIO(text)))
    at = next((i for i, r in enumerate(rows[:within]) if r and r[0].strip() == first), None)
    if at is None:
        return []
    header, seen = [], {}
    for h in rows[at]:
        h = h.strip()
        seen[h] = seen.get(h, 0) + 1
        header.append(h if seen[h] == 1 else f"{h} ({seen[h]})")
    return [dict(zip(header, r)) for r in rows[at + 1 :] if r and r[0].strip()]


def sheet_rows(data: bytes) -> list[list[str]]:
    """Cells of the first sheet of a workbook, as text."""
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{ns['m']}}}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", ns)]
        name = sorted(n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))[0]
        out = []
        for row in ET.fromstring(z.read(name)).iter(f"{{{ns['m']}}}row"):
            cells: list[str] = []
            for c in row.findall("m:c", ns):
                ref = re.match(r"[A-Z]+", c.get("r", "A"))
                col = 0
                for ch in ref.group() if ref else "A":
                    col = col * 26 + ord(ch) - 64
                cells += [""] * (col - 1 - len(cells))
                v = c.find("m:v", ns)
                if c.get("t") == "inlineStr":
                    cells.append("".join(t.text or "" for t in c.iter(f"{{{ns['m']}}}t")))
                elif v is None or v.text is None:
                    cells.append("")
                else:
                    cells.append(shared[int(v.text)] if c.get("t") == "s" else v.text)
            out.append(cells)
    return out


def read_exports(spark: SparkSession, path: str, first: str, columns: list[str]) -> DataFrame:
    """Rows of all CSV or workbook exports below ``path``: ``file``, ``ord`` (place in the file) and ``columns`` as text."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for p, data in zip(pdf["path"], pdf["content"]):
                if p.lower().endswith(".xlsx"):
                    buffer = io.StringIO()
                    csv.writer(buffer).writerows(sheet_rows(data))
                    text = buffer.getvalue()
                else:
                    text = decode(data)
                out += [(p, i, *(r.get(c, "") for c in columns)) for i, r in enumerate(located_rows(text, first))]
            yield pd.DataFrame(out, columns=["file", "ord", *columns])

    return files.mapInPandas(run, "file string, ord long, " + ", ".join(f"`{c}` string" for c in columns))


def newest_files(spark: SparkSession, path: str) -> DataFrame:
    """``folder``, ``path``: the last changed file of each folder below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "modificationTime")
    w = Window.partitionBy("folder").orderBy(F.desc("modificationTime"), "path")
    return files.withColumn("folder", F.regexp_replace("path", "/[^/]*$", "")).withColumn("n", F.row_number().over(w)).where("n = 1").select("folder", "path")


def read_records(spark: SparkSession, path: str, records_path: str, fields: dict[str, str]) -> DataFrame:
    """Records below a path of a JSON document per line, its fields renamed; nameless ones are left out."""
    raw = spark.read.text(path)
    each = F.explode(F.from_json(F.get_json_object("value", f"$.{records_path}"), "array<string>")).alias("r")
    out = raw.select(each).select(*(F.trim(F.coalesce(F.get_json_object("r", f"$.{src}"), F.lit(""))).alias(name) for name, src in fields.items()))
    return out.where(F.col(next(iter(fields))) != "")


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """Fixed columns in their order; missing ones are written empty."""
    have = set(df.columns)
    df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in have else F.lit("").alias(c) for c in columns)).write.csv(path, header=True, mode="errorifexists")


def backup(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Writes each table as JSON below ``path``; the manifest (``name``, ``n``) raises if everything is empty."""
    spark = next(iter(tables.values())).sparkSession
    counts = []
    for name, df in tables.items():
        df.write.json(f"{path}/{name}")
        counts.append((name, spark.read.schema(df.schema).json(f"{path}/{name}").count()))
    if not sum(n for _, n in counts):
        raise ValueError("the backup is empty")
    return spark.createDataFrame(counts, "name string, n long")


class PagedSource(DataSource):
    """A paged endpoint as a Spark source: one partition per page.

    Options: ``pages``, ``size`` and the name of a registered ``fetch`` function (page, size) -> rows.
    No fetch over a network is part of this package.
    """

    fetchers: dict = {}

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return self.options["schema"]

    def reader(self, schema: StructType) -> DataSourceReader:
        return _PagedReader(self.options, self.fetchers[self.options["fetch"]])


class _PagedReader(DataSourceReader):
    def __init__(self, options, fetch):
        self.pages, self.size, self.fetch = int(options["pages"]), int(options.get("size", 1000)), fetch

    def partitions(self):
        return [InputPartition(i) for i in range(self.pages)]

    def read(self, partition):
        yield from self.fetch(partition.value, self.size)
