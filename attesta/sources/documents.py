"""Documents: workbooks, page texts, and a polite HTTP client for connectors."""

from __future__ import annotations

import io
import threading
import time
import urllib.error
import urllib.request
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import text as T
from ..operators.constraints import ConstraintError

# Fixed values.
_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
SHEET_HEADER = ["te", "ab", "cd", "ef", "hij", "k", "kaz_name", "rus_name", "nn"]


def sheet_rows(content: bytes) -> Iterator[list[str]]:
    """Rows of the first sheet as strings, parsed as a stream. Cells that are left out shift the rest left, as published."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            with book.open("xl/sharedStrings.xml") as f:
                for _, item in ElementTree.iterparse(f):
                    if item.tag == f"{_NS}si":
                        shared.append("".join(t.text or "" for t in item.iter(f"{_NS}t")))
                        item.clear()
        sheet = min(n for n in book.namelist() if n.startswith("xl/worksheets/sheet"))
        with book.open(sheet) as f:
            for _, row in ElementTree.iterparse(f):
                if row.tag == f"{_NS}row":
                    out = []
                    for cell in row.iter(f"{_NS}c"):
                        value = cell.find(f"{_NS}v")
                        raw = (value.text or "") if value is not None else "".join(t.text or "" for t in cell.iter(f"{_NS}t"))
                        out.append(shared[int(raw)] if cell.get("t") == "s" and raw else raw)
                    yield out
                    row.clear()


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition):
        with open(partition.value, "rb") as f:
            for i, row in enumerate(sheet_rows(f.read())):
                yield partition.value, i, row


class XlsxSource(DataSource):
    """spark.read.format("xlsx").load(path): one partition for each workbook on a path that all executors see. For stores that only
    Spark reads, use ``read_xlsx``."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def schema(self) -> str:
        return "path string, pos int, cells array<string>"

    def reader(self, schema) -> DataSourceReader:
        return _Reader([p for p in self.options["path"].split(",") if p])


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """(path, pos, cells) through Spark's own file access."""
    def rows(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                cells = list(sheet_rows(content))
                yield pa.record_batch([pa.array([name] * len(cells)), pa.array(range(len(cells)), pa.int32()), pa.array(cells, pa.list_(pa.string()))], ["path", "pos", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(rows, "path string, pos int, cells array<string>")


def classifier_rows(sheet: DataFrame, edition: str) -> DataFrame:
    """The classifier from its sheet: exact header, rows with a code, unique codes, in order of code."""
    from ..operators.constraints import require_unique
    from ..operators.temporal import level_of

    head = sheet.orderBy("pos").first()
    if head is None or head.cells[: len(SHEET_HEADER)] != SHEET_HEADER:
        raise ConstraintError(f"unexpected header {head and head.cells}")
    cell = lambda i: F.get("cells", F.lit(i))
    rows = sheet.where((F.col("pos") > head.pos) & (F.coalesce(cell(0), F.lit("")) != ""))
    out = rows.select(cell(0).alias("kato"), F.lit(edition).alias("kato_version"), level_of(cell(0)).alias("level"), cell(5).alias("type_code"), cell(7).alias("name_ru"), cell(6).alias("name_kk"))
    return require_unique(out, ["kato"]).orderBy("kato")


def workbook_url(listing: DataFrame, html: str, base: str) -> str:
    """The one workbook link of a listing page; none or several are an error."""
    links = [r[0] for r in listing.select(F.explode(T.all_found(F.col(html), r'href="(/upload/[^"]*КАТО[^"]*\.xlsx)"', 1))).distinct().limit(2).collect()]
    if len(links) != 1:
        raise ConstraintError(f"{len(links)} workbook links")
    from urllib.parse import quote

    return base + quote(links[0])


def page_text(reader=None):
    """A UDF: document bytes -> squeezed text, by a function bytes -> page texts (a PDF library's, where one is installed)."""
    if reader is None:
        import pypdf

        def reader(content: bytes) -> list[str]:
            return [p.extract_text() or "" for p in pypdf.PdfReader(io.BytesIO(content)).pages]

    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if x is None else " ".join(" ".join(reader(x)).split()) for x in column.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")


class Throttle:
    """At most ``rate`` calls a second in this process; a distributed source divides its budget by its partitions."""

    def __init__(self, rate: float, clock=time.monotonic, sleep=time.sleep):
        self.gap, self.clock, self.sleep, self.next, self.lock = 1 / rate, clock, sleep, 0.0, threading.Lock()

    def wait(self) -> None:
        with self.lock:
            now = self.clock()
            if now < self.next:
                self.sleep(self.next - now)
            self.next = max(now, self.next) + self.gap


def fetch(url: str, attempts: int = 3, timeout: float = 60, throttle: Throttle | None = None, opener=urllib.request.urlopen, sleep=time.sleep) -> bytes:
    """Transport errors are tried again after 2, 4, … seconds; an HTTP status is an answer and is not."""
    for n in range(1, attempts + 1):
        if throttle:
            throttle.wait()
        try:
            with opener(url, timeout=timeout) as answer:
                return answer.read()
        except urllib.error.HTTPError:
            raise
        except OSError:
            if n == attempts:
                raise
            sleep(2 * n)
    raise ValueError("attempts must be positive")


class _KeepRedirect(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *_):
        return None


def redirect_target(url: str, opener=None) -> str:
    """The Location of a redirect, not followed, without its session id."""
    import re

    opener = opener or urllib.request.build_opener(_KeepRedirect).open
    try:
        with opener(url, timeout=60) as answer:
            target = answer.headers.get("Location")
    except urllib.error.HTTPError as e:
        if not 300 <= e.code < 400:
            raise
        target = e.headers.get("Location")
    if not target:
        raise ConstraintError(f"{url} does not redirect")
    return re.sub(r";jsessionid=[^?&]*", "", target)
