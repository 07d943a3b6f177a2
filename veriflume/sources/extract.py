"""Text of documents by format, and the interfaces of extractors that need other software."""

from __future__ import annotations

import io
import random
import shutil
import subprocess
import tempfile
import threading
import time
import uuid
import zipfile
from collections.abc import Callable
from dataclasses import dataclass
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions.segment import sentences
from ..functions.text import suffix, valid_utf8, whitespace_normal

# Elements whose content is not text of a page.
SKIPPED = ("script", "style", "nav", "header", "footer")
# Elements that have no end tag.
EMPTY_ELEMENTS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


class _Text(HTMLParser):
    """Text outside skipped elements. An element that is never closed ends with the one it stands in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.parts = [], []

    def handle_starttag(self, tag, attrs):
        if tag not in EMPTY_ELEMENTS:
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag in self.open:
            while self.open.pop() != tag:
                pass

    def handle_data(self, data):
        if not any(t in SKIPPED for t in self.open):
            self.parts.append(data)


def html_text(html: str | None) -> str | None:
    """Text nodes outside skipped elements, joined by newlines; blanks squeezed, ends trimmed; none if empty."""
    p = _Text()
    p.feed(html or "")
    p.close()
    text = "\n".join(p.parts).replace("\t", " ").replace("\r", "")
    while "  " in text:
        text = text.replace("  ", " ")
    return text.strip() or None


def docx_text(data: bytes) -> str | None:
    """Paragraphs outside tables, then table rows with cells two spaces apart."""
    body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml")).find(f"{_W}body")
    text = lambda e: "".join(t.text or "" for t in e.iter(f"{_W}t"))
    lines = [text(p) for p in body.findall(f"{_W}p")]
    for table in body.iter(f"{_W}tbl"):
        lines += ["  ".join(text(c).strip() for c in row.findall(f"{_W}tc")) for row in table.iter(f"{_W}tr")]
    return "\n".join(x for x in lines if x.strip()).strip() or None


def tei_parts(xml: str | None) -> tuple[list[str], list[str]]:
    """All ``s`` elements of a TEI document, and its ``p`` elements, with their full inner text."""
    try:
        root = ElementTree.fromstring(xml or "")
    except ElementTree.ParseError:
        return [], []
    inner = lambda tag: [" ".join("".join(e.itertext()).split()) for e in root.iter(f"{{http://www.tei-c.org/ns/1.0}}{tag}")]
    return [s for s in inner("s") if s], [p for p in inner("p") if p]


@F.pandas_udf(StructType([StructField("s", ArrayType(StringType())), StructField("p", ArrayType(StringType()))]))
def tei_udf(xml: pd.Series) -> pd.DataFrame:
    got = [tei_parts(x) for x in xml]
    return pd.DataFrame({"s": [g[0] for g in got], "p": [g[1] for g in got]})


def tei_sentences(df: DataFrame, col: str, out: str) -> DataFrame:
    """Sentences of a TEI column: its ``s`` elements, else its paragraphs cut into sentences, else null."""
    df = df.withColumn("_tei", tei_udf(F.col(col)))
    cut = F.flatten(F.transform("_tei.p", sentences))
    return df.withColumn(out, F.when(F.size("_tei.s") > 0, F.col("_tei.s")).when(F.size(cut) > 0, cut)).drop("_tei")


@F.pandas_udf(StringType())
def html_udf(html: pd.Series) -> pd.Series:
    return html.map(html_text)


class RateLimiter:
    """At most ``rps`` calls a second in this task; 0 sets no limit. repartition(k) bounds the tasks at work."""

    def __init__(self, rps: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.gap, self.next, self.clock, self.sleep = (1 / rps if rps > 0 else 0.0), 0.0, clock, sleep

    def acquire(self) -> None:
        now = self.clock()
        if now < self.next:
            self.sleep(self.next - now)
        self.next = max(now, self.next) + self.gap


_limiters: dict[float, RateLimiter] = {}


def limiter_of(rps: float) -> RateLimiter:
    """The limiter of this worker: calls keep their distance from batch to batch."""
    return _limiters.setdefault(rps, RateLimiter(rps))


class ServiceError(Exception):
    def __init__(self, status: int | None, message: str = ""):
        super().__init__(message or str(status))
        self.status = status


def with_retries(call: Callable[[], str], retries: int = 3, sleep: Callable[[float], None] = time.sleep, rand: Callable[[], float] = random.random) -> tuple[str | None, dict[str, object]]:
    """Result (or none) and metrics. Overload and time-outs back off twice as fast up to 30 s, other errors to 15 s."""
    metrics: dict[str, object] = {"attempts": 0, "last_status": None}
    for n in range(retries + 1):
        metrics["attempts"] = n + 1
        try:
            out = call()
            metrics["last_status"] = "ok"
            return out, metrics
        except Exception as e:
            status = getattr(e, "status", None)
            metrics["last_status"] = str(status or type(e).__name__)
            busy = status in (429, 500, 502, 503) or isinstance(e, TimeoutError)
            if n < retries:
                sleep((min(30, 2**n) if busy else min(15, 0.5 * 2**n)) + rand())
    return None, metrics


@dataclass
class Extractors:
    """Pluggable parts, each from bytes: page texts of a PDF, TEI of a PDF, OCR text. None: not available."""

    pdf_pages: Callable[[bytes], list[str]] | None = None
    tei: Callable[[bytes], str] | None = None
    ocr: Callable[[bytes], str] | None = None
    force_academic: bool = False
    prefer_ocr: bool = False
    allow_long_ocr: bool = False
    rps: float = 0.0
    retries: int = 3


def tei_service(url: str, timeout: float = 60) -> Callable[[bytes], str]:
    """A client of a TEI service: posts a PDF as a form, gets XML."""

    def call(data: bytes) -> str:
        from urllib.error import HTTPError
        from urllib.request import Request, urlopen

        mark = uuid.uuid4().hex
        head = f'--{mark}\r\nContent-Disposition: form-data; name="input"; filename="input.pdf"\r\nContent-Type: application/pdf\r\n\r\n'
        body = head.encode() + data + f"\r\n--{mark}--\r\n".encode()
        request = Request(f"{url.rstrip('/')}/api/processFulltextDocument", data=body, headers={"Content-Type": f"multipart/form-data; boundary={mark}"})
        try:
            with urlopen(request, timeout=timeout) as r:
                return r.read().decode()
        except HTTPError as e:
            raise ServiceError(e.code) from e

    return call


#: OCR runs at once in one worker, and seconds that one may take.
OCR_JOBS, OCR_SECONDS = 2, 300
_ocr_slots = threading.Semaphore(OCR_JOBS)


def ocr_program(program: str = "ocrmypdf") -> Callable[[bytes], str] | None:
    """OCR text by a program that writes a side file; none where the program isn't installed. Too slow or failed runs
    give no text."""
    if shutil.which(program) is None:
        return None

    def call(data: bytes) -> str:
        from veriflume.sources.extract import _ocr_slots  # a semaphore can't travel with the function

        with _ocr_slots, tempfile.TemporaryDirectory() as d:  # read and removed within this call
            with open(f"{d}/in.pdf", "wb") as f:
                f.write(data)
            try:
                subprocess.run([program, "--force-ocr", "--sidecar", f"{d}/out.txt", f"{d}/in.pdf", f"{d}/out.pdf"], timeout=OCR_SECONDS, check=True, capture_output=True)
                with open(f"{d}/out.txt", encoding="utf-8", errors="ignore") as f:
                    return f.read().strip()
            except (OSError, subprocess.SubprocessError):
                return ""

    return call


def should_ocr(text: str | None, pages: list[str] | None, allow_long: bool) -> bool:
    """Several pages, not over 40 unless allowed, hardly any text, none on the first three."""
    n = len(pages or [])
    return n >= 2 and (allow_long or n <= 40) and len(text or "") < 200 and not any(p.strip() for p in (pages or [])[:3])


def extract_pdf(data: bytes, name: str, tools: Extractors, limiter: RateLimiter) -> tuple[str | None, str | None, str, bool]:
    """Text, TEI, tool and whether OCR was used. TEI first if forced, else only for names that promise a paper."""
    pages = tools.pdf_pages(data) if tools.pdf_pages else None
    text = "\n".join(pages).strip() or None if pages else None
    tei = None
    if tools.tei and (tools.force_academic or any(k in name.lower() for k in ("doi", "conf", "journal"))):
        limiter.acquire()
        tei, _ = with_retries(lambda: tools.tei(data), tools.retries)
    tool = "+".join(n for n, x in (("grobid", tei), ("pymupdf", text)) if x) or "none"
    if tools.ocr and tools.prefer_ocr and should_ocr(text, pages, tools.allow_long_ocr):
        scanned = tools.ocr(data)
        if scanned and len(scanned) > len(text or ""):
            return scanned, tei, "ocr", True
    return text, tei, tool, False


RESULT = "text string, tei_xml string, extract_tool string, ocr_used boolean, extract_ok boolean, extract_error string, seconds double"


def extract_documents(files: DataFrame, tools: Extractors = Extractors()) -> DataFrame:
    """``path, source_sha256, canonical_ext, bytes`` and the result columns for every file (path, content).

    Plain text stays in built-in expressions; other formats go through one Arrow UDF. An error becomes a row with
    ``error:<type>`` as its tool, never a failed task.
    """
    ext = suffix(F.col("path"))
    base = files.select("path", F.sha2("content", 256).alias("source_sha256"), ext.alias("canonical_ext"), F.length("content").cast("long").alias("bytes"), "content")
    plain = base.where(F.col("canonical_ext").isin(".txt", ".md", ".rst"))
    text = F.nullif(whitespace_normal(valid_utf8(F.col("content"))), F.lit(""))
    none = F.lit(None).cast("string")
    plain = plain.select(
        "path", "source_sha256", "canonical_ext", "bytes", text.alias("text"), none.alias("tei_xml"), F.lit("text").alias("extract_tool"),
        F.lit(False).alias("ocr_used"), text.isNotNull().alias("extract_ok"), none.alias("extract_error"), F.lit(0.0).alias("seconds"),
    )

    def one(path: str, ext_: str, data: bytes, limiter: RateLimiter):
        start, tei, ocr = time.monotonic(), None, False
        try:
            if ext_ == ".pdf":
                text_, tei, tool, ocr = extract_pdf(data, path.rsplit("/", 1)[-1], tools, limiter)
            elif ext_ == ".docx":
                text_, tool = docx_text(data), "docx"
            elif ext_ in (".html", ".htm"):
                text_, tool = html_text(data.decode("utf-8", "ignore")), "html"
            else:
                text_, tool = None, "unsupported"
            return text_, tei, tool, ocr, bool(text_ or tei), None, time.monotonic() - start
        except Exception as e:
            return None, None, f"error:{type(e).__name__}", None, False, str(e)[:500], time.monotonic() - start

    @F.pandas_udf(RESULT)
    def udf(path: pd.Series, ext_: pd.Series, content: pd.Series) -> pd.DataFrame:
        limiter = limiter_of(tools.rps)
        return pd.DataFrame([one(p, e, bytes(c), limiter) for p, e, c in zip(path, ext_, content, strict=True)], columns=[x.split()[0] for x in RESULT.split(", ")])

    rest = base.where(~F.coalesce(F.col("canonical_ext"), F.lit("")).isin(".txt", ".md", ".rst")).withColumn("r", udf("path", "canonical_ext", "content"))
    return plain.unionByName(rest.select("path", "source_sha256", "canonical_ext", "bytes", "r.*"))
