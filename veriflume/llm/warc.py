"""WARC archives, index first.

Writing a partition yields its archive file and, per record, an index row: file, offset, length, URL, digest. Reading
starts from the index: selected rows are sorted by place, ranges that lie close are joined into one read, and the
records are cut out of it. Files get a name of their own per attempt, and only the index of the attempt that Spark
accepted names them: a task that runs twice leaves an orphan, never a broken archive.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, need, scratch_path, sendable

INDEX = "file string, offset long, length long, url string, digest string, record_type string"
#: Gap between records that is read over, and the most that one read asks for (unless one record is longer).
GAP, WINDOW = 64 << 10, 8 << 20
#: Bytes of an archive that one task reads.
STRETCH = 64 << 20
MIN_REVISIT = 1000
#: Most repeated digests that are sent to every task, and bytes of payloads that a reader holds before it hands them on.
SENT_DIGESTS, HELD = 200_000, 16 << 20


def _fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _header(fields: list[tuple[str, object]]) -> bytes:
    """``Name: value`` lines; line breaks in values would end them early."""
    return "".join(f"{k}: {str(v).replace(chr(13), ' ').replace(chr(10), ' ')}\r\n" for k, v in fields if v is not None).encode()


def record(url: str | None, payload: bytes, digest: str, kind: str, key: object = None, refers_to: object = None) -> bytes:
    """One WARC/1.1 record, its own gzip member. A revisit keeps the HTTP headers of the payload, not the payload."""
    http = b"HTTP/1.1 200 OK\r\n" + _header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))]) + b"\r\n"
    block = http if kind == "revisit" else http + payload
    head = b"WARC/1.1\r\n" + _header(
        [
            ("WARC-Type", kind),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
            ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Target-URI", url),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if kind == "revisit" else None),
            ("WARC-Refers-To-Key", refers_to),
            ("X-Key", key),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", len(block)),
        ]
    )
    return gzip.compress(head + b"\r\n" + block + b"\r\n\r\n", compresslevel=1, mtime=0)


def _fields(lines: bytes) -> dict[str, str]:
    return dict(x.split(": ", 1) for x in lines.decode().split("\r\n")[1:] if ": " in x)


def parse(raw: bytes) -> dict[str, object]:
    """Header fields, HTTP fields and payload (None for a revisit) of one record; its digest is checked."""
    data = zlib.decompress(raw, wbits=31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["Content-Length"])]
    if len(block) != int(fields["Content-Length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a WARC record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    if fields["WARC-Type"] != "revisit" and "sha1:" + hashlib.sha1(payload).hexdigest() != fields["WARC-Payload-Digest"]:
        raise ValueError("a WARC payload differs from its digest")
    return {"fields": fields, "http": _fields(http), "payload": None if fields["WARC-Type"] == "revisit" else payload}


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """``page_id, url, html, digest, n_bytes, record_type, refers_to``.

    Of equal payloads of at least ``min_bytes`` the largest page_id is the response. Null html is empty. Rows with a
    null page_id, and rows repeating the response's id, are responses; other columns don't matter. Small payloads go past
    the join. Large ones meet the digests that occur twice or more, found by counts and maxima; pages move to these
    only if they are too many to send to every task.
    """
    need(pages, "page_id", "url", "html")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("n_bytes", F.octet_length("html").cast("long")).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    large = rows.where(F.col("n_bytes") >= min_bytes)
    groups = large.groupBy("digest").agg(F.max("page_id").alias("largest"), F.count("*").alias("copies")).where("copies > 1").select("digest", "largest")
    small = rows.where(F.col("n_bytes") < min_bytes).withColumn("largest", F.lit(None).cast(pages.schema["page_id"].dataType))
    joined = small.unionByName(large.join(sendable(materialise(groups, "repeated-pages"), SENT_DIGESTS), "digest", "left"))
    revisit = F.coalesce(F.col("page_id") < F.col("largest"), F.lit(False))
    return joined.select("page_id", "url", "html", "digest", "n_bytes", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("largest")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write each partition as one archive under ``folder``; returns the index, stored in the shared folder.

    ``records`` has page_id, url, html, digest, record_type and refers_to.
    """

    def run(batches):
        fs, base = _fs(folder)
        fs.create_dir(base, recursive=True)
        name, at, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        try:
            for pdf in batches:
                rows = []
                for r in pdf.itertuples(index=False):
                    raw = record(r.url, r.html.encode(), r.digest, r.record_type, None if pd.isna(r.page_id) else int(r.page_id), None if pd.isna(r.refers_to) else int(r.refers_to))
                    out = out or fs.open_output_stream(f"{base}/{name}", compression=None)
                    out.write(raw)
                    rows.append((name, at, len(raw), r.url, r.digest, r.record_type))
                    at += len(raw)
                yield pd.DataFrame(rows, columns=["file", "offset", "length", "url", "digest", "record_type"])
        finally:
            if out is not None:
                out.close()

    index = records.select("page_id", "url", "html", "digest", "record_type", "refers_to").mapInPandas(run, INDEX)
    return materialise(index, "warc-index")


def ranges(places: list[tuple[int, int]], gap: int = GAP, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """Joined reads ``(offset, length, number of records)`` of records sorted by offset."""
    out: list[list[int]] = []
    for offset, length in places:
        if out and offset - (out[-1][0] + out[-1][1]) <= gap and offset + length - out[-1][0] <= window:
            out[-1][1] = max(out[-1][1], offset + length - out[-1][0])
            out[-1][2] += 1
        else:
            out.append([offset, length, 1])
    return [tuple(x) for x in out]


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """``page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload`` of the index rows given.

    Filter the index first (URL, digest, type): only the byte ranges of its rows are read. A stretch of 64 MB of a file
    goes to one task, so that a large archive is read by many. ``payloads`` set to false checks them and leaves them.
    """
    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        for c in ("page_id", "refers_to"):
            out[c] = pd.array([None if x is None else int(x) for x in out[c]], dtype="Int64")
        return out

    def run(batches):
        fs, base = _fs(folder)
        rows, held = [], 0
        for pdf in batches:
            for file, part in pdf.groupby("file", sort=False):
                places = list(zip(part["offset"].tolist(), part["length"].tolist(), strict=True))
                with fs.open_input_file(f"{base}/{file}") as f:
                    k = 0
                    for offset, length, n in ranges(places):
                        f.seek(offset)
                        data = f.read(length)
                        for o, size in places[k : k + n]:
                            got = parse(data[o - offset : o - offset + size])
                            h = got["fields"]
                            digest, n_bytes = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(got["http"]["Content-Length"])
                            payload = got["payload"] if payloads else None
                            rows.append((h.get("X-Key"), h.get("WARC-Target-URI"), h["WARC-Type"], h.get("WARC-Refers-To-Key"), digest, n_bytes, payload))
                            held += len(rows[-1][-1] or b"") + 200
                        k += n
                        if held > HELD:
                            yield frame(rows)
                            rows, held = [], 0
        yield frame(rows)

    places = index.select("file", "offset", "length").withColumn("stretch", F.floor(F.col("offset") / STRETCH))
    # the index is small however much it stands for, so adaptive execution would have one task read all
    tasks = max(1, min(20_000, places.select("file", "stretch").distinct().count()))
    placed = places.repartition(tasks, "file", "stretch").sortWithinPartitions("file", "offset")
    return placed.mapInPandas(run, "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary")


def archive_pages(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Write the pages, read all records back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    folder = scratch_path(pages.sparkSession, "warc")
    index = write_archives(with_revisits(pages, min_bytes), folder)
    return read_records(index, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
