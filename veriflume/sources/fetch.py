"""Downloads behind an injected fetcher, so that nothing here needs a network."""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.tables import url_file_name

#: URL and time-out to (headers, body); raises on failure
Fetcher = Callable[[str, float], tuple[dict[str, str], bytes]]


def http_get(url: str, timeout: float) -> tuple[dict[str, str], bytes]:
    """The plain fetcher: headers and body of a GET; statuses from 400 on raise."""
    from urllib.request import Request, urlopen

    with urlopen(Request(url, headers={"User-Agent": "veriflume"}), timeout=timeout) as r:
        return dict(r.headers.items()), r.read()


def download_name(url: str, headers: dict[str, str]) -> str:
    """Name from Content-Disposition, else the URL's tail if it has a dot, else ``download.bin``."""
    given = next((v for k, v in headers.items() if k.lower() == "content-disposition"), "")
    m = re.search(r"filename\*\s*=\s*[^']*''([^;]+)", given) or re.search(r'filename\s*=\s*"?([^";]+)', given)
    tail = re.sub("[?#].*$", "", url).rsplit("/", 1)[-1]
    name = unquote(m.group(1)).strip() if m else tail if "." in tail else ""
    return re.sub(r'[\\:*?"<>|]+', "_", name.rsplit("/", 1)[-1]).strip() or "download.bin"


def fetch(urls: DataFrame, log: DataFrame, fetcher: Fetcher = http_get, timeout: float = 20, parallel: int = 4) -> DataFrame:
    """``group_id, url, saved_as, name, content, timestamp`` of http URLs that the log has no saved name for.

    A failure gives nulls, never an error. ``parallel`` bounds how many tasks call at once. Names are unique per URL.
    """
    done = log.where("coalesce(saved_as, '') <> ''").select("group_id", "url").distinct()
    todo = urls.where(F.lower("url").startswith("http")).select("group_id", "url").distinct().join(done, ["group_id", "url"], "left_anti")

    def run(batches):
        for pdf in batches:
            rows = []
            for group, url, key in zip(pdf.group_id, pdf.url, pdf.key, strict=True):
                try:
                    headers, body = fetcher(url, timeout)
                    rows.append((group, url, key, download_name(url, headers), body))
                except Exception:
                    rows.append((group, url, None, None, None))
            yield pd.DataFrame(rows, columns=["group_id", "url", "saved_as", "name", "content"])

    got = todo.withColumn("key", url_file_name(F.col("url"))).repartition(parallel, "url").mapInPandas(run, "group_id string, url string, saved_as string, name string, content binary")
    return got.withColumn("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"))
