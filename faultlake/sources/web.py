"""Fetching pages: one session per task, a pause after each success, failures as null."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

AGENT, TIMEOUT, DELAY = "Mozilla/5.0 (compatible; faultlake)", 10.0, 1.0


def http_get(url: str) -> str | None:
    """Body of a page; None for an HTTP or network error."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": AGENT}), timeout=TIMEOUT) as answer:
            return answer.read().decode(answer.headers.get_content_charset() or "utf-8", "replace")
    except (urllib.error.URLError, TimeoutError, OSError):
        return None


def fetch(urls: DataFrame, delay: float = DELAY, get: Callable[[str], str | None] = http_get) -> DataFrame:
    """(page_id, url, html) of (page_id, url); html is null where the page could not be fetched."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pages = []
            for url in batch["url"]:
                pages.append(get(url) if url else None)
                if pages[-1] is not None and delay:
                    time.sleep(delay)
            yield batch.assign(html=pd.Series(pages, index=batch.index, dtype=object))

    return urls.select("page_id", "url").mapInPandas(run, "page_id long, url string, html string")


def fetched(pages: DataFrame) -> DataFrame:
    """Pages without the failed ones."""
    return pages.where("html is not null and html <> ''")
