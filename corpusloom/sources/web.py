"""Landing of pages and listings from web services as a Spark data source: one partition a page, fetching is pluggable.

``fetch`` is named as "module:function"; it takes a URL and gives (status, headers, body). No network is needed here or in tests.
"""

from __future__ import annotations

import importlib
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corpusloom.functions.text import quoted

Fetch = Callable[[str], tuple[int, dict, bytes]]


def wait_for(status: int, headers: dict, attempt: int) -> float:
    """Seconds before the next try: for 429 what the service asks for, 12 at least (20 if that can't be read), times the attempt; else 2 ** attempt."""
    if status != 429:
        return float(2**attempt)
    asked = str(headers.get("Retry-After", "0"))
    return (max(12.0, float(asked)) if asked.isdigit() else 20.0) * attempt


def fetched(fetch: Fetch, url: str, tries: int = 4, sleep: Callable[[float], None] = time.sleep) -> bytes:
    """The body of url; other statuses than 429 and 5xx aren't tried again."""
    for attempt in range(1, tries + 1):
        status, headers, body = fetch(url)
        if status < 400:
            return body
        if status != 429 and status < 500 or attempt == tries:
            raise RuntimeError(f"{url}: status {status} at try {attempt}")
        sleep(wait_for(status, headers, attempt))
    raise ValueError("tries must be one or more")


def http(url: str, timeout: float = 60.0) -> tuple[int, dict, bytes]:
    """A plain fetch over HTTP, for places with a network: (status, headers, body)."""
    request = urllib.request.Request(url, headers={"User-Agent": "corpusloom"})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as response:
            return response.status, dict(response.headers), response.read()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers), e.read()


def recovered(ledger: DataFrame, fetch: str, key: str = "url", fallback: str | None = None, tries: int = 4) -> DataFrame:
    """ledger with ``status`` (RECOVERED or FAILED), ``body``, ``sha256``, ``found_at`` and ``error`` of each row's page.

    Rows are dealt out and fetched in their tasks; fetch is named as "module:function". A page that can't be had is looked for at
    the row's ``fallback`` address, if that column is named. A row that fails doesn't stop the others."""
    columns = ledger.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        module, _, name = fetch.partition(":")
        get = getattr(importlib.import_module(module), name)
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                found = {"status": "FAILED", "body": None, "found_at": None, "error": None}
                for url in [row[key], *([row[fallback]] if fallback else [])]:
                    if not url:
                        continue
                    try:
                        found |= {"status": "RECOVERED", "body": fetched(get, url, tries), "found_at": url}
                        break
                    except Exception as e:  # told in the row
                        found["error"] = str(e)
                out.append(found)
            yield pd.concat([frame.reset_index(drop=True), pd.DataFrame(out, columns=["status", "body", "found_at", "error"], dtype=object)], axis=1)

    kept = [c for c in columns if c not in ("status", "body", "found_at", "error", "sha256")]
    schema = ", ".join(f"`{c}` {ledger.schema[c].dataType.simpleString()}" for c in kept) + ", status string, body binary, found_at string, error string"
    return ledger.select(*kept).mapInPandas(run, schema).withColumn("sha256", F.sha2("body", 256))


class _Page(InputPartition):
    def __init__(self, number: int):
        super().__init__(number)
        self.number = number


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        module, _, name = options["fetch"].partition(":")
        self.module, self.name, self.url = module, name, options["url"]
        self.pages, self.tries = int(options.get("pages", 1)), int(options.get("tries", 4))
        #: Items of a full page, if the listing is to be read until a page has fewer.
        self.full = int(options.get("until_shorter_than", 0))

    def partitions(self) -> list[InputPartition]:
        if self.full:  # how many pages there are is known only by reading them one after another
            return [_Page(0)]
        return [_Page(i) for i in range(1, self.pages + 1)]

    def read(self, partition: _Page) -> Iterator[tuple]:
        fetch = getattr(importlib.import_module(self.module), self.name)
        number = partition.number or 1
        while True:
            items = json.loads(fetched(fetch, self.url.replace("{page}", str(number)), self.tries))
            for place, item in enumerate(items):
                yield number, place, json.dumps(item, ensure_ascii=False, sort_keys=True)
            if partition.number or len(items) < self.full:
                return
            number += 1


class Listing(DataSource):
    """A paged listing of JSON items. Options: url with {page}, fetch, tries; pages, or until_shorter_than."""

    @classmethod
    def name(cls) -> str:
        return "corpusloom_listing"

    def schema(self) -> str:
        return "page int, place int, item string"

    def reader(self, schema: object) -> DataSourceReader:
        return _Reader(dict(self.options))


def assets(items: DataFrame) -> DataFrame:
    """(name, size, url) of a landed listing of released files, with how often each name stands in it."""
    rows = items.select(F.from_json("item", "name STRING, size LONG, browser_download_url STRING").alias("a")).select("a.name", "a.size", F.col("a.browser_download_url").alias("url"))
    return rows.join(rows.groupBy("name").agg(F.count("*").alias("times")), "name")


def safe_name(name: Column) -> Column:
    """A file name that stays in its folder."""
    return (name != "") & ~name.isin(".", "..") & ~F.regexp_like(name, F.lit(r"[/\\\x00]"))


def page_links(parsed: Column) -> Column:
    """Titles of existing pages of the main space that a parsed page links to, in order, each once."""
    links = F.from_json(F.get_json_object(parsed, "$.parse.links"), "ARRAY<STRUCT<ns: INT, title: STRING, exists: BOOLEAN>>")
    return F.array_distinct(F.transform(F.filter(links, lambda x: (x["ns"] == 0) & F.coalesce(x["exists"], F.lit(True))), lambda x: x["title"]))


def wiki_candidates(items: DataFrame, base: str) -> DataFrame:
    """Search results of a wiki (title, pageid, wordcount, size, timestamp) with the addresses of their pages."""
    return items.withColumn("page_url", F.concat(F.lit(f"{base}/wiki/"), quoted(F.replace("title", F.lit(" "), F.lit("_"))))).withColumn(
        "api_parse_url", F.concat(F.lit(f"{base}/w/api.php?action=parse&format=json&prop=text&page="), quoted("title"))
    )
