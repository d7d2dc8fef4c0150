"""A listing of a rate-limited service, landed as a stream: what failed comes again in later batches, and a restart loses and repeats nothing.

``corpusloom_landing`` reads pages 1, 2, ... of a listing until one has fewer items than a full page. A batch is a plan: the pages to be fetched, in a file
that is written once and never changed, so a batch that runs again after a failure asks for the same pages. The offset is the plan's number, with what
it is to be known by: the next new page, when the service may be asked again, and the ETag of the last page. Tasks fetch a page each, and
leave its outcome in a file beside the plans; the next plan is made of all outcomes, so the driver keeps nothing in memory that a restart would need.

A page that the service answers with 429 comes again after what it asks for, 60 seconds at least and 300 at most, and until then no plan is made at all; one that it
answers with 5xx, or doesn't answer, comes again after 2, 4, ... seconds. After ``tries`` a page has FAILED, as at once for other statuses, and the others go on. With
``poll`` seconds the last page is asked for again, with its ETag, and what was appended to it and after it is landed.

Options: url (with {page}), fetch ("module:function" of (url, headers) that gives (status, headers, body)), state (a folder that driver and tasks share), full
(items of a full page), per_batch (pages of a plan), tries, poll, clock ("module:function" of the state folder that gives seconds; tests).
"""

from __future__ import annotations

import importlib
import json
import time
import uuid
from collections.abc import Callable, Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from corpusloom.sources.published import file_system

# Seconds that a service's wish to wait counts for at least and at most.
LEAST_WAIT, MOST_WAIT = 60, 300
SCHEMA = "page int, place int, item string, status string, tries int, plan int, error string"


def named(path: str) -> Callable:
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def asked_wait(headers: dict) -> int:
    """Seconds until a service may be asked again, of an answer with status 429."""
    asked = str({k.lower(): v for k, v in headers.items()}.get("retry-after", LEAST_WAIT)).strip()
    return min(MOST_WAIT, max(LEAST_WAIT, int(asked) if asked.isdigit() else LEAST_WAIT))


class _Folder:
    """JSON files that are there wholly or not at all."""

    def __init__(self, path: str):
        self.system, self.root = file_system(path.rstrip("/"))

    def put(self, name: str, value: dict, once: bool = False) -> None:
        place = f"{self.root}/{name}"
        if once and self.system.get_file_info(place).type == fs.FileType.File:
            return
        self.system.create_dir(place.rsplit("/", 1)[0], recursive=True)
        part = f"{place}.{uuid.uuid4().hex}"
        with self.system.open_output_stream(part) as out:
            out.write(json.dumps(value).encode())
        self.system.move(part, place)

    def get(self, name: str) -> dict | None:
        place = f"{self.root}/{name}"
        if self.system.get_file_info(place).type != fs.FileType.File:
            return None
        with self.system.open_input_stream(place) as f:
            return json.loads(f.read())


class _Page(InputPartition):
    def __init__(self, plan: int, page: int, tries: int, seen: int, etag: str | None):
        super().__init__(page)
        self.plan, self.page, self.tries, self.seen, self.etag = plan, page, tries, seen, etag


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.url, self.fetch, self.state = options["url"], options["fetch"], options["state"]
        self.full, self.per_batch = int(options["full"]), int(options.get("per_batch", 8))
        self.tries, self.poll = int(options.get("tries", 4)), int(options.get("poll", 0))
        self.clock = options.get("clock")

    def now(self) -> float:
        return named(self.clock)(self.state) if self.clock else time.time()

    # ---- the driver

    def initialOffset(self) -> dict:
        return {"plan": 0, "next": 1, "retry_at": 0, "etag": ""}

    @staticmethod
    def offset_of(plan: dict) -> dict:
        return {"plan": plan["plan"], "next": plan["next"], "retry_at": int(plan["retry_at"]), "etag": plan["etag"] or ""}

    def latestOffset(self) -> dict:
        folder = _Folder(self.state)
        number = (folder.get("last.json") or {"plan": 0})["plan"]
        plan = folder.get(f"plans/{number}.json") or {"plan": 0, "next": 1, "pages": [], "waiting": [], "ended": None, "hold": 0, "retry_at": 0, "etag": None}
        outcomes = [folder.get(f"outcomes/{number}-{p['page']}.json") for p in plan["pages"]]
        if any(o is None for o in outcomes):  # it hasn't run yet
            return self.offset_of(plan)
        following = self.after(plan, outcomes, self.now())
        if following is None:
            return self.offset_of(plan)
        folder.put(f"plans/{following['plan']}.json", following, once=True)
        folder.put("last.json", {"plan": following["plan"]})
        return self.offset_of(folder.get(f"plans/{following['plan']}.json"))

    def after(self, plan: dict, outcomes: list[dict], now: float) -> dict | None:
        """The plan after one with these outcomes; none while there is nothing to ask for or the service isn't to be asked."""
        waiting, hold, ended = [dict(w) for w in plan["waiting"]], plan["hold"], plan["ended"]
        for page, o in zip(plan["pages"], outcomes, strict=True):
            if o["status"] == "RETRY":
                waiting.append({"page": page["page"], "tries": page["tries"] + 1, "seen": page["seen"], "etag": page["etag"], "due": o["due"]})
                hold = max(hold, o["due"] if o["limited"] else 0)
            elif o["status"] == "RECOVERED" and o["items"] < self.full and (ended is None or page["page"] <= ended["page"]):
                ended = {"page": page["page"], "items": o["items"], "etag": o["etag"], "at": o["at"]}
            elif o["status"] == "UNCHANGED":
                ended = ended | {"at": o["at"]}
            elif o["status"] == "RECOVERED" and ended is not None and page["page"] == ended["page"]:
                ended = None  # the last page has become a full one, so others follow
        if now < hold:
            return None
        due = [w for w in waiting if w["due"] <= now]
        pages = [{k: w[k] for k in ("page", "tries", "seen", "etag")} for w in sorted(due, key=lambda w: w["page"])[: self.per_batch]]
        taken = {p["page"] for p in pages}
        waiting = [w for w in waiting if w["page"] not in taken]
        following = plan["next"]
        if ended is None:
            while len(pages) < self.per_batch:
                pages.append({"page": following, "tries": 1, "seen": 0, "etag": None})
                following += 1
        else:
            following = max(ended["page"] + 1, 1)
            if self.poll and ended["page"] not in taken | {w["page"] for w in waiting} and now >= ended["at"] + self.poll and len(pages) < self.per_batch:
                pages.append({"page": ended["page"], "tries": 1, "seen": ended["items"], "etag": ended["etag"]})
        if not pages:
            return None
        retry_at = max([hold, *(w["due"] for w in waiting)], default=0)
        return {"plan": plan["plan"] + 1, "next": following, "pages": pages, "waiting": waiting, "ended": ended, "hold": hold, "retry_at": retry_at, "etag": (ended or {}).get("etag")}

    def partitions(self, start: dict, end: dict) -> list[_Page]:
        folder = _Folder(self.state)
        found = []
        for number in range(start["plan"] + 1, end["plan"] + 1):
            found += [_Page(number, p["page"], p["tries"], p["seen"], p["etag"]) for p in folder.get(f"plans/{number}.json")["pages"]]
        return found

    # ---- a task

    def read(self, partition: _Page) -> Iterator[tuple]:
        p = partition
        headers = {"If-None-Match": p.etag} if p.etag else {}
        try:
            status, got, body = named(self.fetch)(self.url.replace("{page}", str(p.page)), headers)
            error = None if status in (200, 304) else f"status {status}"
        except OSError as e:
            status, got, body, error = 599, {}, b"", f"{type(e).__name__}: {e}"
        outcome = {"status": "RECOVERED", "items": 0, "etag": {k.lower(): v for k, v in got.items()}.get("etag"), "at": self.now(), "due": 0, "limited": status == 429}
        items: list = []
        if status == 304:
            outcome |= {"status": "UNCHANGED"}
        elif status == 200:
            items = json.loads(body)
            outcome |= {"items": len(items)}
        elif (status == 429 or status >= 500) and p.tries < self.tries:
            outcome |= {"status": "RETRY", "due": self.now() + (asked_wait(got) if status == 429 else 2**p.tries)}
        else:
            outcome |= {"status": "FAILED"}
        for place, item in enumerate(items):
            if place >= p.seen:
                yield p.page, place, json.dumps(item, ensure_ascii=False, sort_keys=True), "RECOVERED", p.tries, p.plan, None
        if outcome["status"] in ("RETRY", "FAILED"):
            yield p.page, None, None, outcome["status"], p.tries, p.plan, error
        _Folder(self.state).put(f"outcomes/{p.plan}-{p.page}.json", outcome)


class Landing(DataSource):
    """See above."""

    @classmethod
    def name(cls) -> str:
        return "corpusloom_landing"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: object) -> DataSourceStreamReader:
        return _Reader(dict(self.options))


def landed(spark: SparkSession, url: str, fetch: str, state: str, full: int, **options: object) -> DataFrame:
    """The stream of a listing: (page, place, item, status, tries, plan, error), a row for each item and for each page that failed."""
    spark.dataSource.register(Landing)
    reader = spark.readStream.format("corpusloom_landing").options(url=url, fetch=fetch, state=state, full=full)
    return reader.options(**options).load()


def ledger(rows: DataFrame) -> DataFrame:
    """(page, status, tries, items) of landed rows: what became of each page in the last plan that asked for it."""
    last = rows.groupBy("page", "plan").agg(F.max("status").alias("status"), F.max("tries").alias("tries"))
    items = rows.groupBy("page").agg(F.count("item").alias("items"))
    return last.groupBy("page").agg(F.max_by("status", "plan").alias("status"), F.max_by("tries", "plan").alias("tries")).join(items, "page")
