"""Units of an alignment as state that lives with the stream: late corrections, conflicts while they arrive, units that nobody translates.

Records (rank, unit_id, kind, source_sha256, translation, seq, at) come in any order. ``unit`` records name a unit's source; ``translation`` and ``correction``
records are bound to a source by its hash. The state of a unit is its source, its newest translation by (seq, translation), the different translations that
weren't corrections, and what came before its source did. Rows are given as they come about:

* UPDATED: the unit has another translation; later rows of a unit replace earlier ones.
* CONFLICT: a second, third, ... different translation of one source that isn't a correction.
* STALE: a translation or correction of another source than the unit's, or a unit that is named again with another source (which isn't taken).
* TIMED_OUT: by event time, no translation came within ``patience`` of the unit; one that comes later still updates it.

A record that comes again, as after a failure of its source, changes nothing. Records that come later than the watermark's delay allows are dropped. State is kept by RocksDB, in the checkpoint of the query.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

RECORD = "rank int, unit_id string, kind string, source_sha256 string, translation string, seq long, at timestamp"
OUT = "rank int, unit_id string, event string, source_sha256 string, translation string, seq long, n_translations int, at timestamp"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


#: All that is known of a unit, as one value: a record costs one reading and one writing. A unit has few translations, and few records come before its source does.
_STATE = (
    "source_sha256 string, due long, translation string, seq long, hashes array<string>, "
    "early array<struct<kind: string, source_sha256: string, translation: string, seq: long, at: long>>"
)
_OUT_MS = OUT.replace("at timestamp", "at_ms long")
_EVENT = Row(*[field.split(" ")[0] for field in _OUT_MS.split(", ")])


class _Units(StatefulProcessor):
    def __init__(self, patience_ms: int):
        self.patience = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("unit", _STATE)

    def _known(self) -> dict:
        names = ("source", "due", "translation", "seq", "hashes", "early")
        held = self.state.get()
        found = dict(zip(names, held if held is not None else [None] * len(names), strict=True))
        return found | {"hashes": list(found["hashes"] or []), "early": [tuple(e) for e in found["early"] or []]}

    @staticmethod
    def _take(unit: dict, key: tuple, kind: str, source: str, translation: str, seq: int, at: int) -> Iterator[Row]:
        own, held = unit["source"], unit["hashes"]
        if source != own:
            yield _EVENT(*key, "STALE", source, translation, seq, None, at)
            return
        mark = sha(translation)
        if kind == "translation" and mark not in held:
            held.append(mark)
            if len(held) > 1:
                yield _EVENT(*key, "CONFLICT", own, translation, seq, len(held), at)
        if unit["seq"] is None or (seq, translation) > (unit["seq"], unit["translation"]):
            unit["translation"], unit["seq"] = translation, seq
            yield _EVENT(*key, "UPDATED", own, translation, seq, len(held), at)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        unit = self._known()
        order = sorted(rows, key=lambda r: (r["kind"] != "unit", r["seq"] is None, r["seq"] or 0, r["translation"] is None, r["translation"] or ""))
        for r in order:
            kind, source, at, seq, translation = r["kind"], r["source_sha256"], r["at_ms"] or 0, r["seq"] or 0, r["translation"] or ""
            if kind == "unit":
                if unit["due"] is not None:
                    if unit["source"] != source:
                        yield _EVENT(*key, "STALE", source, None, None, None, at)
                    continue
                unit["source"], unit["due"] = source, at + self.patience
                for e in unit["early"]:
                    yield from self._take(unit, key, *e)
                unit["early"] = []
                if unit["seq"] is None:
                    self.handle.registerTimer(unit["due"])
            elif unit["due"] is not None:
                yield from self._take(unit, key, kind, source, translation, seq, at)
            else:
                unit["early"].append((kind, source, translation, seq, at))
        self.state.update((unit["source"], unit["due"], unit["translation"], unit["seq"], unit["hashes"], unit["early"]))

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[Row]:
        unit = self._known()
        if unit["due"] is not None and unit["seq"] is None:
            yield _EVENT(*key, "TIMED_OUT", unit["source"], None, None, 0, unit["due"])

    def close(self) -> None:
        pass


def unit_events(records: DataFrame, patience: int, delay: str = "0 seconds") -> DataFrame:
    """The rows that the units of a stream of records give; patience in seconds, delay of the watermark."""
    records.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    known = records.withWatermark("at", delay).withColumn("at_ms", F.unix_millis("at"))
    events = known.groupBy("rank", "unit_id").transformWithState(_Units(patience * 1000), _OUT_MS, "Append", "EventTime")
    return events.withColumn("at", F.timestamp_millis("at_ms")).drop("at_ms")


def settled(events: DataFrame) -> DataFrame:
    """The last translation of each unit, of all rows that were given."""
    last = F.max_by(F.struct("source_sha256", "translation", "seq"), F.struct("seq", "translation")).alias("last")
    return events.filter("event = 'UPDATED'").groupBy("rank", "unit_id").agg(last).select("rank", "unit_id", "last.*")


def record_files(spark: SparkSession, path: str, files: int = 1) -> DataFrame:
    """A stream of records from JSON files below path, so many a batch."""
    return spark.readStream.schema(RECORD).option("maxFilesPerTrigger", files).json(path)
