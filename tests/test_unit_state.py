"""A unit's state is one value, read and written once however many records come."""

from __future__ import annotations

from pyspark.sql import Row

from corpusloom.streaming import units


class _Value:
    held, reads, writes = None, 0, 0

    def get(self):
        self.reads += 1
        return self.held

    def update(self, value):
        self.writes += 1
        self.held = value


class _Handle:
    def __init__(self):
        self.value, self.timers = _Value(), []

    def getValueState(self, name, schema):
        return self.value

    def registerTimer(self, due):
        self.timers.append(due)


def test_a_batch_of_records_costs_one_reading_and_one_writing():
    unit, handle = units._Units(1000), _Handle()
    unit.init(handle)
    record = lambda kind, source, text, seq: Row(kind=kind, source_sha256=source, translation=text, seq=seq, at_ms=5)
    assert not list(unit.handleInputRows((1, "u"), iter([record("translation", "s", "early", 1)]), None))
    events = list(unit.handleInputRows((1, "u"), iter([record("translation", "s", "b", 2), record("unit", "s", None, 0), record("correction", "t", "c", 3)]), None))
    assert [(r["event"], r["translation"], r["n_translations"]) for r in events] == [("UPDATED", "early", 1), ("CONFLICT", "b", 2), ("UPDATED", "b", 2), ("STALE", "c", None)]
    assert (handle.value.reads, handle.value.writes, handle.timers) == (2, 2, [])
