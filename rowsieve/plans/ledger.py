"""What each load held, kept beside the checkpoint, and the audit records made of it.

An entry is a file with the load's name, so a batch that is repeated replaces its entry. A load counts in one audit
record: that of the first run which finds its batch committed and not yet accounted for. Before a record is
appended it is kept as pending, with the loads it covers; a run that finds a pending record looks for it among the
audit records by its time, appends it if it is not there, and goes on. So whatever a run ends in the middle
of, the records add up to what the sinks hold of committed batches.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession

from rowsieve.sources.files import move, names_at, path_exists, read_text, remove, write_text
from rowsieve.streaming.loads import Failures, last_commit


@dataclass(frozen=True)
class Entry:
    """One load: its source, its rows, and its failures by field and code."""

    source: str
    load: str
    rows_ok: int
    rows_ko: int
    failures: Failures

    @property
    def batch(self) -> int:
        return int(self.load.rpartition("-")[2])

    def text(self) -> str:
        failures = [[field, code, n] for (field, code), n in self.failures.items()]
        return json.dumps({"source": self.source, "load": self.load, "rows_ok": self.rows_ok, "rows_ko": self.rows_ko, "failures": failures})

    @classmethod
    def of(cls, text: str) -> Entry:
        facts = json.loads(text)
        failures = {(field, code): n for field, code, n in facts.pop("failures")}
        return cls(**facts, failures=failures)


class Ledger:
    """The entries of a flow. Those in ``open`` are not accounted for yet, those in ``settled`` are."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self._spark, self._checkpoint = spark, checkpoint.rstrip("/")
        self._place = f"{self._checkpoint}/ledger"
        self._pending = f"{self._place}/pending.json"

    def write(self, entry: Entry) -> None:
        write_text(self._spark, f"{self._place}/open/{entry.load}.json", entry.text())

    def _entries(self, kind: str) -> Iterator[Entry]:
        for name in names_at(self._spark, f"{self._place}/{kind}"):
            if name.endswith(".json") and not name.startswith("."):
                yield Entry.of(read_text(self._spark, f"{self._place}/{kind}/{name}"))

    def committed(self) -> list[Entry]:
        """Loads whose batch is committed and that no audit record covers."""
        found = list(self._entries("open"))
        last = {source: last_commit(self._spark, f"{self._checkpoint}/{source}") for source in {e.source for e in found}}
        return [entry for entry in found if last[entry.source] is not None and entry.batch <= last[entry.source]]

    def settled(self) -> list[Entry]:
        return list(self._entries("settled"))

    def _settle(self, loads: list[str]) -> None:
        for load in loads:
            if path_exists(self._spark, f"{self._place}/open/{load}.json"):
                move(self._spark, f"{self._place}/open/{load}.json", f"{self._place}/settled/{load}.json")
        remove(self._spark, self._pending)

    def record(self, facts: dict, entries: list[Entry], is_there: Callable[[dict], bool], append: Callable[[dict], None]) -> None:
        """Append an audit record that covers ``entries``, once."""
        loads = [entry.load for entry in entries]
        write_text(self._spark, self._pending, json.dumps({"facts": facts, "loads": loads}))
        if not is_there(facts):
            append(facts)
        self._settle(loads)

    def recover(self, is_there: Callable[[dict], bool], append: Callable[[dict], None]) -> None:
        """Finish the record that an earlier run left pending."""
        if not path_exists(self._spark, self._pending):
            return
        pending = json.loads(read_text(self._spark, self._pending))
        if not is_there(pending["facts"]):
            append(pending["facts"])
        self._settle(pending["loads"])
