"""Numbered states of a folder of tables: what readers see, switched at once.

A state is a small document (JSON) that names the live data folders. Data is
written to new folders first, which nobody reads; committing a state whose
number is one beyond the current one makes all of it visible together. A run
that dies before leaves the old state, and of two runs that started from the
same state only one can commit.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from meterlake import files


class CommitConflict(RuntimeError):
    """Another run has committed since this one read the state."""


class Manifest:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.folder = f"{self.base}/_states"

    def numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in files.names(self.spark, self.folder) if n.endswith(".json") and not n.startswith(".")]

    def current(self) -> tuple[int, dict]:
        """Number and content of the newest state; (0, {}) before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.state(numbers[-1])) if numbers else (0, {})

    def state(self, number: int) -> dict:
        return json.loads(files.read_text(self.spark, self._path(number)))

    def commit(self, after: int, state: dict) -> int:
        if not files.create_text(self.spark, self._path(after + 1), json.dumps(state, sort_keys=True)):
            raise CommitConflict(f"{self.base}: state {after + 1} was committed by another run")
        return after + 1

    def update(self, change: Callable[[dict], dict]) -> int:
        """Commit ``change(state)``, again from the newer state if another run was first."""
        while True:
            number, state = self.current()
            try:
                return self.commit(number, change(state))
            except CommitConflict:
                continue

    def fresh(self, kind: str) -> str:
        """A new folder name for data of a kind, relative to the base."""
        return f"{kind}/{uuid.uuid4().hex}"

    def at(self, folder: str) -> str:
        return f"{self.base}/{folder}"

    def vacuum(self, live: list[str], kinds: list[str], keep: int = 2) -> list[str]:
        """Delete data folders that none of the last ``keep`` states names, and
        older states. ``live`` gives the folders of the kept states. Not for use
        while a run is writing folders that it has not committed yet."""
        gone = []
        for kind in kinds:
            for name in files.names(self.spark, self.at(kind)):
                if f"{kind}/{name}" not in live:
                    files.delete(self.spark, self.at(f"{kind}/{name}"))
                    gone.append(f"{kind}/{name}")
        for number in self.numbers()[:-keep]:
            files.delete(self.spark, self._path(number))
        return gone

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"
