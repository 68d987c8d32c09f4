"""One writer of an archive at a time, in any store: leases by numbered files.

A lease is the file ``.lease/<number>`` with its owner and the time it holds until.  Only the highest number counts.  Whoever finds it
free or expired creates the next number; creation is exclusive, so that of several takers one gets it, and a lease that a crash left
behind lasts until its time and no longer.  The owner extends its time from a thread of its own, and asks before a commit whether a
higher number has been given out meanwhile.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import SparkSession

from missivelake.sources.stores import Store

FOLDER, FREE = ".lease", ".free"
#: How long a lease lasts without being extended; clocks of writers may differ by much less.
SECONDS = 300.0


class LeaseHeld(RuntimeError):
    """Another writer holds the lease."""


class LeaseLost(RuntimeError):
    """The lease has expired and another writer has taken it."""


class Lease:
    def __init__(self, spark: SparkSession, root: str, seconds: float = SECONDS, owner: str | None = None, clock: Callable[[], float] = time.time):
        self.store, self.folder, self.seconds, self.clock = Store(spark, root), f"{root}/{FOLDER}", seconds, clock
        self.owner, self.number = owner or uuid.uuid4().hex, 0

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:012d}"

    def _numbers(self) -> list[int]:
        return sorted(int(name) for name, _ in self.store.names(self.folder) if name.isdigit())

    def _content(self) -> bytes:
        return json.dumps({"owner": self.owner, "until": self.clock() + self.seconds}).encode()

    def _taken(self, number: int) -> bool:
        """Whether a number is neither free nor expired; a file without content, which is just being made or was never
        finished, holds from its own time on."""
        if self.store.exists(self._path(number) + FREE):
            return False
        try:
            until = json.loads(self.store.read(self._path(number)) or b"")["until"]
        except (ValueError, KeyError):
            until = self.store.modified(self._path(number)) + self.seconds
        return until > self.clock()

    def acquire(self) -> int:
        """Takes the next number, or says who holds the present one."""
        numbers = self._numbers()
        if numbers and self._taken(numbers[-1]):
            raise LeaseHeld(f"{self._path(numbers[-1])} holds; it is free when its time is over")
        number = (numbers[-1] if numbers else 0) + 1
        if not self.store.create(self._path(number), self._content()):
            raise LeaseHeld(f"another writer has just taken {self._path(number)}")
        self.number = number
        later = [n for n in self._numbers() if n > number]
        if later:  # what we had seen as the last was long gone
            self.store.delete(self._path(number))
            raise LeaseHeld(f"another writer holds {self._path(later[-1])}")
        for n in numbers:
            self.store.delete(self._path(n) + FREE)
            self.store.delete(self._path(n))
        return number

    def check(self) -> None:
        """Fails if a higher number has been given out or ours is gone."""
        numbers = self._numbers()
        if not numbers or numbers[-1] != self.number:
            raise LeaseLost(f"{self._path(self.number)} has expired and was taken over")

    def extend(self) -> None:
        self.check()
        self.store.put(self._path(self.number), self._content())

    def release(self) -> None:
        """Frees the number; it stays as the last one given out."""
        if self.number in self._numbers():
            self.store.create(self._path(self.number) + FREE, self.owner.encode())


@contextmanager
def lease(spark: SparkSession, root: str, seconds: float = SECONDS):
    """Holds the lease of a folder, extended at every third of its time, until the block ends."""
    held, ended = Lease(spark, root, seconds), threading.Event()
    held.acquire()

    def beat():
        while not ended.wait(seconds / 3):
            try:
                held.extend()
            except LeaseLost:
                return  # the owner learns it from check

    thread = threading.Thread(target=beat, daemon=True)
    thread.start()
    try:
        yield held
    finally:
        ended.set()
        thread.join()
        held.release()
