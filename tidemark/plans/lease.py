"""One writer per landed root: numbered leases that are taken by renaming a folder into place."""

from __future__ import annotations

import threading
import time
import uuid

from pyspark.sql import SparkSession

from tidemark import fs

FOLDER, PREFIX, DONE, BEAT = "leases", "lease-", ".done", ".beat"


class RootBusyError(RuntimeError):
    """Another landing holds the root, and did so for as long as this one was to wait."""


class LeaseLostError(RuntimeError):
    """Another landing took the root over while this one was silent for longer than the lease."""


class RootLease:
    """The right to land under ``root``, from :meth:`acquire` to :meth:`release`.

    Leases are folders numbered upwards in the root's housekeeping folder. The
    next number may be taken only if the last one is finished (a ``.done``
    file beside it) or was not renewed for ``seconds``; the store's rename
    decides between several takers, so no number has two holders.
    The number is the fencing id: a holder that finds a larger one
    (:meth:`held`) has lost the root and must take back what it published.

    A daemon thread renews the lease three times per ``seconds``; times are
    those the store gives its files, compared with a file written just now, so
    clocks of different machines do not matter. The rename must be atomic,
    as it is on HDFS and local file systems; object stores that copy leave a
    short gap.
    """

    def __init__(self, spark: SparkSession, root: str, seconds: float = 120.0, wait_seconds: float = 3600.0,
                 poll_seconds: float = 0.5):
        if seconds <= 0:
            raise ValueError("lease seconds must be positive")
        self.spark, self.root, self.seconds, self.wait, self.poll = spark, root, seconds, wait_seconds, poll_seconds
        self.folder = f"{root.rstrip('/')}/{fs.HOUSEKEEPING}/{FOLDER}"
        self.number, self.owner = 0, uuid.uuid4().hex
        self._stop = threading.Event()
        self._beating: threading.Thread | None = None

    def _path(self, number: int, suffix: str = "") -> str:
        return f"{self.folder}/{PREFIX}{number:012d}{suffix}"

    def _state(self) -> tuple[int, bool, int]:
        """(largest number or 0, whether it is finished, ms of its last sign of life)."""
        found: dict[int, dict[str, int]] = {}
        for name, _, changed in fs.children(self.spark, self.folder):
            digits, dot, suffix = name.removeprefix(PREFIX).partition(".")
            if name.startswith(PREFIX) and digits.isdigit() and dot + suffix in ("", DONE, BEAT):
                found.setdefault(int(digits), {})[dot + suffix] = changed
        # a number counts once its own folder exists: a late renewal or end of a forgotten lease makes none
        last = max((n for n, files in found.items() if "" in files), default=0)
        files = found.get(last, {})
        return last, DONE in files, max(files.get("", 0), files.get(BEAT, 0))

    def _now(self) -> int:
        """The store's clock in ms, from a file written just now."""
        name = f"now-{self.owner}"
        fs.write_text(self.spark, f"{self.folder}/{name}", "")
        now = next((changed for n, _, changed in fs.children(self.spark, self.folder) if n == name), 0)
        fs.delete(self.spark, f"{self.folder}/{name}")
        return now

    def acquire(self) -> RootLease:
        """Take the next number, waiting up to ``wait_seconds`` for the holder of the last one."""
        limit = time.monotonic() + self.wait
        while True:
            last, finished, alive = self._state()
            if last == 0 or finished or self._now() - alive > self.seconds * 1000:
                if fs.claim(self.spark, self._path(last + 1), self.owner):
                    self.number = last + 1
                    break
                continue  # another taker was first
            if time.monotonic() >= limit:
                raise RootBusyError(f"{self.root!r} is held by lease {last} of another landing")
            time.sleep(min(self.poll, max(0.0, limit - time.monotonic())))
        for old in (self.number - 2, self.number - 3):  # finished or given up two holders ago
            for suffix in ("", DONE, BEAT):
                if old > 0:
                    fs.delete(self.spark, self._path(old, suffix))
        self._stop.clear()
        self._beating = threading.Thread(target=self._renew, name=f"lease-{self.number}", daemon=True)
        self._beating.start()
        return self

    def _renew(self) -> None:
        while not self._stop.wait(self.seconds / 3):
            try:
                if not self.held():
                    return
                fs.write_text(self.spark, self._path(self.number, BEAT), self.owner)
            except Exception:  # the store is away for a moment: the next round tries again, else the lease runs out
                continue

    def held(self) -> bool:
        """True as long as no other landing has taken a larger number."""
        return self.number > 0 and self._state()[0] == self.number

    def check(self) -> None:
        if not self.held():
            raise LeaseLostError(f"lease {self.number} of {self.root!r} was taken over")

    def release(self) -> None:
        """Let the next landing in; nothing is left to do where the root was removed or taken over."""
        self._stop.set()
        if self._beating is not None:
            self._beating.join()
            self._beating = None
        if self.number and fs.exists(self.spark, self._path(self.number)):
            fs.write_text(self.spark, self._path(self.number, DONE), self.owner)
        self.number = 0

    def __enter__(self) -> RootLease:
        return self.acquire()

    def __exit__(self, *_exc) -> None:
        self.release()
