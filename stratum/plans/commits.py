"""Runs that share a dataset: leases tell which are alive, commits happen one after the other.

A run holds a lease, a file named by the run's id that it renews while it works. What changes the state of a dataset
(schema, manifest, deletions) happens inside a commit: a numbered file that only one run can create. The next number is
free once the last one has its end mark, or once the lease of its owner has run out: a driver that died blocks nobody for longer than a lease.
Nothing here grows with the data; the folders hold a file per live run and some per recent commit.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from .. import files

LEASE_SECONDS = 120.0
WAIT_SECONDS = 0.1
KEPT_COMMITS = 16


class RunLog:
    """Lease and commits of one run over the state folder of a dataset."""

    def __init__(self, spark: SparkSession, state: str, run: int):
        self.spark, self.run = spark, run
        self.leases, self.commits = f"{state}/runs", f"{state}/commits"
        self._depth = 0
        self._stop = threading.Event()

    @contextmanager
    def lease(self) -> Iterator[None]:
        path = f"{self.leases}/{self.run}"
        files.write_text(self.spark, path, str(self.run))

        def renew() -> None:
            while not self._stop.wait(LEASE_SECONDS / 4):
                files.write_text(self.spark, path, str(self.run))

        keeper = threading.Thread(target=renew, daemon=True)
        keeper.start()
        try:
            yield
        finally:
            self._stop.set()
            keeper.join()
            files.delete(self.spark, path)

    def live_runs(self) -> list[int]:
        """Ids of the runs with a lease that has not run out."""
        if not files.exists(self.spark, self.leases):
            return []
        now = time.time()
        alive = [name for name, stamp in files.stamps(self.spark, self.leases) if now - stamp < LEASE_SECONDS]
        return sorted(int(name) for name in alive if name.isdigit())

    def oldest_live(self) -> int:
        """Nothing that a run younger than this wrote may be taken for left behind."""
        return min([self.run, *self.live_runs()])

    def _last(self) -> tuple[int, set[str]]:
        names = {name for name, _ in files.stamps(self.spark, self.commits)} if files.exists(self.spark, self.commits) else set()
        return max((int(name) for name in names if name.isdigit()), default=0), names

    def _blocked(self, last: int, names: set[str]) -> bool:
        if not last or f"{last:012d}.done" in names:
            return False
        owner = files.read_text(self.spark, f"{self.commits}/{last:012d}")
        return not owner.isdigit() or int(owner) in self.live_runs()

    @contextmanager
    def commit(self) -> Iterator[None]:
        """Alone among all runs of the dataset. A commit inside a commit is part of it."""
        if self._depth:
            yield
            return
        while True:
            last, names = self._last()
            if not self._blocked(last, names) and files.create_new(self.spark, path := f"{self.commits}/{last + 1:012d}", str(self.run)):
                break
            time.sleep(WAIT_SECONDS)
        self._depth = 1
        try:
            yield
        finally:
            self._depth = 0
            files.write_text(self.spark, f"{path}.done", str(self.run))
            for name in names:
                if name[:12].isdigit() and int(name[:12]) <= last - KEPT_COMMITS:
                    files.delete(self.spark, f"{self.commits}/{name}")
