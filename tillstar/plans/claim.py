"""One load at a time on a warehouse.

Ids continue after the largest committed one, so loads of one warehouse must
not overlap.  A load claims the warehouse by creating the file ``_claim``
without overwriting; another load waits for it and fails after ``wait_s``.  A
live load renews its claim (the file's modification time) every ``BEAT_S``
seconds from a driver thread.  A claim that a waiting load sees unchanged for
``stale_s`` of its own clock was left by a lost driver and is removed, by renaming it
first, so that only one of several waiting loads removes it and a fresh claim put there
meanwhile is put back.  A load whose claim was taken meanwhile fails before its ledger row; should it
stall between that check and its commit, the ledger file, which only one run of a
batch can create, decides.  An error while renewing is raised by the next check.

Creating is atomic on HDFS and on POSIX file systems.  A store without an
atomic create (some object stores) needs one writer by other means.
"""

from __future__ import annotations

import threading
import time
import uuid

from pyspark.sql import SparkSession

from tillstar.session import create_file, file_state, move, publish_file, remove_dir, touch

BEAT_S = 15.0
STALE_S = 180.0
WAIT_S = 4 * 3600.0


class LoadInProgress(RuntimeError):
    pass


class Claim:
    """Context manager: holds the claim of the warehouse at ``root``."""

    def __init__(self, spark: SparkSession, root: str, wait_s: float = WAIT_S, stale_s: float = STALE_S):
        self.spark, self.path = spark, f"{root.rstrip('/')}/_claim"
        self.wait_s, self.stale_s = wait_s, stale_s
        self.owner = uuid.uuid4().hex
        self._done = threading.Event()
        self._failed: Exception | None = None

    def __enter__(self) -> "Claim":
        began = since = time.monotonic()
        seen = None
        while not create_file(self.spark, self.path, self.owner):
            now, state = time.monotonic(), file_state(self.spark, self.path)
            if state != seen:
                seen, since = state, now
            elif state is not None and now - since >= self.stale_s:
                self._remove(state)
                continue
            if now - began >= self.wait_s:
                raise LoadInProgress(f"another load holds {self.path}")
            time.sleep(min(1.0, self.stale_s / 4))
        self._beat = threading.Thread(target=self._renew, daemon=True)
        self._beat.start()
        return self

    def _remove(self, stale: tuple[str, int]) -> None:
        """Take a claim away if it still is the stale one."""
        aside = f"{self.path}-{self.owner}"
        if move(self.spark, self.path, aside):
            state = file_state(self.spark, aside)
            if state is not None and state[0] != stale[0]:  # another load has claimed meanwhile
                publish_file(self.spark, self.path, state[0])
            remove_dir(self.spark, aside)

    def _renew(self) -> None:
        while not self._done.wait(BEAT_S):
            try:
                if self.held():
                    touch(self.spark, self.path)
            except Exception as error:  # noqa: BLE001  the load learns of it before it commits
                self._failed = error
                return

    def held(self) -> bool:
        state = file_state(self.spark, self.path)
        return state is not None and state[0] == self.owner

    def check(self) -> None:
        if self._failed is not None:
            raise LoadInProgress(f"the claim {self.path} could not be renewed") from self._failed
        if not self.held():
            raise LoadInProgress(f"the claim {self.path} was taken by another load")

    def __exit__(self, *exc) -> None:
        self._done.set()
        self._beat.join()
        if self.held():
            remove_dir(self.spark, self.path)
