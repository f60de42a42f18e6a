"""What a run has done and what it set out to change, so that a run that died can go on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starload.plans.snapshots import read_snapshot, write_snapshot
from starload.sources.folders import place, remove


class Ledger:
    """Finished steps and stored tables of the run in progress, below one folder.

    Another ``run`` than the one on record starts over; without a name every run does. Only what the run was to change,
    ``pending``, outlives a run that died, until a run is finished.
    """

    def __init__(self, spark: SparkSession, folder: str, run: str | None = None):
        self.spark, self.folder, self.run = spark, folder, run
        if run is None or not self._exists(f"run={run}"):
            for part in ("steps", "tables"):
                remove(spark, f"{folder}/{part}")
            self._touch(f"run={run}") if run else None

    def _exists(self, name: str) -> bool:
        fs, path = place(self.spark, f"{self.folder}/steps/{name}")
        return fs.exists(path)

    def _touch(self, name: str) -> None:
        fs, path = place(self.spark, f"{self.folder}/steps/{name}")
        fs.create(path).close()

    def step(self, name: str, work) -> bool:
        """Do a step unless it is on record; whether it was done now."""
        if self._exists(name):
            return False
        work()
        self._touch(name)
        return True

    def table(self, name: str, build) -> DataFrame:
        """A table of the run: as it was stored, or else built and stored now."""
        root = f"{self.folder}/tables/{name}"
        stored = read_snapshot(self.spark, root, keep_period=True)
        return write_snapshot(build(), root, keep_period=True) if stored is None else stored

    def pending(self, name: str, found: DataFrame) -> DataFrame:
        """``found`` and what runs that died left of it."""
        root = f"{self.folder}/pending/{name}"
        left = read_snapshot(self.spark, root, keep_period=True)
        return write_snapshot(found if left is None else found.unionByName(left).distinct(), root, keep_period=True)

    def finish(self) -> None:
        remove(self.spark, self.folder)
