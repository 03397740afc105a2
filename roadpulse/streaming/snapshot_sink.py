"""``foreachBatch`` sink of the latest-per-segment snapshot.

The sink keeps a ring of ``keep`` slots. Each non-empty micro-batch takes
the slot after the one holding the newest committed version, overwrites
``data/slot=<s>`` and only then its commit record ``commits/slot=<s>`` (one
row: ``version``, one more than the newest, with ``run`` and ``batch_id``). ``sources.readers.read_snapshot`` reads the slot
of the highest committed version. The slot being rewritten never holds the
newest committed version, so a reader never lands on a half-written
snapshot. A batch re-run after a failure writes nothing if its run and batch
id are already committed (the commit follows the complete data), so re-runs
are idempotent; a run with a fresh checkpoint is another run, whose batches
follow the versions it finds. Storage stays at ``keep`` snapshots and ``keep``
commit files however long the stream runs.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from ..operators.snapshot import latest
from ..operators.transform import enrich
from ..sources.readers import snapshot_versions

DEFAULT_KEEP = 3


class SnapshotWriter:
    """Callable for ``writeStream.foreachBatch``.

    ``carry_forward=False`` keeps the reference behaviour: the snapshot is
    the newest window per segment *of this micro-batch* (segments absent
    from the batch disappear). ``carry_forward=True`` merges the previous
    committed snapshot first, so a segment keeps its last known state.
    ``segments`` (the lookup) is joined to the newest windows, after the
    per-segment pick, which then runs on fixed-width columns only.
    """

    def __init__(self, root: str, carry_forward: bool = False, keep: int = DEFAULT_KEEP,
                 segments: DataFrame | None = None, run: str = ""):
        if keep < 2:
            raise ValueError("keep at least 2 slots (one is rewritten while readers use another)")
        self.root = root.rstrip("/")
        self.carry_forward = carry_forward
        self.keep = int(keep)
        self.segments = segments
        self.run = run
        self._none_committed = False  # learned on the first batch of this run

    def _slots(self, spark, batch_id: int) -> tuple[int | None, int | None, int]:
        """(slot to write, or None when this batch is already committed; slot
        of the newest version; version to commit). The commit table has at
        most ``keep`` rows."""
        committed = []
        if not self._none_committed:
            try:
                committed = snapshot_versions(spark, self.root).collect()
            except AnalysisException as e:  # nothing committed yet: do not probe again
                if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                    raise
                self._none_committed = True
        if not committed:
            return 0, None, 0
        newest = max(committed, key=lambda r: r["version"])
        slot = int(newest["slot"])
        if any(r["run"] == self.run and r["batch_id"] == batch_id for r in committed):
            return None, slot, int(newest["version"])
        return (slot + 1) % self.keep, slot, int(newest["version"]) + 1

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        # Two actions follow (empty check, write): keep the newest rows, one a
        # segment, instead of running the stateful plan twice or keeping all
        # windows of the micro-batch.
        spark = batch_df.sparkSession
        newest = latest(batch_df).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if newest.isEmpty():
                return
            slot, prev_slot, version = self._slots(spark, int(batch_id))
            if slot is None:
                return
            previous = None
            if self.carry_forward and prev_slot is not None:
                previous = spark.read.parquet(f"{self.root}/data/slot={prev_slot}")
            snap = newest if previous is None else latest(newest, previous=previous)
            if self.segments is not None:
                snap = enrich(snap, self.segments, "left", again=True, repeated=True)
            snap.write.mode("overwrite").parquet(f"{self.root}/data/slot={slot}")
            (spark.createDataFrame([(version, self.run, int(batch_id))], "version LONG, run STRING, batch_id LONG")
             .write.mode("overwrite").parquet(f"{self.root}/commits/slot={slot}"))
            self._none_committed = False
        finally:
            newest.unpersist()
