"""A Type-2 dimension kept up to date by a stream of snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StreamingQuery

from annalist.operators.conform import keyed_rows, one_row_per_day
from annalist.operators.incremental import batch_versions
from annalist.operators.versions import build_versions
from annalist.sources.scratch import discard, written
from annalist.spec import EntitySpec
from annalist.streaming.ingest import run_id
from annalist.streaming.segments import SegmentedVersions

COMMIT = "step int, run string, batch long"


class VersionedHistory:
    """Snapshots and the dimension built from them, one commit per micro-batch.

    A commit is a small record (``step``, run, batch, the step it builds on), written after its data.
    Steps go on from the last commit of the store, whatever the stream's own batch numbers are: a
    stream that starts again with a fresh checkpoint adds to the history. A batch that Spark repeats
    replaces its own step. A lower batch of a run that has gone further is refused. No table is
    overwritten while it is read; steps before the last ``keep`` cannot be read any more.

    The dimension is kept in segments (``SegmentedVersions``): a batch writes its own snapshots, the
    versions of its entities that it opened, closed or extended, and a manifest. Only every ``fan``-th
    batch also merges segments. So the bytes a batch writes follow from the batch and its entities,
    not from the size of the dimension.

    Late and corrected days are resolved by ``batch_versions``, which rebuilds only the entities
    concerned from the stored snapshots; their older versions are superseded as a whole.
    """

    def __init__(self, spark: SparkSession, root: str, spec: EntitySpec, keep: int = 2, fan: int = 8):
        if keep < 2:
            raise ValueError("a repeated batch needs the step before it: keep at least 2")
        self.spark, self.root, self.spec, self.keep = spark, root.rstrip("/"), spec, keep
        self.versions = SegmentedVersions(spark, f"{root.rstrip('/')}/dimension", spec.key, fan)

    def _path(self, kind: str, step: int) -> str:
        return f"{self.root}/{kind}/step={step}"

    def commits(self) -> list[Row]:
        """The commits in order; one small row for each micro-batch."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/commits/step=*/_SUCCESS")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path):
            return []
        # Replayed commits replace their folder, so a step has one row.
        return self.spark.read.schema(COMMIT).parquet(f"{self.root}/commits/*").orderBy("step").collect()

    def dimension(self, step: int | None = None) -> DataFrame:
        """The dimension after a step, by default the last one."""
        if step is None:
            step = self.commits()[-1]["step"]
        return self.versions.versions(step)

    def snapshots(self, step: int) -> DataFrame:
        """Every snapshot row of the steps up to ``step``."""
        stored = self.spark.read.option("basePath", f"{self.root}/snapshots").parquet(f"{self.root}/snapshots")
        return stored.filter(f"step <= {step}").drop("step")

    def _changed(self, fresh: DataFrame, step: int) -> tuple[DataFrame, DataFrame | None]:
        """The versions that a step's snapshots open, close, extend or build anew, and the entities of the last kind."""
        rows = one_row_per_day(fresh, self.spec)
        before = self.versions.manifest(step - 1)
        opened = self.versions.opened(before, rows.select(self.spec.key).distinct())
        if opened is None:
            return build_versions(rows, self.spec, with_last_seen=True), None
        changed, late, count = batch_versions(opened, rows, self.spec, self.snapshots(step))
        return changed, late if count else None

    def apply(self, rows: DataFrame, batch: int, run: str = "") -> int:
        """Take in a batch and return its step."""
        done = self.commits()
        own = [c for c in done if c["run"] == run]
        again = [c for c in own if c["batch"] == batch]
        if not again and own and batch < own[-1]["batch"]:
            raise ValueError(f"batch {batch} of run {run!r} is older than its last commit")
        if again and again[0]["step"] < done[-1]["step"]:
            return again[0]["step"]  # it is part of what was built on it
        step = again[0]["step"] if again else (done[-1]["step"] + 1 if done else 0)
        fresh = keyed_rows(rows, self.spec)
        fresh.write.mode("overwrite").parquet(self._path("snapshots", step))
        fresh = self.spark.read.parquet(self._path("snapshots", step))
        changed, rebuilt = self._changed(fresh, step)
        rows, path = written(changed, "versions")  # read for its open and its closed rows
        self.versions.commit(step, rows, rebuilt)
        record = self.spark.createDataFrame([(step, run, batch)], COMMIT).coalesce(1)
        record.write.mode("overwrite").parquet(self._path("commits", step))
        discard(self.spark, path)
        self.versions.forget(step - self.keep, step)
        return step


def maintain_history(
    stream: DataFrame,
    history: VersionedHistory,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Feed everything that has arrived into ``history`` and stop.

    Previous values cannot be looked up inside a stream, so each micro-batch is applied as a
    batch.  ``prepare`` shapes the raw rows first.
    """

    def apply(df: DataFrame, batch: int) -> None:
        history.apply(prepare(df), batch, run_id(df.sparkSession, checkpoint))

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
