"""Version rows in immutable segments, listed by a small manifest for each step.

A step appends what it changed and nothing else: closed versions, open versions, and the entities
whose history was built anew. Three rules put the dimension together:

* closed versions are final, unless their entity was rebuilt in a later step;
* of the open versions of an entity the one of the latest step holds;
* everything in segments that the manifest does not list does not exist.

When ``fan`` segments of one level have gathered, they are merged into one of the next level, so a row
is written again about once for each level, and a table of n steps has log(n) levels. Merging drops
superseded rows.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StructField, StructType

STEP = "_step"
MANIFEST = "kind string, name string, level int"


@dataclass(frozen=True)
class Segment:
    """One folder of rows: ``kind`` is closed, open or rebuilt."""

    kind: str
    name: str
    level: int = 0


class SegmentedVersions:
    """The versions of many entities, written step by step under ``root``."""

    def __init__(self, spark: SparkSession, root: str, key: str, fan: int = 8) -> None:
        if fan < 2:
            raise ValueError("merging needs at least two segments")
        self.spark, self.root, self.key, self.fan = spark, root.rstrip("/"), key, fan

    def manifest(self, step: int) -> list[Segment]:
        """The segments of a step, oldest first; none before the first step."""
        if step < 0:
            return []
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/step={step}").collect()
        return sorted((Segment(*r) for r in rows), key=lambda s: int(s.name.split("-")[0]))

    def _rows(self, segments: list[Segment], schema: StructType) -> DataFrame | None:
        paths = [f"{self.root}/segments/{s.kind}/{s.name}" for s in segments]
        return self.spark.read.schema(schema).parquet(*paths) if paths else None

    def _rebuilt(self, segments: list[Segment]) -> DataFrame | None:
        """(key, _rebuilt): the last step that built an entity's history anew."""
        listed = [s for s in segments if s.kind == "rebuilt"]
        if not listed:
            return None
        kind = self._schema([s for s in segments if s.kind == "open"])[self.key].dataType
        rows = self._rows(listed, _listed(self.key, kind))
        return rows.groupBy(self.key).agg(F.max(STEP).alias("_rebuilt"))

    def _schema(self, segments: list[Segment]) -> StructType:
        """As written; a step has an open segment at least, since every entity has an open version."""
        return self.spark.read.parquet(f"{self.root}/segments/{segments[0].kind}/{segments[0].name}").schema

    def closed(self, segments: list[Segment]) -> DataFrame | None:
        """Closed versions. Without rebuilt entities this is a plain scan."""
        listed = [s for s in segments if s.kind == "closed"]
        if not listed:
            return None
        rows = self._rows(listed, self._schema([s for s in segments if s.kind == "open"]))
        rebuilt = self._rebuilt(segments)
        if rebuilt is None:
            return rows
        held = rows.join(rebuilt, self.key, "left").where(F.col("_rebuilt").isNull() | (F.col(STEP) >= F.col("_rebuilt")))
        return held.select(*rows.columns)

    def opened(self, segments: list[Segment], entities: DataFrame | None = None) -> DataFrame | None:
        """The open version of every entity, or of ``entities`` only."""
        listed = [s for s in segments if s.kind == "open"]
        if not listed:
            return None
        rows = self._rows(listed, self._schema(listed))
        if entities is not None:
            rows = rows.join(entities, self.key, "left_semi")
        if len(listed) == 1 and listed[0].level:
            return rows  # merged: one row for each entity
        latest = rows.groupBy(self.key).agg(F.max_by(F.struct(*rows.columns), STEP).alias("_row"))
        return latest.select("_row.*")

    def versions(self, step: int) -> DataFrame:
        """The whole dimension after a step."""
        segments = self.manifest(step)
        closed, opened = self.closed(segments), self.opened(segments)
        return (opened if closed is None else closed.unionByName(opened)).drop(STEP)

    def commit(self, step: int, changed: DataFrame, rebuilt: DataFrame | None) -> None:
        """Write ``changed`` (versions of the step's entities) and ``rebuilt`` (entities whose older
        versions do not hold any more), merge where enough has gathered, and list all of it.

        What an earlier try of the step has written is replaced. Nothing that an earlier step lists
        is touched.
        """
        segments = self.manifest(step - 1)
        changed = changed.withColumn(STEP, F.lit(step).cast("long"))
        opened = changed.where("is_current")
        closed = changed.where(~F.col("is_current"))
        parts = {"closed": closed, "open": opened}
        if rebuilt is not None:
            parts["rebuilt"] = rebuilt.select(self.key, F.lit(step).cast("long").alias(STEP))
        for kind, rows in parts.items():
            segment = Segment(kind, f"{step}-0")
            rows.write.mode("overwrite").parquet(f"{self.root}/segments/{kind}/{segment.name}")
            segments.append(segment)
        segments = self._merged(segments, step)
        listed = self.spark.createDataFrame([(s.kind, s.name, s.level) for s in segments], MANIFEST)
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/step={step}")

    def _merged(self, segments: list[Segment], step: int) -> list[Segment]:
        """``segments`` with full levels merged; entities rebuilt are taken into account before levels of closed rows are."""
        for kind in ("open", "closed", "rebuilt"):
            level = 0
            while len(full := [s for s in segments if s.kind == kind and s.level == level]) >= self.fan:
                level += 1
                target = Segment(kind, f"{step}-{level}", level)
                other = [s for s in segments if s.kind not in (kind, "closed")]
                if kind == "open":
                    rows = self.opened([replace(s, level=0) for s in full])
                elif kind == "closed":
                    rows = self.closed(other + full)
                else:
                    rows = self._rebuilt(other + full).withColumnRenamed("_rebuilt", STEP)
                rows.write.mode("overwrite").parquet(f"{self.root}/segments/{kind}/{target.name}")
                segments = [s for s in segments if s not in full] + [target]
        return segments

    def forget(self, step: int, last: int) -> None:
        """Remove steps up to ``step`` and the segments that no step from there to ``last`` lists."""
        if step < 0:
            return
        needed = {(s.kind, s.name) for k in range(step + 1, last + 1) for s in self.manifest(k)}
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(f"{self.root}/segments")
        fs = where.getFileSystem(conf)
        for match in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.root}/segments/*/*")):
            path = match.getPath()
            if (path.getParent().getName(), path.getName()) not in needed:
                fs.delete(path, True)
        for match in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest/step=*")):
            if int(match.getPath().getName().removeprefix("step=")) <= step:
                fs.delete(match.getPath(), True)


def _listed(key: str, kind: DataType) -> StructType:
    return StructType([StructField(key, kind), StructField(STEP, LongType())])
