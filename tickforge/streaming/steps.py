"""A table that grows by whole steps, each of which becomes visible at once.

A streaming query that writes with ``foreachBatch`` may run a batch twice: after a failure
the same batch comes again. Here a batch is written to a folder of its own, ``step=<n>``,
and then a marker appears that names the batch and all steps that make up the table. Readers
look at the newest marker only; a batch that is marked is not run again, one that is not is
replaced.

Steps of a few files each would pile up for ever. ``gather`` writes many steps again as one,
and the marker that names it instead of them is the switch: a reader sees either. Steps are
gathered by size, so a row is written again once for every power of ``least`` triggers.
"""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MARKER = re.compile(r"(\d+)-batch(-?\d+)$")


class Steps:
    """The steps below ``root``, as parquet or JSON lines. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str, kind: str = "parquet"):
        self.spark, self.root, self.kind = spark, root, kind
        self._paths = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._paths(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        folder = self._paths(path)
        if not self._files.exists(folder):
            return []
        return [status.getPath().getName() for status in self._files.listStatus(folder)]

    def _markers(self):
        found = map(_MARKER.match, self._names(f"{self.root}/_markers"))
        return sorted((int(m[1]), int(m[2]), m[0]) for m in found if m)

    @property
    def last(self) -> tuple[int, int]:
        """Number of the newest step and of the last batch in the table; -1 if there is none."""
        return (self._markers() or [(-1, -1, "")])[-1][:2]

    @property
    def visible(self) -> dict[int, int]:
        """The steps that make up the table, and how many triggers each holds."""
        markers = self._markers()
        if not markers:
            return {}
        stream = self._files.open(self._paths(f"{self.root}/_markers/{markers[-1][2]}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {int(step): int(n) for step, n in (x.split(":") for x in text.split(",") if x)}

    def path(self, step: int) -> str:
        return f"{self.root}/step={step}"

    def commit(self, step: int, batch_id: int, instead_of=(), triggers: int = 1) -> None:
        """Make a step visible, in place of others if so. Of the markers the newest is kept."""
        before, visible = self._markers(), self.visible
        table = {s: n for s, n in visible.items() if s not in instead_of} | {step: triggers}
        name = f"{step:012d}-batch{batch_id}"
        hidden = self._paths(f"{self.root}/_markers/_{name}")
        stream = self._files.create(hidden, True)
        stream.writeBytes(",".join(f"{s}:{n}" for s, n in table.items()))
        stream.close()
        marker = self._paths(f"{self.root}/_markers/{name}")
        self._files.delete(marker, False)
        self._files.rename(hidden, marker)
        for _, _, old in before:
            if old != name:
                self._files.delete(self._paths(f"{self.root}/_markers/{old}"), False)

    def delete(self, path: str) -> None:
        self._files.delete(self._paths(path), True)

    def read(self, schema, steps=None) -> DataFrame:
        """All visible steps, or some, with the column ``step``; no other folder is listed."""
        steps = sorted(self.visible if steps is None else steps)
        paths = [self.path(step) for step in steps]
        if not paths:
            return self.spark.createDataFrame([], schema).withColumn("step", F.lit(0))
        reader = self.spark.read.schema(schema).option("basePath", self.root)
        return reader.format(self.kind).load(paths)

    def gather(self, schema, folders, least: int) -> None:
        """Write ``least`` or more steps of one size class as one step, where there are so many.

        What an earlier gathering replaced is deleted now, so a reader has as long as that.
        """
        visible = self.visible
        classes: dict[int, list[int]] = {}
        for step, triggers in visible.items():
            size = 0
            while triggers >= least ** (size + 1):
                size += 1
            classes.setdefault(size, []).append(step)
        some = next((steps for steps in classes.values() if len(steps) >= least), None)
        if some is None:
            return
        newest, batch_id = self.last
        there = [n for n in self._names(self.root) if n.startswith("step=")]
        left = [n for n in there if int(n.removeprefix("step=")) not in {*visible, newest + 1}]
        rows = self.read(schema, some).drop("step").hint("rebalance", *folders)
        writer = rows.write.mode("overwrite").partitionBy(*folders).format(self.kind)
        writer.save(self.path(newest + 1))
        self.commit(newest + 1, batch_id, some, sum(visible[step] for step in some))
        for name in left:
            self.delete(f"{self.root}/{name}")
