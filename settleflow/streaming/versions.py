"""Tables in versions, one per committed batch, and the files each batch read."""

from __future__ import annotations

import fnmatch
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from settleflow.streaming.files import INTERVAL

#: Name under which the files of a batch are committed with its tables.
FILES = "__files"
# Which files of a class are archived.
ARCHIVED = {"ST": ("*.ST", "*.txt"), "AC": ("*",)}

_COMMIT = "batch_id bigint, name string, path string"


class VersionedTables:
    """A set of tables below one folder, of which every committed batch leaves a complete version.

    A batch writes the tables it changes to a folder of its own and names them, last of all, in one file of ``commits``:
    readers see all of a batch or nothing of it. A batch that is committed already changes nothing when it runs again, and one that
    ended before its commit leaves only folders that nobody reads; :meth:`vacuum` removes them.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(_COMMIT).parquet(f"{self.root}/commits")
        except AnalysisException:  # nothing is committed yet
            return self.spark.createDataFrame([], _COMMIT)

    def committed(self) -> int | None:
        """The last committed batch, -1 for the tables it began with."""
        return self._commits().agg(F.max("batch_id")).first()[0]

    def paths(self, batch_id: int | None = None) -> dict[str, str]:
        """Where the tables of a version are, by default of the last one. One row per table."""
        commits = self._commits().where(F.col("name") != FILES)
        if batch_id is not None:
            commits = commits.where(F.col("batch_id") <= batch_id)
        last = commits.groupBy("name").agg(F.max_by("path", "batch_id").alias("path"))
        return {row["name"]: row["path"] for row in last.collect()}

    def read(self, batch_id: int | None = None) -> dict[str, DataFrame]:
        return {name: self.spark.read.parquet(path) for name, path in self.paths(batch_id).items()}

    def create(self, tables: Mapping[str, DataFrame]) -> None:
        """The tables before the first batch; they stay as they are if there is a version already."""
        if self.committed() is None:
            self.commit(-1, tables)

    def commit(self, batch_id: int, changed: Mapping[str, DataFrame]) -> bool:
        """Write the changed tables and move to them; False if the batch is committed already."""
        last = self.committed()
        if last is not None and batch_id <= last:
            return False
        folder = f"{self.root}/versions/batch-{batch_id}-{uuid.uuid4().hex}"
        rows = []
        for name, table in changed.items():
            table.write.parquet(f"{folder}/{name}")
            rows.append((batch_id, name, f"{folder}/{name}"))
        # A batch that changes no table is committed too: its files count as read.
        rows = rows or [(batch_id, FILES, "")]
        self.spark.createDataFrame(rows, _COMMIT).coalesce(1).write.mode("append").parquet(f"{self.root}/commits")
        return True

    def files(self) -> DataFrame:
        """``batch_id, path, rows`` of every file that a committed batch read."""
        kind = "batch_id bigint, path string, rows bigint"
        found = [row["path"] for row in self._commits().where((F.col("name") == FILES) & (F.col("path") != "")).collect()]
        return self.spark.read.schema(kind).parquet(*found) if found else self.spark.createDataFrame([], kind)

    def vacuum(self, keep: int = 1) -> int:
        """Remove folders of batches that were never committed, and tables none of the last ``keep`` versions reads.

        Returns the number of folders removed. Run it when no batch is running.
        """
        last = self.committed()
        named = {row["path"] for row in self._commits().where(F.col("name") == FILES).collect()}
        for batch_id in range(max(-1, (last or 0) - keep + 1), (last if last is not None else -2) + 1):
            named |= set(self.paths(batch_id).values())
        fs, path = _file_system(self.spark, self.root)
        removed = 0
        versions = path(f"{self.root}/versions")
        for batch in fs.listStatus(versions) if fs.exists(versions) else ():
            for table in fs.listStatus(batch.getPath()):
                if table.getPath().toUri().getPath() not in {path(p).toUri().getPath() for p in named}:
                    removed += bool(fs.delete(table.getPath(), True))
            if not fs.listStatus(batch.getPath()):
                fs.delete(batch.getPath(), False)
        return removed


def _file_system(spark: SparkSession, root: str):
    """The store a path lies in, and what makes a path of a text."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark._jsc.hadoopConfiguration()), path


Step = Callable[[DataFrame, dict[str, DataFrame]], Mapping[str, DataFrame]]


def stream_pipeline(
    stream: DataFrame,
    tables: VersionedTables,
    step: Step,
    checkpoint: str,
    interval: str | None = INTERVAL,
    file: str | None = None,
) -> StreamingQuery:
    """Run ``step`` on every batch and the tables as the batch before left them; what it returns are the new versions.

    A batch that runs again after its commit changes nothing, and one that failed before it starts from the same
    tables. ``file`` names a column with the path a row was read from: the files of a batch are committed with its tables.
    ``interval=None`` runs what is there and stops.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        last = tables.committed()
        if last is not None and batch_id <= last:
            return
        rows = batch.persist()
        try:
            changed = dict(step(rows.drop(file) if file else rows, tables.read()))
            if file:
                read = rows.groupBy(F.col(file).alias("path")).agg(F.count(F.lit(1)).alias("rows"))
                changed[FILES] = read.select(F.lit(batch_id).cast("bigint").alias("batch_id"), "path", "rows")
            tables.commit(batch_id, changed)
        finally:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    return writer.start()


def archive_committed(
    tables: VersionedTables, archive: Mapping[str, str], patterns: Mapping[str, Sequence[str]] = ARCHIVED, since: int = -1
) -> list[tuple[int, str, str]]:
    """Move the files of committed batches to the archive of their class: ``(batch, from, to)`` of every file moved.

    ``archive`` gives the folder of each class; a file is of the class whose name is that of the folder it lies in. The
    sequence prefix (``12.``) is stripped before a name is compared with the patterns of its class and in the archive. Files of
    no pattern stay where they are. A file that is gone was moved before; a name the archive has already is
    kept apart by the batch number. Files are moved one by one, as many as batches after ``since`` read: the cap of a run
    bounds them.
    """
    spark = tables.spark
    decoded = F.col("path")
    name = F.regexp_replace(F.element_at(F.split(decoded, "/"), -1), r"^\d+\.", "")
    moved = []
    for row in tables.files().where(F.col("batch_id") > since).select("batch_id", "path", name.alias("name")).orderBy("batch_id", "path").toLocalIterator():
        folders = row["path"].split("/")[:-1]
        kind = next((k for k in archive if k in folders), None)
        if kind is None or not any(fnmatch.fnmatchcase(row["name"], p) for p in patterns.get(kind, ())):
            continue
        fs, path = _file_system(spark, row["path"])
        source, target = path(row["path"]), path(f"{archive[kind].rstrip('/')}/{row['name']}")
        if not fs.exists(source):
            continue
        fs.mkdirs(target.getParent())
        if fs.exists(target):
            target = path(f"{target.toString()}.{row['batch_id']}")
        if not fs.rename(source, target):
            raise OSError(f"cannot move {row['path']} to {target.toString()}")
        moved.append((row["batch_id"], row["path"], target.toString()))
    return moved
