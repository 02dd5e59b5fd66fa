"""File streams: ingest a few files per batch, load each batch, drop repeats across batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from settleflow.plans.groups import FILES_PER_RUN

# Fixed value: how often folders are looked at.
INTERVAL = "30 minutes"


def _archived(reader, archive_dir: str | None):
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader


def stream_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    max_files: int = FILES_PER_RUN,
    sep: str = ",",
    header: bool = False,
    mask: str | None = None,
    archive_dir: str | None = None,
    corrupt: str | None = None,
) -> DataFrame:
    """Rows of new delimited files, at most ``max_files`` files per batch.

    Files of a finished batch move to ``archive_dir`` when it is set. ``corrupt`` names a declared
    string column that takes the text of bad rows.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    reader = reader.option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    if mask:
        reader = reader.option("pathGlobFilter", mask)
    return _archived(reader, archive_dir).csv(folder)


def stream_lines(
    spark: SparkSession,
    folder: str,
    max_files: int = FILES_PER_RUN,
    mask: str | None = None,
    archive_dir: str | None = None,
    file: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Lines of new files in column ``line``, and the path of their file in ``file`` if it is named."""
    reader = spark.readStream.option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", recursive)
    if mask:
        reader = reader.option("pathGlobFilter", mask)
    lines = _archived(reader, archive_dir).text(folder)
    return lines.select(F.col("value").alias("line"), *([F.col("_metadata.file_path").alias(file)] if file else []))


def stream_load(
    stream: DataFrame,
    sink_dir: str,
    checkpoint: str,
    step: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
    interval: str | None = INTERVAL,
) -> StreamingQuery:
    """Load every batch into ``sink_dir/good`` and ``sink_dir/rejects``.

    ``step`` turns the rows of a batch into ``(good, rejects)``. A batch writes its own
    ``batch_id=`` folder and overwrites it, so a batch that runs again leaves the same rows.
    ``interval=None`` loads what is there and stops.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        if step is None:
            batch.write.mode("overwrite").parquet(f"{sink_dir}/good/batch_id={batch_id}")
            return
        rows = batch.persist()
        try:
            good, rejects = step(rows)
            good.write.mode("overwrite").parquet(f"{sink_dir}/good/batch_id={batch_id}")
            rejects.write.mode("overwrite").parquet(f"{sink_dir}/rejects/batch_id={batch_id}")
        finally:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    return writer.start()


def uniq_rows_stream(df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """The first row per key to arrive, repeats dropped while the watermark keeps the key.

    State grows with the keys of one ``delay``, not with the stream.
    """
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
