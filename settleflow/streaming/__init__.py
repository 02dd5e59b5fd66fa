"""Streams of files, batch loads that can run again, versions of tables per batch, repeats across batches."""

from settleflow.streaming.admission import FileAdmission, stream_admitted
from settleflow.streaming.files import stream_files, stream_lines, stream_load, uniq_rows_stream
from settleflow.streaming.repeats import first_rows_stream
from settleflow.streaming.versions import VersionedTables, archive_committed, stream_pipeline

__all__ = [
    "FileAdmission",
    "VersionedTables",
    "archive_committed",
    "first_rows_stream",
    "stream_admitted",
    "stream_files",
    "stream_lines",
    "stream_load",
    "stream_pipeline",
    "uniq_rows_stream",
]
