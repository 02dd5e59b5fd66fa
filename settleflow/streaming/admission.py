"""A streaming source that admits a few files of each class and group per batch."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from settleflow.functions.text import NETWORK_ID
from settleflow.plans.groups import ACTIVITY_MARK, FILES_PER_RUN, SETTLEMENT_ENDINGS
from settleflow.sources.tables import read_mapping

#: Lines of a file passed on at once.
LINES = 10_000
_SCHEMA = "path string, class string, grp string, position int, line string"


class _Files(InputPartition):
    """One file of a batch."""

    def __init__(self, path: str, kind: str, grp: str, position: int):
        self.path, self.kind, self.grp, self.position = path, kind, grp, position


def class_of(path: str, folders: dict[str, str]) -> str | None:
    """``ST`` or ``AC`` by folder and name, as :func:`settleflow.plans.groups.file_class` tells it."""
    folder, _, name = path.rpartition("/")
    folder = f"/{folder.strip('/')}/"
    if folder.endswith(f"/{folders['ST'].strip('/')}/") and name.endswith(SETTLEMENT_ENDINGS):
        return "ST"
    if folder.endswith(f"/{folders['AC'].strip('/')}/") and ACTIVITY_MARK in name.upper():
        return "AC"
    return None


class _Reader(DataSourceStreamReader):
    """Admits the next files of each class and group by name.

    An offset has the number of its batch and the files of that batch alone (the cap bounds them), so Spark's own offset log
    says which files a batch that runs again has. A batch writes its offset to the ledger when it is planned; a file in the ledger
    is never admitted again.
    """

    def __init__(self, options: dict[str, str]):
        self.options = {name.lower(): value for name, value in options.items()}
        self.cap = int(self.options.get("cap", FILES_PER_RUN))
        self.folders = {"ST": self.options.get("st_dir", "ST"), "AC": self.options.get("ac_dir", "AC")}
        self.mapping = json.loads(self.options["mapping"])

    def _store(self, name: str) -> tuple[fs.FileSystem, str]:
        uri = self.options[name]
        return fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "", 1))

    def _planned(self) -> list[dict]:
        """The offsets in the ledger, in their order."""
        store, folder = self._store("ledger")
        names = [f.path for f in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if f.path.endswith(".json")]
        found = []
        for name in names:
            with store.open_input_stream(name) as stream:
                found.append(json.loads(stream.read()))
        return sorted(found, key=lambda offset: offset["batch"])

    def initialOffset(self) -> dict:
        return {"batch": 0, "files": []}

    def latestOffset(self) -> dict:
        planned = self._planned()
        last = planned[-1] if planned else self.initialOffset()
        taken = {file[0] for offset in planned for file in offset["files"]}
        store, folder = self._store("path")
        waiting: dict[tuple[str, str], list[str]] = {}
        for info in store.get_file_info(fs.FileSelector(folder, recursive=True)):
            hidden = info.base_name.startswith((".", "_"))  # as for Spark's own readers
            kind = class_of(info.path, self.folders) if info.is_file and not hidden and info.path not in taken else None
            number = re.search(NETWORK_ID, info.base_name)
            grp = self.mapping.get(number.group(1)) if number else None
            if kind and grp:
                waiting.setdefault((kind, grp), []).append(info.path)
        files = [
            [path, kind, grp, position]
            for (kind, grp), paths in sorted(waiting.items())
            for position, path in enumerate(sorted(paths, key=lambda p: (p.rpartition("/")[2], p))[: self.cap], start=1)
        ]
        return {"batch": last["batch"] + 1, "files": files} if files else last

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        store, folder = self._store("ledger")
        store.create_dir(folder, recursive=True)
        name = f"{folder}/{end['batch']:012d}"
        with store.open_output_stream(f"{name}.part") as stream:
            stream.write(json.dumps(end).encode())
        store.move(f"{name}.part", f"{name}.json")
        return [_Files(*file) for file in end["files"]]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        store, _ = self._store("path")
        names = ["path", "class", "grp", "position", "line"]
        with store.open_input_stream(partition.path) as stream:
            for lines in _lines(stream):
                same = [pa.array([value] * len(lines), kind) for value, kind in (
                    (partition.path, pa.string()), (partition.kind, pa.string()), (partition.grp, pa.string()), (partition.position, pa.int32())
                )]
                yield pa.RecordBatch.from_arrays([*same, pa.array(lines, pa.string())], names)


def _lines(stream) -> Iterator[list[str]]:
    """Lines of a file a few at a time; a line ends with a line feed, with or without a carriage return before."""
    rest, found = b"", []
    while block := stream.read(1 << 20):
        *whole, rest = (rest + block).split(b"\n")
        found += [line.removesuffix(b"\r").decode("utf-8", "replace") for line in whole]
        if len(found) >= LINES:
            yield found
            found = []
    if rest:
        found.append(rest.removesuffix(b"\r").decode("utf-8", "replace"))
    if found:
        yield found


class FileAdmission(DataSource):
    """Lines of new files, at most ``cap`` files of each class and group a batch.

    Options: ``path``, ``ledger`` (a shared folder of the stream's own), ``mapping`` (JSON, network id to group), ``cap``,
    ``st_dir``, ``ac_dir``.
    """

    @classmethod
    def name(cls) -> str:
        return "settleflow_files"

    def schema(self) -> str:
        return _SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(dict(self.options))


def stream_admitted(
    spark: SparkSession, folder: str, mapping: DataFrame, ledger: str, cap: int = FILES_PER_RUN, st_dir: str = "ST", ac_dir: str = "AC"
) -> DataFrame:
    """``path, class, grp, position, line`` of new files below ``folder``, at most ``cap`` of each class and group per batch.

    Class, group and order are those of :func:`settleflow.plans.groups.route_files`: files of no class and of unknown networks are
    left out, the others wait, by name, until they are admitted. Each is admitted once; a batch that runs again has
    the files it had, and a stream that starts again goes on with the files after them. The folder is listed on the driver, files are
    read in executors, one task each. ``mapping`` (``network_id``, ``grp_number``) is a table of settings, a row per
    network; an id with several groups ends the job. Empty files are admitted and have no lines.
    """
    known = read_mapping(spark, mapping, "network_id", "grp_number")
    groups = {str(row["network_id"]): str(row["grp_number"]) for row in known.select("network_id", "grp_number").collect()}
    spark.dataSource.register(FileAdmission)
    reader = spark.readStream.format(FileAdmission.name()).option("path", folder).option("ledger", ledger)
    reader = reader.option("mapping", json.dumps(groups)).option("cap", cap).option("st_dir", st_dir).option("ac_dir", ac_dir)
    return reader.load()
