"""Files under names of their own, written by tasks and published by a manifest.

``corpusloom_files`` is a data source that writes rows (name, line): the rows of a name, which must lie in one partition one after another, are the
lines of the file ``name``. A task writes its files under their names into a folder that no other attempt uses, and tells in a part of the manifest what it
wrote. A task that fails removes its folder; a lost one leaves a folder that no manifest names. The commit names the folders that count; ``CURRENT`` names the
commit that is published, so readers see all files of a write or none, and nothing is renamed or listed by name on the driver.

``publish`` takes gates, too: aggregates that are observed while the rows are written. The commit is published only if all of them hold, and removed otherwise.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

MANIFEST = "name string, path string, lines long, bytes long, sha256 string"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system that path is on, and path there; a path without a scheme is one of this machine."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)


def _safe(name: str | None) -> str:
    """A file name that stays in its folder and that readers see."""
    if not name or "/" in name or "\\" in name or "\0" in name or name[0] in "._":
        raise ValueError(f"no name for a file: {name!r}")
    return name


@dataclass
class _Written(WriterCommitMessage):
    folder: str
    files: int


class _Writer(DataSourceWriter):
    def __init__(self, options: dict):
        self.path, self.job = options["path"].rstrip("/"), options.get("job") or uuid.uuid4().hex

    def write(self, iterator: Iterator[Row]) -> _Written:
        system, root = file_system(self.path)
        task = TaskContext.get()
        folder = f"{self.job}/{task.partitionId():06d}-{task.taskAttemptId()}" if task else f"{self.job}/{uuid.uuid4().hex}"
        place = f"{root}/_files/{folder}"
        told, out, seen, now = [], None, set(), None
        try:
            for row in iterator:
                if out is None or row[0] != now:
                    if out is not None:
                        out.close()
                    now = _safe(row[0])
                    if now in seen:
                        raise ValueError(f"the lines of {now} aren't one after another")
                    seen.add(now)
                    system.create_dir(place, recursive=True)
                    out = system.open_output_stream(f"{place}/{now}")
                    told.append({"name": now, "path": f"{self.path}/_files/{folder}/{now}", "lines": 0, "bytes": 0, "sha256": hashlib.sha256()})
                line = f"{row[1] or ''}\n".encode("utf-8", "surrogatepass")
                out.write(line)
                told[-1]["lines"] += 1
                told[-1]["bytes"] += len(line)
                told[-1]["sha256"].update(line)
            if out is not None:
                out.close()
                out = None
                system.create_dir(f"{root}/_commits/{self.job}", recursive=True)
                with system.open_output_stream(f"{root}/_commits/{self.job}/{folder.rsplit('/', 1)[-1]}.jsonl") as part:
                    for t in told:
                        part.write(json.dumps(t | {"sha256": t["sha256"].hexdigest()}, ensure_ascii=False).encode() + b"\n")
        except BaseException:
            if out is not None:
                out.close()
            _removed(system, place)
            raise
        return _Written(folder, len(told))

    def commit(self, messages: list[_Written | None]) -> None:
        """Name the folders of the tasks that count; one name a task, whatever it wrote."""
        system, root = file_system(self.path)
        system.create_dir(f"{root}/_commits/{self.job}", recursive=True)
        folders = [m.folder for m in messages if m is not None and m.files]
        with system.open_output_stream(f"{root}/_commits/{self.job}/folders.json") as out:
            out.write(json.dumps({"folders": folders, "files": sum(m.files for m in messages if m is not None)}).encode())

    def abort(self, messages: list[_Written | None]) -> None:
        system, root = file_system(self.path)
        for part in ("_files", "_commits"):
            _removed(system, f"{root}/{part}/{self.job}")


def _removed(system: fs.FileSystem, place: str) -> None:
    if system.get_file_info(place).type == fs.FileType.Directory:
        system.delete_dir(place)


class NamedFiles(DataSource):
    """Files by name. Options: path; job, the name of the commit."""

    @classmethod
    def name(cls) -> str:
        return "corpusloom_files"

    def schema(self) -> str:
        return "name string, line string"

    def writer(self, schema: object, overwrite: bool) -> DataSourceWriter:
        return _Writer(dict(self.options))


class GateError(ValueError):
    """Gates that don't hold, with what was observed."""

    def __init__(self, failed: list[str], observed: dict):
        super().__init__(f"nothing is published, as these gates don't hold: {', '.join(failed)}")
        self.failed, self.observed = failed, observed


def publish(rows: DataFrame, path: str, name: str, line: str, order: list[Column], gates: dict[str, Column] | None = None) -> dict:
    """Write the lines of rows by their file's name, in order, and publish them if all gates (name -> boolean aggregate of rows) hold.

    Gates are observed in the pass that writes. Gives what was observed; a gate that is false or null is an error and leaves nothing behind. One file is one task's,
    as its lines are one stream, but no more than a batch of them is held."""
    spark = rows.sparkSession
    spark.dataSource.register(NamedFiles)
    job = uuid.uuid4().hex
    watched = Observation() if gates else None
    if watched is not None:
        rows = rows.observe(watched, *[c.alias(k) for k, c in gates.items()])
    keys = [c.alias(f"_order{i}") for i, c in enumerate(order)]
    lines = rows.select(F.col(name).cast("string").alias("name"), F.col(line).cast("string").alias("line"), *keys)
    sorted_ = lines.repartition("name").sortWithinPartitions("name", *[f"_order{i}" for i in range(len(keys))]).select("name", "line")
    sorted_.write.format("corpusloom_files").option("path", path).option("job", job).mode("append").save()
    observed = dict(watched.get) if watched is not None else {}
    system, root = file_system(path.rstrip("/"))
    if failed := [k for k in gates or {} if observed.get(k) is not True]:
        for part in ("_files", "_commits"):
            _removed(system, f"{root}/{part}/{job}")
        raise GateError(failed, observed)
    # a name that is moved over another one is there or isn't
    with system.open_output_stream(f"{root}/_commits/{job}/next") as out:
        out.write(job.encode())
    system.move(f"{root}/_commits/{job}/next", f"{root}/_commits/CURRENT")
    return observed


def current(path: str) -> tuple[str | None, list[str]]:
    """The published commit and the folders that it names; none if nothing is published."""
    system, root = file_system(path.rstrip("/"))
    if system.get_file_info(f"{root}/_commits/CURRENT").type != fs.FileType.File:
        return None, []
    with system.open_input_stream(f"{root}/_commits/CURRENT") as f:
        job = f.read().decode()
    with system.open_input_stream(f"{root}/_commits/{job}/folders.json") as f:
        return job, json.loads(f.read())["folders"]


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(name, path, lines, bytes, sha256) of the published files. A name that two tasks wrote is an error."""
    _, folders = current(path)
    if not folders:
        return spark.createDataFrame([], MANIFEST)
    rows = spark.read.schema(MANIFEST).json([f"{path.rstrip('/')}/_commits/{f}.jsonl" for f in folders])
    again = F.raise_error(F.concat(F.lit("written twice: "), F.col("name")))
    return rows.groupBy("name").agg(F.count("*").alias("n"), *[F.min(c).alias(c) for c in ("path", "lines", "bytes", "sha256")]).select(
        F.when(F.col("n") > 1, again.cast("string")).otherwise(F.col("name")).alias("name"), "path", "lines", "bytes", "sha256"
    )


def folders_of(path: str) -> list[str]:
    """The folders of the files that are published at path, or in folders right below it, for readers of files by their names; else path itself."""

    def at(place: str) -> list[str]:
        return [f"{place}/_files/{f}" for f in current(place)[1]]

    path = path.rstrip("/")
    if "*" in path:
        return [path]
    if found := at(path):
        return found
    system, root = file_system(path)
    below = [e.base_name for e in system.get_file_info(fs.FileSelector(root, allow_not_found=True)) if e.type == fs.FileType.Directory and e.base_name[0] not in "._"]
    return [f for name in sorted(below) for f in at(f"{path}/{name}")] or [path]


def sweep(path: str) -> int:
    """Remove all that the published commit doesn't name, once nobody reads an earlier one. How many folders that were."""
    system, root = file_system(path.rstrip("/"))
    job, folders = current(path)
    gone = 0
    for entry in system.get_file_info(fs.FileSelector(f"{root}/_commits", allow_not_found=True)):
        if entry.type == fs.FileType.Directory and entry.base_name != job:
            system.delete_dir(entry.path)
    for entry in system.get_file_info(fs.FileSelector(f"{root}/_files", allow_not_found=True)):
        if entry.base_name != job:
            system.delete_dir(entry.path)
            gone += 1
            continue
        for part in system.get_file_info(fs.FileSelector(entry.path)):
            if f"{job}/{part.base_name}" not in folders:
                system.delete_dir(part.path)
                gone += 1
    return gone
