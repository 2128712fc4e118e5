"""Stage checkpoints, manifests, run logs and atomic files."""

from __future__ import annotations

import contextlib
import datetime
import json
import os
import re
import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Files of a log beyond which reading it compacts it.
PARTS = 256


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share; where none is set, one of our own on a single machine, and an error on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="sieveworks-"))
    return context._jsc.sc().getCheckpointDir().get()


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Writes df to the shared folder and reads it back, which also cuts its lineage."""
    path = f"{shared_root(df.sparkSession).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, filesystem = _path(spark, path)
    return filesystem.exists(hadoop)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """K1: a small file by a temporary one and a rename over the old one, on any file system of Spark's; whatever fails, the old content or the new is there whole."""
    target, filesystem = _path(spark, path)
    part, _ = _path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    if filesystem.getScheme() == "file":
        own, at = part.toUri().getPath(), target.toUri().getPath()
        folder, _, name = at.rpartition("/")
        os.makedirs(folder, exist_ok=True)
        try:
            with open(own, "wb") as f:
                f.write(text.encode())
                f.flush()
                os.fsync(f.fileno())
            with contextlib.suppress(FileNotFoundError):
                os.remove(f"{folder}/.{name}.crc")  # Spark's checksum of another content
            os.replace(own, at)
        except BaseException:
            with contextlib.suppress(FileNotFoundError):
                os.remove(own)
            raise
        return
    out = filesystem.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    except Exception:
        out.close()
        filesystem.delete(part, False)
        raise
    out.close()
    _renamed_over(spark, part, target, filesystem)


def _renamed_over(spark: SparkSession, part, target, filesystem) -> None:
    """Gives a whole file its name, in place of an old one."""
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(kind, 1)
    over[0] = kind.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(filesystem.makeQualified(part), filesystem.makeQualified(target), over)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, None if it is missing."""
    hadoop, filesystem = _path(spark, path)
    if not filesystem.exists(hadoop):
        return None
    stream = filesystem.open(hadoop)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def listed(spark: SparkSession, path: str) -> list[str]:
    """The files below a folder, at any depth; none if it is missing."""
    hadoop, filesystem = _path(spark, path)
    if not filesystem.exists(hadoop):
        return []
    found, out = filesystem.listFiles(hadoop, True), []
    while found.hasNext():
        out.append(found.next().getPath().toString())
    return sorted(out)


def put_together(spark: SparkSession, path: str, head: str, lines: DataFrame, tail: str) -> None:
    """One text file of head, the lines in their order and tail, under its name when it is whole.  Parts are written by tasks and copied by the JVM a buffer at a time."""
    parts = f"{path}.{uuid.uuid4().hex}.parts"
    lines.write.text(parts)
    whole = f"{path}.{uuid.uuid4().hex}.tmp"
    (target, filesystem), (final, _) = _path(spark, whole), _path(spark, path)
    out = filesystem.create(target, True)
    try:
        out.write(bytearray(head.encode()))
        for part in (f for f in listed(spark, parts) if f.rpartition("/")[2].startswith("part-")):
            stream = filesystem.open(_path(spark, part)[0])
            try:
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
            finally:
                stream.close()
        out.write(bytearray(tail.encode()))
    finally:
        out.close()
    _renamed_over(spark, target, final, filesystem)
    removed(spark, parts)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder that nothing reads any more."""
    hadoop, filesystem = _path(spark, path)
    filesystem.delete(hadoop, True)


def moved_in(spark: SparkSession, old: str, new: str) -> None:
    """Gives a folder that is whole its name, which must be new."""
    (source, filesystem), (target, _) = _path(spark, old), _path(spark, new)
    filesystem.mkdirs(target.getParent())
    if not filesystem.rename(source, target):
        raise OSError(f"{old} can't be renamed to {new}")


class Checkpoints:
    """Tables of a run by date, stage and key; each is a new folder, and a pointer file says which one counts (K2).

    A write that fails leaves the pointer, and so the old table, as it was.  The
    key holds what the stage depends on, so a run with other lanes or other
    input finds nothing to reuse.
    """

    def __init__(self, spark: SparkSession, root: str, run_date: str):
        self.spark, self.at = spark, f"{root.rstrip('/')}/runs/{run_date}"

    def _pointer(self, stage: str, key: str) -> str:
        return f"{self.at}/{stage}/{key}.json"

    def write(self, stage: str, df: DataFrame, key: str = "all", check: Callable[[DataFrame], None] | None = None) -> DataFrame:
        """check sees the written table before it counts; if it raises, the stage has no checkpoint."""
        folder = f"{self.at}/{stage}/{key}-{uuid.uuid4().hex}"
        df.write.parquet(folder)
        if check is not None:
            check(self.spark.read.schema(df.schema).parquet(folder))
        write_text(self.spark, self._pointer(stage, key), json.dumps({"table": folder}))
        return self.spark.read.schema(df.schema).parquet(folder)

    def read(self, stage: str, key: str = "all") -> DataFrame | None:
        """None if missing or unreadable, so that the stage runs again."""
        try:
            pointer = read_text(self.spark, self._pointer(stage, key))
            return None if pointer is None else self.spark.read.parquet(json.loads(pointer)["table"])
        except Exception:  # a damaged checkpoint only costs its stage
            return None

    def memoized(self, stage: str, make: Callable[[], DataFrame], key: str = "all", force: bool = False) -> DataFrame:
        """The stored table, or what make gives, stored."""
        found = None if force else self.read(stage, key)
        return self.write(stage, make(), key) if found is None else found


def fingerprint(df: DataFrame, *columns: str) -> str:
    """A key for the content of df, whatever its order: counts and sums of row hashes."""
    h = F.xxhash64(*columns)
    low, high = F.sum(h.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftright(h, 32))
    r = df.agg(F.count("*"), low, high).first()
    return "-".join(format(x or 0, "x").replace("-", "m") for x in r)


class Manifest:
    """Status, timing and counters of a run and its stages, written after every change; reading never writes."""

    def __init__(self, spark: SparkSession, root: str, run_date: str, stages: tuple[str, ...]):
        self.spark, self.path = spark, f"{root.rstrip('/')}/runs/{run_date}/manifest.json"
        held = read_text(spark, self.path)
        self.data = json.loads(held) if held else {"date": run_date, "started_at": None, "finished_at": None, "status": "pending", "stages": {s: {"status": "pending"} for s in stages}, "error": None}

    @staticmethod
    def now() -> str:
        return datetime.datetime.now(datetime.timezone.utc).isoformat()

    def save(self) -> None:
        write_text(self.spark, self.path, json.dumps(self.data, indent=2))

    def run_started(self) -> None:
        self.data |= {"started_at": self.data["started_at"] or self.now(), "status": "in_progress"}
        self.save()

    def stage(self, name: str, status: str, **counters) -> None:
        entry = self.data["stages"].setdefault(name, {})
        entry["status"] = status
        if status == "running":
            entry["started_at"] = self.now()
        elif entry.get("started_at"):
            entry["finished_at"] = self.now()
            entry["duration_s"] = round((datetime.datetime.fromisoformat(entry["finished_at"]) - datetime.datetime.fromisoformat(entry["started_at"])).total_seconds(), 2)
        entry |= counters
        self.save()

    def run_finished(self, error: str | None = None) -> None:
        self.data |= {"finished_at": self.now(), "status": "failed" if error else "success", "error": error}
        self.save()


class RunLog:
    """K7: the events of a run's date, each a small file of its own that is never written again.

    Writers share nothing, so any number of them lose no line.  compact() puts
    events into one file and deletes theirs; an event has an id, so one that a
    compaction left in both places counts once.
    """

    def __init__(self, spark: SparkSession, root: str, run_date: str):
        self.spark, self.folder = spark, f"{root.rstrip('/')}/logs/{run_date}"

    def event(self, stage: str | None, message: str, level: str = "INFO", **extra) -> None:
        """One event, free fields at top level."""
        self._put([{"time": Manifest.now(), "level": level, "stage": stage, "message": message, **extra, "event": uuid.uuid4().hex}])

    def _put(self, events: list[dict]) -> None:
        body = "".join(json.dumps(e, default=str) + "\n" for e in events)
        write_text(self.spark, f"{self.folder}/{time.time_ns():020d}-{uuid.uuid4().hex}.jsonl", body)

    def _held(self) -> tuple[list[str], list[dict]]:
        files, found = [f for f in listed(self.spark, self.folder) if f.endswith(".jsonl")], {}
        for f in files:
            for line in (read_text(self.spark, f) or "").splitlines():
                found.setdefault((e := json.loads(line))["event"], e)
        return files, list(found.values())

    def events(self) -> list[dict]:
        """All events in the order of their time; a log of more than PARTS files is compacted on the way."""
        files, found = self._held()
        if len(files) > PARTS:
            self.compact()
        return sorted(({k: v for k, v in e.items() if k != "event"} for e in found), key=lambda e: e["time"])

    def compact(self) -> None:
        files, found = self._held()
        if len(files) > 1:
            self._put(found)
            for f in files:
                removed(self.spark, f)


def log(spark: SparkSession, root: str, run_date: str, stage: str, message: str, level: str = "INFO", **extra) -> None:
    """K7: one event more in the run's log."""
    RunLog(spark, root, run_date).event(stage, message, level, **extra)
