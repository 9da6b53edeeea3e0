"""Several folders published together.

A run that writes more than one tree writes each of them *aside*, under an
underscored folder that Spark's readers skip.  Only when all are whole does
``commit`` note the moves in one manifest file and then rename the parts into
place; a run that fails before has changed nothing that a reader sees.  A run
that dies while it renames leaves the manifest, and ``recover``, which every run
calls first, carries the rest of the moves out.

Between the removal of an old part and the rename of its successor a reader may
miss that part for a moment, as with any overwrite of Spark's; what it can't see
is one side of a batch whose other side failed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import replace

from pyspark.sql import SparkSession

from revisor.session import file_system, release
from revisor.sinks.parquet import WriteOutcome

_MARK = "_publish-"


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _carry_out(spark: SparkSession, manifest: str) -> None:
    """The moves of a manifest that are not done yet; then it and the emptied folders go."""
    fs = file_system(spark, manifest)
    stream = fs.open(_path(spark, manifest))
    try:
        noted = json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()
    for source, target in noted["moves"]:
        own = file_system(spark, source)
        source_path, target_path = _path(spark, source), _path(spark, target)
        if not own.exists(source_path):
            continue  # moved before
        own.delete(target_path, True)
        own.mkdirs(target_path.getParent())
        if not own.rename(source_path, target_path):
            raise RuntimeError(f"{source} could not be moved to {target}")
    release(spark, *noted["folders"], manifest)


def recover(spark: SparkSession, home: str) -> int:
    """Finish the publications that stopped half-way under ``home``; their number."""
    found = file_system(spark, home).globStatus(_path(spark, f"{home}/{_MARK}*.json")) or []
    manifests = sorted(status.getPath().toString() for status in found)
    for manifest in manifests:
        _carry_out(spark, manifest)
    return len(manifests)


class Publication:
    """The trees of one run: ``aside`` says where to write one, ``add`` takes it in, ``commit`` shows all."""

    def __init__(self, spark: SparkSession, home: str):
        self.spark, self.home = spark, home.rstrip("/")
        self.name = f"{_MARK}{uuid.uuid4().hex}"
        self.folders: list[str] = []
        self.moves: list[tuple[str, str]] = []
        self.noted = False

    def aside(self, target: str) -> str:
        """A folder beside ``target``, on the same file system."""
        parent, _, last = target.rstrip("/").rpartition("/")
        folder = f"{parent}/{self.name}"
        if folder not in self.folders:
            self.folders.append(folder)
        return f"{folder}/{last}"

    def add(self, outcome: WriteOutcome, target: str, overwrite: str, levels: int) -> WriteOutcome:
        """Note a tree written aside: it replaces ``target`` (``static``) or, ``levels`` deep, its partitions (``dynamic``).

        Nothing is noted where nothing was written, so old data stays."""
        if outcome.ok:
            source = outcome.path.rstrip("/")
            target = target.rstrip("/")
            if overwrite == "static":
                self.moves.append((source, target))
            else:
                parts = file_system(self.spark, source).globStatus(_path(self.spark, source + "/*=*" * levels)) or []
                root = len(_path(self.spark, source).toUri().getPath())
                for part in parts:  # one entry a partition, as in Spark's own commit
                    inner = part.getPath().toUri().getPath()[root:]
                    self.moves.append((source + inner, target + inner))
        return replace(outcome, path=target)

    def commit(self) -> None:
        if not self.moves:
            self.abort()
            return
        manifest = f"{self.home}/{self.name}.json"
        fs = file_system(self.spark, manifest)
        text = json.dumps({"moves": self.moves, "folders": self.folders})
        draft = _path(self.spark, manifest + ".draft")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if not fs.rename(draft, _path(self.spark, manifest)):  # from here on the batch is published
            raise RuntimeError(f"the manifest {manifest} could not be written")
        self.noted = True
        _carry_out(self.spark, manifest)

    def abort(self) -> None:
        """Remove what was written aside, unless it is published already: then ``recover`` will finish it."""
        if not self.noted:
            release(self.spark, *self.folders)
