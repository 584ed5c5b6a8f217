"""Numbered commits, each a small file that exactly one writer can create."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """Another writer took the version. Nothing of this one counts."""


class CommitLog:
    """Commits ``0, 1, 2, ...`` below a folder, each with a record.

    A commit is in force from the moment its file has content. The file is created
    exclusively (``create(path, overwrite=false)``), so of two writers of one number one gets an error. A file
    without content belongs to a writer between those two steps, or to one that died
    there: readers take the commit before it, writers wait a moment and then
    stop with an error, until ``void`` declares it dead. The store's create
    must be exclusive, as in HDFS, in local file systems and in object stores with conditional puts.
    """

    def __init__(self, spark: SparkSession, folder: str, patience: float = 5.0):
        self.spark, self.folder, self.patience = spark, folder.rstrip("/"), patience
        self._path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _file(self, number: int):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{number:012d}")

    def numbers(self) -> list[int]:
        """All numbers taken, the highest first, whether in force or not."""
        if not self._fs.exists(self._path):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path)]
        return sorted((int(n) for n in names if n.isdigit()), reverse=True)

    def record(self, number: int) -> dict | None:
        """What a commit says; None for one that has no content or is void."""
        found = self._content(number)
        return None if found is None or found.get("void") else found

    def _content(self, number: int) -> dict | None:
        """The record as it is in the file; None while there is no content, or not all of it."""
        stream = self._fs.open(self._file(number))
        try:
            text = bytes(stream.readAllBytes()).decode(errors="replace")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def latest(self, below: int | None = None) -> tuple[int, dict] | None:
        """The highest commit in force, optionally among those below a number."""
        for number in self.numbers():
            if below is None or number < below:
                found = self.record(number)
                if found is not None:
                    return number, found
        return None

    def settled(self) -> int:
        """The lowest number free for a new commit, once no other writer is between creating and filling its own."""
        until = time.time() + self.patience
        while True:
            numbers = self.numbers()
            if not numbers:
                return 0
            if not self._open(numbers[0]):
                return numbers[0] + 1
            if time.time() > until:
                raise CommitConflict(f"commit {numbers[0]} in {self.folder} is unfinished; void it if its writer is dead")
            time.sleep(0.1)

    def _open(self, number: int) -> bool:
        return self._content(number) is None

    def add(self, number: int, record: dict) -> None:
        """Put a record in force under a number; an error if the number is taken."""
        self._fs.mkdirs(self._path)
        target, data = self._file(number), bytearray(json.dumps(record), "utf-8")
        jvm = self.spark._jvm
        if self._fs.getScheme() == "file":  # Hadoop's own local create looks and then opens: two steps
            local = jvm.java.nio.file.Paths.get(self._fs.makeQualified(target).toUri())
            try:
                jvm.java.nio.file.Files.createFile(local, self._none("java.nio.file.attribute.FileAttribute"))
            except Exception as problem:
                raise self._taken(number) from problem
            jvm.java.nio.file.Files.write(local, data, self._none("java.nio.file.OpenOption"))
            return
        try:
            stream = self._fs.create(target, False)
        except Exception as problem:
            raise self._taken(number) from problem
        stream.write(data)
        stream.close()

    def _taken(self, number: int) -> CommitConflict:
        return CommitConflict(f"version {number} of {self.folder} was taken by another run")

    def _none(self, kind: str):
        gateway = self.spark.sparkContext._gateway
        made = gateway.jvm
        for name in kind.split("."):
            made = getattr(made, name)
        return gateway.new_array(made, 0)

    def void(self, number: int) -> None:
        """Declare an unfinished commit dead. Its number stays taken."""
        if not self._open(number):
            raise ValueError(f"commit {number} in {self.folder} is in force")
        stream = self._fs.create(self._file(number), True)
        stream.write(bytearray(json.dumps({"void": uuid.uuid4().hex}), "utf-8"))
        stream.close()
