"""Small files and folders of any file system that Spark knows: this machine's, or a shared one."""

from __future__ import annotations

import os
import shutil
import stat
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


class Local:
    """A path on this machine."""

    def __init__(self, path: str):
        self.path = Path(path.removeprefix("file://").removeprefix("file:"))

    def child(self, name: str) -> Local:
        return Local(str(self.path / name))

    def exists(self) -> bool:
        return self.path.exists()

    def names(self) -> list[str]:
        return sorted(p.name for p in self.path.iterdir()) if self.path.is_dir() else []

    def read(self) -> str:
        return self.path.read_text()

    def changed(self) -> float:
        """When it changed last, in seconds."""
        return self.path.stat().st_mtime

    def touch(self) -> None:
        os.utime(self.path)

    def replace(self, text: str) -> None:
        """Put a new text in the file's place in one step."""
        self.path.parent.mkdir(parents=True, exist_ok=True)
        new = self.path.with_name(f".{self.path.name}.{uuid.uuid4().hex}.tmp")
        try:
            new.write_text(text)
            os.replace(new, self.path)
        finally:
            new.unlink(missing_ok=True)

    def delete(self) -> None:
        if self.path.is_dir():
            shutil.rmtree(self.path, ignore_errors=True)
        else:
            self.path.unlink(missing_ok=True)

    def protect(self) -> None:
        """Make every file below read-only."""
        for p in self.path.rglob("*"):
            if p.is_file():
                p.chmod(stat.S_IRUSR | stat.S_IRGRP | stat.S_IROTH)

    def join(self, parts: list, head: str, tail: str, spare: int) -> None:
        """Write head, the parts' bytes without the last `spare` ones, and tail, in one step."""
        self.path.parent.mkdir(parents=True, exist_ok=True)
        new = self.path.with_name(f".{self.path.name}.{uuid.uuid4().hex}.tmp")
        try:
            with new.open("wb") as out:
                out.write(head.encode())
                for p in parts:
                    with p.path.open("rb") as f:
                        shutil.copyfileobj(f, out, 1 << 20)
                if out.tell() > len(head.encode()):
                    out.seek(-spare, os.SEEK_END)
                    out.truncate()
                out.write(tail.encode())
            os.replace(new, self.path)
        finally:
            new.unlink(missing_ok=True)


class Shared:
    """A path of another file system, through Hadoop's interface."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.at = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.at.getFileSystem(self.conf)

    def child(self, name: str) -> Shared:
        return Shared(self.spark, f"{self.path.rstrip('/')}/{name}")

    def exists(self) -> bool:
        return self.fs.exists(self.at)

    def names(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at)) if self.exists() else []

    def read(self) -> str:
        stream = self.fs.open(self.at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def changed(self) -> float:
        return self.fs.getFileStatus(self.at).getModificationTime() / 1000

    def touch(self) -> None:
        import time

        self.fs.setTimes(self.at, int(time.time() * 1000), -1)

    def replace(self, text: str) -> None:
        new = self.jvm.org.apache.hadoop.fs.Path(self.at.getParent(), f".{self.at.getName()}.{uuid.uuid4().hex}.tmp")
        out = self.fs.create(new, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self._publish(new)

    def _publish(self, new) -> None:
        """Rename a file to this path, over what is there: one step, where the file system has it."""
        try:
            rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
            options = self.spark.sparkContext._gateway.new_array(rename, 1)
            options[0] = rename.OVERWRITE
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf).rename(new, self.at, options)
        finally:
            if self.fs.exists(new):
                self.fs.delete(new, False)

    def delete(self) -> None:
        self.fs.delete(self.at, True)

    def protect(self) -> None:
        files = self.fs.listFiles(self.at, True)
        permission = self.jvm.org.apache.hadoop.fs.permission.FsPermission("444")
        while files.hasNext():
            self.fs.setPermission(files.next().getPath(), permission)

    def join(self, parts: list, head: str, tail: str, spare: int) -> None:
        new = self.jvm.org.apache.hadoop.fs.Path(self.at.getParent(), f".{self.at.getName()}.{uuid.uuid4().hex}.tmp")
        out, copy = self.fs.create(new, True), self.jvm.org.apache.commons.io.IOUtils.copyLarge
        try:
            out.write(bytearray(head.encode()))
            sizes = [self.fs.getFileStatus(p.at).getLen() for p in parts]
            last = max((k for k, n in enumerate(sizes) if n), default=-1)
            for k, (p, n) in enumerate(zip(parts, sizes)):
                stream = self.fs.open(p.at)
                try:
                    copy(stream, out, 0, n - spare if k == last else n)
                finally:
                    stream.close()
            out.write(bytearray(tail.encode()))
        finally:
            out.close()
        self._publish(new)


def place(path: str) -> Local | Shared:
    """The path on the file system that Spark would use for it."""
    spark = SparkSession.getActiveSession()
    if spark is None or path.startswith("file:"):
        return Local(path)
    shared = Shared(spark, path)
    return Local(path) if shared.fs.getScheme() == "file" else shared
