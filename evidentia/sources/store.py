"""Objects under a root: a local folder, or any file system that Spark reaches.

Objects are written beside their place and moved into it, so a half-written one is never seen; put_if_absent
moves only if nothing is there. On object stores, where a move is a copy, use a committer with conditional
writes; the check is then as strong as the store's."""

from __future__ import annotations

import os
import shutil
import uuid
from datetime import UTC, datetime

from pyspark.sql import SparkSession


class LocalStore:
    """A folder of this machine, for tests and single nodes."""

    def __init__(self, root: str):
        self.root = "/" + root.removeprefix("file:").lstrip("/") if root.startswith("file:") else root

    def uri(self, key: str) -> str:
        return os.path.join(self.root, key)

    def _beside(self, key: str, data: bytes) -> tuple[str, str]:
        path = self.uri(key)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        tmp = os.path.join(os.path.dirname(path), f".{uuid.uuid4().hex}.tmp")
        with open(tmp, "xb") as f:
            f.write(data)
        return tmp, path

    def put_if_absent(self, key: str, data: bytes) -> bool:
        tmp, path = self._beside(key, data)
        try:
            os.link(tmp, path)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(tmp)

    def put(self, key: str, data: bytes) -> None:
        os.replace(*self._beside(key, data))

    def get(self, key: str) -> bytes | None:
        try:
            with open(self.uri(key), "rb") as f:
                return f.read()
        except FileNotFoundError:
            return None

    def list(self, prefix: str = "") -> list[tuple[str, datetime]]:
        """(key, time of upload) by key."""
        out = []
        for folder, _, names in os.walk(self.uri(prefix)):
            for n in names:
                if not n.startswith((".", "_")):
                    path = os.path.join(folder, n)
                    out.append((os.path.relpath(path, self.root), datetime.fromtimestamp(os.stat(path).st_mtime, UTC)))
        return sorted(out)

    def delete(self, key: str) -> bool:
        """True if there was something: an object, or all objects under a prefix."""
        path = self.uri(key)
        if os.path.isdir(path):
            shutil.rmtree(path)
            return True
        try:
            os.unlink(path)
            return True
        except FileNotFoundError:
            return False


class HadoopStore:
    """A folder of any file system that the session's Hadoop configuration knows."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self.jvm, self.gateway = root.rstrip("/"), spark._jvm, spark.sparkContext._gateway
        self.hadoop = self.jvm.org.apache.hadoop.fs
        conf, at = spark._jsc.hadoopConfiguration(), self.hadoop.Path(root)
        self.fs, self.context = at.getFileSystem(conf), self.hadoop.FileContext.getFileContext(at.toUri(), conf)
        self.base = self.fs.makeQualified(at).toString().rstrip("/")

    def uri(self, key: str) -> str:
        return f"{self.root}/{key}" if key else self.root

    def _beside(self, key: str, data: bytes):
        path = self.hadoop.Path(self.uri(key))
        tmp = self.hadoop.Path(path.getParent(), f".{uuid.uuid4().hex}.tmp")
        out = self.fs.create(tmp, False)
        out.write(bytearray(data))
        out.close()
        return tmp, path

    def _move(self, tmp, path, over: bool) -> bool:
        from py4j.protocol import Py4JJavaError

        rename = self.gateway.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE if over else rename.NONE
        try:
            self.context.rename(tmp, path, how)
            return True
        except Py4JJavaError as e:
            self.fs.delete(tmp, False)
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise

    def put_if_absent(self, key: str, data: bytes) -> bool:
        if self.fs.exists(self.hadoop.Path(self.uri(key))):
            return False
        return self._move(*self._beside(key, data), False)

    def put(self, key: str, data: bytes) -> None:
        self._move(*self._beside(key, data), True)

    def get(self, key: str) -> bytes | None:
        path = self.hadoop.Path(self.uri(key))
        if not self.fs.exists(path):
            return None
        stream = self.fs.open(path)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def list(self, prefix: str = "") -> list[tuple[str, datetime]]:
        path, out = self.hadoop.Path(self.uri(prefix)), []
        if not self.fs.exists(path):
            return out
        files = self.fs.listFiles(path, True)
        while files.hasNext():
            f = files.next()
            if not f.getPath().getName().startswith((".", "_")):
                out.append((f.getPath().toString().removeprefix(f"{self.base}/"), datetime.fromtimestamp(f.getModificationTime() / 1000, UTC)))
        return sorted(out)

    def delete(self, key: str) -> bool:
        return self.fs.delete(self.hadoop.Path(self.uri(key)), True)


Store = LocalStore | HadoopStore


def store_at(root: str, spark: SparkSession | None = None) -> Store:
    """The store of a root: a plain path or file: is local, all else is Hadoop's."""
    if root.startswith("file:") or "://" not in root:
        return LocalStore(root)
    if spark is None:
        raise ValueError(f"{root} needs a session")
    return HadoopStore(spark, root)
