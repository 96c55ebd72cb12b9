"""Objects under a root, through Hadoop's file systems: local folders, HDFS and object stores (s3a://) alike.

Keys are relative to the root, with ``/`` between parts, and prefixes are plain string prefixes as in object stores.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import SparkSession

from millrace.errors import PartitionUploadFailed


class Objects:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.jvm: Any = spark._jvm
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        raw = self.jvm.org.apache.hadoop.fs.Path(root)
        self.fs = raw.getFileSystem(self.conf)
        self.root = self.fs.makeQualified(raw).toString().rstrip("/")

    def uri(self, key: str) -> str:
        return f"{self.root}/{key}"

    def _path(self, key: str) -> Any:
        return self.jvm.org.apache.hadoop.fs.Path(self.uri(key)) if key else self.jvm.org.apache.hadoop.fs.Path(self.root)

    def keys(self, prefix: str) -> list[str]:
        """The keys of all objects that start with ``prefix``, sorted."""
        folder = self._path(prefix.rpartition("/")[0])
        if not self.fs.exists(folder):
            return []
        found = self.fs.listFiles(folder, True)
        out = []
        while found.hasNext():
            key = found.next().getPath().toString().removeprefix(self.root + "/")
            if key.startswith(prefix):
                out.append(key)
        return sorted(out)

    def read(self, key: str, most: int | None = None) -> bytes:
        """An object's bytes, or its first ``most``."""
        stream = self.fs.open(self._path(key))
        try:
            if most is None:
                return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
            bounded = self.jvm.org.apache.commons.io.input.BoundedInputStream(stream, most)
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(bounded))
        finally:
            stream.close()

    def write(self, key: str, data: bytes) -> None:
        """Put an object, over an older one."""
        out = self.fs.create(self._path(key), True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()

    def delete(self, prefix: str) -> int:
        """Delete all objects that start with ``prefix``; returns how many there were."""
        found = self.keys(prefix)
        for key in found:
            self.fs.delete(self._path(key), False)
        return len(found)

    def delete_folder(self, key: str) -> None:
        self.fs.delete(self._path(key), True)

    def publish(self, staged: str, key: str) -> None:
        """Move a staged object to its key, over an older one. A plain rename would leave the older one in place."""
        source, target = self._path(staged), self._path(key)
        try:
            self.fs.mkdirs(target.getParent())
            if self.fs.exists(target):
                self.fs.delete(target, False)
            done = self.fs.rename(source, target)
        except Exception as e:
            raise PartitionUploadFailed(key, str(e).splitlines()[0]) from e
        if not done:
            raise PartitionUploadFailed(key, "rename refused")

    def staging(self, prefix: str) -> str:
        return f"{prefix}_staging/{uuid.uuid4().hex}"
