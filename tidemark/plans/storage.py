"""Small driver-side files next to the data, through Hadoop's FileSystem.

Only metadata passes through here: claims, commit records, the readable checkpoint.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tidemark.errors import ContractError

_LOOKS = 5


class Store:
    """Files below one root, which must be absolute so that every process means the same place."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        parsed = urlparse(root)
        if not parsed.path.startswith("/"):
            raise ContractError(f"root must be an absolute path or URI, got {root!r}")
        self.spark = spark
        self.root = root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        conf = spark._jsc.hadoopConfiguration()
        self._fs = self._hadoop.Path(self.root).getFileSystem(conf)
        self._local = self._fs.getUri().getScheme() == "file"

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def _java(self, relative: str):
        return self._hadoop.Path(self.path(relative))

    def exists(self, relative: str) -> bool:
        return self._fs.exists(self._java(relative))

    def names(self, relative: str) -> list[str]:
        """Sorted entry names of a directory; empty if it does not exist.

        Another run may remove and create it meanwhile, so that a listing finds nothing and a look
        afterwards does; then it is listed again.
        """
        for looks_left in reversed(range(_LOOKS)):
            try:
                found = [status.getPath().getName() for status in self._fs.listStatus(self._java(relative))]
                return sorted(name for name in found if not name.startswith((".", "_")))
            except Py4JJavaError:
                if not self.exists(relative):
                    return []
                if not looks_left:
                    raise

    def read(self, relative: str) -> str:
        try:
            stream = self._fs.open(self._java(relative))
        except Py4JJavaError as failed:
            if self.exists(relative):
                raise
            raise FileNotFoundError(self.path(relative)) from failed
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, relative: str, text: str) -> bool:
        """Write a file only if nobody has; False if it is already there.

        Atomic on HDFS and on a local disk. On object stores it is as exclusive as the
        connector's create-without-overwrite.
        """
        java_path = self._java(relative)
        self._fs.mkdirs(java_path.getParent())
        if self._local:
            flags = os.O_CREAT | os.O_EXCL | os.O_WRONLY
            try:
                handle = os.open(java_path.toUri().getPath(), flags, 0o644)
            except FileExistsError:
                return False
            with os.fdopen(handle, "wb") as out:
                out.write(text.encode("utf-8"))
            return True
        try:
            stream = self._fs.create(java_path, False)
        except Py4JJavaError:
            if self._fs.exists(java_path):
                return False
            raise
        self._fill(stream, text)
        return True

    def create_whole(self, relative: str, text: str) -> bool:
        """Like :meth:`create`, and no reader ever sees part of the file."""
        target, draft = self._java(relative), self._draft(relative, text)
        if self._local:
            try:
                os.link(draft.toUri().getPath(), target.toUri().getPath())
                return True
            except FileExistsError:
                return False
            except OSError:  # a mount without hard links
                if self._fs.exists(target):
                    return False
                os.rename(draft.toUri().getPath(), target.toUri().getPath())
                return True
            finally:
                self._fs.delete(draft, False)
        if not self._fs.exists(target) and self._fs.rename(draft, target):
            return True
        self._fs.delete(draft, False)
        if self._fs.exists(target):
            return False
        raise OSError(f"could not move {draft.toString()} into place")

    def replace(self, relative: str, text: str) -> None:
        """Write a file that appears whole or not at all, replacing an earlier one."""
        target, draft = self._java(relative), self._draft(relative, text)
        if self._local:
            os.replace(draft.toUri().getPath(), target.toUri().getPath())
            return
        if self._fs.exists(target):
            self._fs.delete(target, False)
        if not self._fs.rename(draft, target):
            raise OSError(f"could not move {draft.toString()} into place")

    def _draft(self, relative: str, text: str):
        """The file's content under a hidden name next to it."""
        target = self._java(relative)
        self._fs.mkdirs(target.getParent())
        draft = self._hadoop.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
        # The raw local file system writes no checksum file, which a rename would leave behind.
        files = self._fs.getRawFileSystem() if self._local else self._fs
        self._fill(files.create(draft, True), text)
        return draft

    @staticmethod
    def _fill(stream, text: str) -> None:
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def delete(self, relative: str) -> None:
        self._fs.delete(self._java(relative), True)

    def size(self, uri: str) -> int:
        """Bytes below a path that may lie outside the root."""
        path = self._hadoop.Path(uri)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()

    def delete_uri(self, uri: str) -> None:
        """Delete a tree that may lie outside the root, such as staged rows."""
        path = self._hadoop.Path(uri)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
