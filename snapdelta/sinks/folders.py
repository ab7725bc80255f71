"""Folder operations on whatever file system a path belongs to (HDFS, an object store, local disk)."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folders:
    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, folder: str):
        path = self._jvm.org.apache.hadoop.fs.Path(folder)
        return path, path.getFileSystem(self._conf)

    def exists(self, folder: str) -> bool:
        path, fs = self._path(folder)
        return fs.exists(path)

    def delete(self, folder: str) -> None:
        path, fs = self._path(folder)
        fs.delete(path, True)

    def has_data(self, folder: str) -> bool:
        """True when the folder holds at least one file that a reader would see."""
        path, fs = self._path(folder)
        if not fs.exists(path):
            return False
        files = fs.listFiles(path, True)
        while files.hasNext():
            if files.next().getPath().getName()[0] not in "_.":
                return True
        return False

    def names(self, folder: str) -> list[str]:
        """The names right below a folder; none where it does not exist."""
        path, fs = self._path(folder)
        if not fs.exists(path):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(path))

    def data_files(self, folder: str) -> list[str]:
        """Paths of the files right in a folder that a reader would see."""
        path, fs = self._path(folder)
        if not fs.exists(path):
            return []
        return sorted(str(each.getPath()) for each in fs.listStatus(path) if each.isFile() and each.getPath().getName()[0] not in "_.")

    def data_folders(self, folder: str) -> list[str]:
        """The folders at or below a folder that hold such files, hidden ones left out."""
        path, fs = self._path(folder)
        if not fs.exists(path):
            return []
        below = [each for each in fs.listStatus(path) if each.getPath().getName()[0] not in "_."]
        found = [folder] if any(each.isFile() for each in below) else []
        for each in below:
            if each.isDirectory():
                found += self.data_folders(f"{folder}/{each.getPath().getName()}")
        return found

    def modified(self, folder: str) -> float:
        """When a file or folder was last changed, in seconds."""
        path, fs = self._path(folder)
        return fs.getFileStatus(path).getModificationTime() / 1000

    def read_text(self, file: str) -> str:
        path, fs = self._path(file)
        try:
            stream = fs.open(path)
        except Py4JJavaError:
            if fs.exists(path):
                raise
            raise FileNotFoundError(file) from None
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_text(self, file: str, text: str) -> bool:
        """Write a small file; False, and nothing written, where there is one already."""
        path, fs = self._path(file)
        fs.mkdirs(path.getParent())
        try:
            stream = fs.create(path, False)
        except Py4JJavaError:
            if fs.exists(path):
                return False
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True

    def delete_at_exit(self, folder: str) -> None:
        path, fs = self._path(folder)
        fs.mkdirs(path)
        fs.deleteOnExit(path)
