"""Small numbered documents, each committed by creating a file that must not yet exist.

A folder holds ``v<number>.json`` files. Two writers that try the same number cannot both succeed, and the
newest number is found by listing the folder. A file that does not hold a whole document (its writer died, or
is still at it) is a number without a commit: readers pass over it and the next writer takes the next number.
Creating a file only where none is, is atomic on HDFS and on object stores with conditional writes.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import SparkSession

from snapdelta.sinks.folders import Folders

# A local disk has no such create; within one driver this lock stands in for it. Readers wait for it too: a file that
# is still being written must not pass for a number without a commit.
_CREATING = threading.RLock()


class VersionLog:
    def __init__(self, spark: SparkSession, folder: str):
        self._folders = Folders(spark)
        self.folder = folder.rstrip("/")

    def _file(self, version: int) -> str:
        return f"{self.folder}/v{version:012}.json"

    def versions(self) -> list[int]:
        """The numbers that are taken, ascending."""
        names = [name for name in self._folders.names(self.folder) if name[0] == "v" and name.endswith(".json")]
        return sorted(int(name[1:-5]) for name in names)

    def read(self, version: int) -> dict | None:
        """The document of a number, None when it holds no commit (or does not any more)."""
        try:
            with _CREATING:
                found = json.loads(self._folders.read_text(self._file(version)))
        except (ValueError, FileNotFoundError):
            return None
        return found if isinstance(found, dict) else None

    def newest(self) -> tuple[int, dict | None]:
        """The highest number taken (0 without any) and the newest document."""
        with _CREATING:
            taken = self.versions()
            for version in reversed(taken):
                found = self.read(version)
                if found is not None:
                    return taken[-1], found
        return (taken[-1] if taken else 0), None

    def commit(self, version: int, document: dict) -> bool:
        """Save a document under a number; False when another writer was first."""
        with _CREATING:
            return self._folders.create_text(self._file(version), json.dumps(document, sort_keys=True))

    def drop(self, version: int) -> None:
        self._folders.delete(self._file(version))
