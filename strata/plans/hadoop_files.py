"""Small files and listings through Hadoop's filesystems, so that every root Spark can open works here too."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class HadoopFiles:
    def __init__(self, spark: SparkSession) -> None:
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self.jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        where, files = self._at(path)
        return files.exists(where)

    def names(self, path: str) -> list[str]:
        """Names of the entries of a directory; none if it is missing."""
        where, files = self._at(path)
        return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []

    def data_files(self, path: str) -> list[tuple[str, int]]:
        """(name below ``path``, bytes) of the data files under a directory, as Spark reads them."""
        where, files = self._at(path)
        if not files.exists(where):
            return []
        base, found, listing = files.makeQualified(where).toString().rstrip("/") + "/", [], files.listFiles(where, True)
        while listing.hasNext():
            status = listing.next()
            name = status.getPath().toString().removeprefix(base)
            if not any(part.startswith(("_", ".")) for part in name.split("/")):
                found.append((name, status.getLen()))
        return sorted(found)

    def size(self, path: str) -> int:
        """Bytes of a file, or of all files under a directory."""
        where, files = self._at(path)
        return files.getContentSummary(where).getLength()

    def read_text(self, path: str) -> str:
        where, files = self._at(path)
        stream = files.open(where)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> bool:
        """Write a file that nobody can see half of; false if it is there already."""
        aside = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        where, files = self._at(aside)
        target, _ = self._at(path)
        stream = files.create(where, True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        if not files.exists(target) and files.rename(where, target):
            return True
        files.delete(where, False)
        return False

    def delete(self, path: str) -> None:
        where, files = self._at(path)
        files.delete(where, True)
