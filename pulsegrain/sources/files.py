"""Small files on any file system Spark reaches: what a table's manifest needs."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """The file system of one path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._system = self._path(path).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> dict[str, int]:
        """Entries of a folder with their time of change in milliseconds; none if there is no folder."""
        path = self._path(folder)
        if not self._system.exists(path):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self._system.listStatus(path)}

    def read(self, file: str) -> str:
        stream = self._system.open(self._path(file))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, file: str, text: str) -> None:
        stream = self._system.create(self._path(file), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def publish(self, draft: str, file: str) -> bool:
        """Give a written file its name in one step, unless the name is taken."""
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._system.getUri(), self._conf)
        kinds = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        nothing = self._jvm.java.lang.reflect.Array.newInstance(kinds._java_lang_class, 0)
        try:
            context.rename(self._path(draft), self._path(file), nothing)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in str(error.java_exception.getClass().getName()):
                raise
            return False
        return True

    def remove(self, path: str) -> None:
        self._system.delete(self._path(path), True)
