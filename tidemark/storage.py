"""Shared storage: versioned tables that are published by one rename.

Everything an operator keeps lies in the folder the session names in ``spark.checkpoint.dir``, which all executors
share.  Data files are written under a fresh name first and become visible only when a manifest that lists them gets its
name, in one step that fails if another writer was faster; a run that dies half way leaves nothing a reader can see.
"""

from __future__ import annotations

import atexit
import json
import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


class PublishConflict(RuntimeError):
    """Another writer published the version this writer wanted to publish."""


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share; only where the session names none, one of this process's own (tests)."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = getattr(shared_root, "own", None) or tempfile.mkdtemp(prefix="tidemark-")
        shared_root.own = named
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared root, removed when the application ends."""
    path = f"{shared_root(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove_quietly, spark, path)
    return path


def _remove_quietly(spark: SparkSession, path: str) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            Folder(spark, path).remove()
    except Exception:  # the application is ending; a folder left behind is harmless
        pass


def write_once(df: DataFrame, path: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back."""
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Folder:
    """A folder reached through Hadoop's file systems, so that local disks, HDFS and object stores work alike."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._jpath("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _jpath(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._jpath(name))

    def names(self, name: str = "") -> list[str]:
        if not self.exists(name):
            return []
        return sorted(x.getPath().getName() for x in self._fs.listStatus(self._jpath(name)))

    def times(self) -> list[tuple[str, float]]:
        """(name, seconds of its last modification) of what lies in the folder."""
        return sorted((x.getPath().getName(), x.getModificationTime() / 1000) for x in self._fs.listStatus(self._jpath("")))

    def remove(self, name: str = "") -> None:
        self._fs.delete(self._jpath(name), True)

    def read_text(self, name: str) -> str:
        stream = self._fs.open(self._jpath(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, name: str, text: str, replace: bool = False) -> None:
        """Write under a temporary name, then give it its own: a reader sees the whole text or none."""
        temporary = f"_tmp-{uuid.uuid4().hex}"
        out = self._fs.create(self._jpath(temporary), False)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        if replace:
            options = self._jvm.org.apache.hadoop.fs.Options.Rename
            kinds = self.spark.sparkContext._gateway.new_array(options, 1)
            kinds[0] = options.OVERWRITE
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration()
            )
            qualified = lambda n: self._fs.makeQualified(self._jpath(n))
            context.rename(qualified(temporary), qualified(name), kinds)
            return
        try:
            self._link(temporary, name)
        except FileExistsError:
            raise PublishConflict(name) from None
        finally:
            self._fs.delete(self._jpath(temporary), False)

    def _link(self, temporary: str, name: str) -> None:
        """Give a finished file its name in one step that fails if the name is taken, so that of two writers one wins.

        A local or mounted disk makes a hard link; other file systems rename without overwriting, which HDFS decides in
        its name node.  (An object store needs a committer or table format of its own for that.)
        """
        if self._fs.getUri().getScheme() == "file":
            local = lambda n: self._fs.makeQualified(self._jpath(n)).toUri().getPath()
            os.link(local(temporary), local(name))
            return
        from py4j.protocol import Py4JJavaError

        options = self._jvm.org.apache.hadoop.fs.Options.Rename
        kinds = self.spark.sparkContext._gateway.new_array(options, 0)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(self._fs.makeQualified(self._jpath(temporary)), self._fs.makeQualified(self._jpath(name)), kinds)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception):
                raise FileExistsError(name) from None
            raise

    def files(self) -> list[tuple[str, int, int]]:
        """(path, length, time of modification) of the data files below the folder, or of the path itself."""
        if not self.exists():
            return []
        found, out = self._fs.listFiles(self._jpath(""), True), []
        while found.hasNext():
            f = found.next()
            if not f.getPath().getName().startswith(("_", ".")):
                out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        return sorted(out)


class Manifest:
    """Numbered manifests ``manifest-00000042.json`` in a folder; the highest number is the published state."""

    def __init__(self, folder: Folder):
        self.folder = folder

    def latest(self) -> tuple[int, dict]:
        found = [n for n in self.folder.names() if n.startswith("manifest-")]
        if not found:
            return 0, {}
        return int(found[-1][9:-5]), json.loads(self.folder.read_text(found[-1]))

    def publish(self, version: int, state: dict) -> None:
        """Publish ``state`` as ``version``; fails if another writer was faster."""
        self.folder.write_text(f"manifest-{version:08d}.json", json.dumps(state, sort_keys=True))


def read_paths(spark: SparkSession, paths: Sequence[str], schema) -> DataFrame:
    """The union of Parquet folders, or an empty table of the schema."""
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)
