"""Files in any store that Spark reaches: by Hadoop's file systems on the driver, by Arrow's in tasks.

The driver only touches single small files and lists single folders: state files, marks and the folder of the runs.  Whatever
grows with the archive is listed, read and written by tasks, which get full addresses (``located``) and open them with Arrow.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Schemes by which Arrow knows what Hadoop calls otherwise.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfs", "abfss": "abfs"}


class Store:
    """The driver's view of the file system that holds ``path``; a local one is used directly, for its exclusive creation."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self._jvm, self._path = jvm, jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self._path(path).getFileSystem(self._conf)
        self.local = self._fs.getScheme() == "file"

    def address(self, path: str) -> str:
        """The full address: with its scheme, and behind mount points if the store has them."""
        at, below = self._fs.makeQualified(self._path(path)), []
        while not self._fs.exists(at) and at.getParent() is not None:
            below.append(at.getName())
            at = at.getParent()
        return "/".join([self._fs.resolvePath(at).toString().rstrip("/"), *reversed(below)])

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def is_folder(self, path: str) -> bool:
        return self.exists(path) and self._fs.getFileStatus(self._path(path)).isDirectory()

    def modified(self, path: str) -> float:
        """When a file was written last, in seconds; 0 if it is gone."""
        return self._fs.getFileStatus(self._path(path)).getModificationTime() / 1000 if self.exists(path) else 0.0

    def names(self, folder: str) -> list[tuple[str, bool]]:
        """(name, is a folder) of what stands in one folder, sorted; none if it does not exist."""
        if not self.exists(folder):
            return []
        return sorted((s.getPath().getName(), s.isDirectory()) for s in self._fs.listStatus(self._path(folder)))

    def read(self, path: str) -> bytes | None:
        """A small file's bytes; none if it does not exist."""
        if not self.exists(path) or self.is_folder(path):
            return None
        stream = self._fs.open(self._path(path))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def _write(self, path: str, data: bytes, overwrite: bool) -> None:
        stream = self._fs.create(self._path(path), overwrite)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()

    def create(self, path: str, data: bytes) -> bool:
        """Writes a file that does not exist yet; false, and nothing written, if another writer was first.

        Whoever sees the file sees it whole in a local store, where it is linked in place; elsewhere creation is what is exclusive.
        """
        if self.local:
            target = plain(path)
            os.makedirs(os.path.dirname(target), exist_ok=True)
            beside = f"{target}.tmp.{uuid.uuid4().hex}"
            with open(beside, "wb") as f:
                f.write(data)
            try:
                os.link(beside, target)
                return True
            except FileExistsError:
                return False
            except OSError:  # a file system without links
                return self._create_alone(target, data)
            finally:
                os.remove(beside)
        from py4j.protocol import Py4JJavaError

        try:
            self._write(path, data, False)
            return True
        except Py4JJavaError:
            if self.exists(path):
                return False
            raise

    @staticmethod
    def _create_alone(target: str, data: bytes) -> bool:
        try:
            with open(target, "xb") as f:
                f.write(data)
            return True
        except FileExistsError:
            return False

    def put(self, path: str, data: bytes) -> None:
        """Writes beside the file and renames, so that readers see the old content or the new one."""
        beside = f"{path}.tmp.{uuid.uuid4().hex}"
        if self.local:
            os.makedirs(os.path.dirname(plain(path)), exist_ok=True)
            with open(plain(beside), "wb") as f:
                f.write(data)
            os.replace(plain(beside), plain(path))
            return
        self._write(beside, data, True)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        how = self._jvm.java.lang.reflect.Array.newInstance(rename.OVERWRITE.getClass(), 1)
        how[0] = rename.OVERWRITE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(self._path(beside), self._path(path), how)

    def delete(self, path: str) -> None:
        """Deletes a file, or a folder with all below it; no error if it is not there."""
        self._fs.delete(self._path(path), True)


def plain(path: str) -> str:
    """A local path without its scheme."""
    return path.removeprefix("file://").removeprefix("file:") if path.startswith("file:") else path


def located(spark: SparkSession, path: str) -> str:
    """The full address of a path, which tasks open with :func:`in_task`; a local one is a plain path."""
    return plain(Store(spark, path).address(path)) or "/"


def in_task(address: str):
    """(Arrow file system, path in it) of a full address."""
    from pyarrow import fs

    scheme, mark, rest = address.partition("://")
    if not mark or scheme == "file":
        return fs.LocalFileSystem(), plain(address)
    host, _, path = rest.partition("/")
    store, base = fs.FileSystem.from_uri(f"{ARROW_SCHEMES.get(scheme, scheme)}://{host}/")
    return store, f"{base.rstrip('/')}/{path}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's address that all executors see: below ``spark.checkpoint.dir``, or in local mode one of our own."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="missivelake-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{located(spark, base)}/missivelake/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes a table into the shared folder and reads it back, so that what is above it is carried out once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of a table of long values that is sent to all tasks.
SENT = 32 << 20


def few(df: DataFrame, column: str) -> bool:
    """Whether a staged table's long values have few bytes together."""
    return (df.agg(F.sum(F.octet_length(column))).first()[0] or 0) <= SENT


def sent(df: DataFrame, column: str) -> DataFrame:
    """A staged table of long values, to be sent to all tasks if they have few bytes together."""
    return F.broadcast(df) if few(df, column) else df


def bucketed(df: DataFrame, key: str, name: str, buckets: int = 64) -> DataFrame:
    """Writes a table in buckets of a key, sorted within each, below the shared folder, and reads it back.

    Two such tables of as many buckets are joined on the key without an exchange and without a sort.  A kept inventory or
    reference table is written once and joined in every run; the catalogue holds its name, the folder its rows.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = scratch(spark, table)
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)
