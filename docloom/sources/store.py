"""Folders that driver and executors share, and states that change as one: numbered manifests, the last one valid."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; on a local master without one, a temporary folder. A cluster must name its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='docloom-shared-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_name(what: str) -> str:
    return f"{what}-{uuid.uuid4().hex[:12]}"


def written(rows: DataFrame, what: str) -> DataFrame:
    """rows, written to the shared folder and read again: what several steps use is computed once, and lost executors lose nothing."""
    folder = f"{shared_folder(rows.sparkSession)}/{new_name(what)}"
    rows.write.option("compression", "zstd").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


class Files:
    """File operations of whatever store Spark reads from."""

    def __init__(self, spark: SparkSession):
        self.context = spark.sparkContext

    def _at(self, path: str):
        p = self.context._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.context._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        p, fs = self._at(path)
        return fs.exists(p)

    def names(self, folder: str) -> list[str]:
        p, fs = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def size(self, path: str) -> int:
        p, fs = self._at(path)
        return fs.getFileStatus(p).getLen()

    def stamp(self, path: str) -> str:
        """What changes when the file does."""
        p, fs = self._at(path)
        s = fs.getFileStatus(p)
        return f"{path}|{s.getLen()}|{s.getModificationTime()}"

    def delete(self, path: str) -> None:
        p, fs = self._at(path)
        fs.delete(p, True)

    def read(self, path: str) -> str:
        p, fs = self._at(path)
        stream = fs.open(p)
        try:
            return self.context._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> bool:
        """Writes a file whole under a name not yet taken, or returns False."""
        p, fs = self._at(path)
        if fs.exists(p):
            return False
        part, _ = self._at(f"{path}.{uuid.uuid4().hex[:8]}.part")
        stream = fs.create(part, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if fs.exists(p) or not fs.rename(part, p):
            fs.delete(part, False)
            return False
        return True


class Manifest:
    """The state of a folder's data: numbered JSON files. What no state names does not exist, so a writer that is lost
    before its state is put changes nothing."""

    def __init__(self, spark: SparkSession, folder: str):
        self.files, self.folder = Files(spark), f"{folder}/_states"

    def _numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.files.names(self.folder) if n.endswith(".json")]

    def version(self) -> int:
        return max(self._numbers(), default=0)

    def state(self, version: int | None = None) -> dict | None:
        version = self.version() if version is None else version
        return json.loads(self.files.read(f"{self.folder}/{version:09d}.json")) if version else None

    def put(self, state: dict, after: int) -> int:
        """Makes `state` the one that follows version `after`; another writer that was first is an error."""
        if self.version() != after or not self.files.write_new(f"{self.folder}/{after + 1:09d}.json", json.dumps(state)):
            raise RuntimeError("the state was changed by another writer; read it again")
        return after + 1
