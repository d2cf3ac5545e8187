"""What the operators of this subpackage share: table access, shared folders, hashing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word, as every operator here counts them: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's, or (in tests) one of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"file://{tempfile.mkdtemp(prefix='docloom-shared-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def free_name(name: str, taken: list[str]) -> str:
    """The name, with underscores before it until no column has it (names differ by case only: taken)."""
    low = {x.lower() for x in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, what: str) -> DataFrame:
    """df, written as Parquet in the shared folder and read again: lineage ends here, and lost executors lose nothing."""
    spark = df.sparkSession
    df.write.parquet(folder := new_folder(spark, what))
    return spark.read.schema(df.schema).parquet(folder)


#: Shuffle files go when the query that made them has ended, not when the driver's memory is collected.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables of one job in the shared folder, deleted when nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folders = spark, {}

    def written(self, df: DataFrame, what: str) -> DataFrame:
        """written(), without the shuffle files; `what` names it for drop()."""
        before = self.spark.conf.get(TIDY, "false")
        self.spark.conf.set(TIDY, "true")
        try:
            df.write.option("parquet.block.size", 16 << 20).parquet(folder := new_folder(self.spark, what))
        finally:
            self.spark.conf.set(TIDY, before)
        self.folders.setdefault(what, []).append(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def drop(self, *names: str) -> None:
        """Deletes the tables of these names; all without a name."""
        context = self.spark.sparkContext
        for name in names or tuple(self.folders):
            for folder in self.folders.pop(name, ()):
                path = context._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Bounds what one Arrow batch holds, for tables with very long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(min(rows, 512)))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def word_count(c: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def words_of(text: bytes | None) -> list[bytes]:
    """The words, A-Z lower-cased; bytes.lower and bytes.split know ASCII only, as the word rule does."""
    return text.lower().split() if text else []


class WordHashes(dict):
    """word -> 64-bit hash, kept for words seen before; forgets all beyond `most` words."""

    def __init__(self, most: int = 150_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of a public 64-bit hash)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def batches(it: Iterator[pa.RecordBatch], *columns: str) -> Iterator[list[list]]:
    for b in it:
        yield [b.column(c).to_pylist() for c in columns]
