"""Tables that change as one: a change of several tables is seen whole or not at all.

A table's rows are dealt to buckets by a hash of its keys. A change reads and writes the buckets that its keys fall in, into new
folders; then one manifest of the whole database names the new folders instead of the old ones. A writer that is
lost before that leaves folders that no manifest names; a second writer of the same version gets an error and changes
nothing. Earlier versions can be read until vacuum() deletes what the last ones do not name.

A change joins only rows that may meet its keys: a bitmap of the keys, of SLOTS bits whatever their count, goes to all tasks, and the
rows whose bit is not set are written by the task that reads them, without a shuffle. Of what the bit lets pass the keys are joined.
A task writes the files of its buckets side by side, as sorting its rows by bucket would spill them (WRITERS at most, then it sorts).

Keys may be null (null equals null). Rows of a change with equal keys: the last by `order` counts, or an arbitrary one without.
An empty change makes a new version with the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.sources.store import Files, Manifest, new_name

SLOTS = 1 << 26  # 16 MB as words of 64 bits
WRITERS = 64  # files that a task may have open at once
FILES = 8  # into how many files at most the rows that are dealt to a bucket are written, so that no task gets a whole bucket


def same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def latest(rows: DataFrame, keys: list[str], order: str | None) -> DataFrame:
    """One row of each key: the last by order."""
    by = F.col(order).desc_nulls_last() if order else F.lit(0)
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(by))).filter("_n = 1").drop("_n")


def parted(rows: DataFrame, which: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows whose key columns (those of `which`, of the same types) are not in `which`, and those that may be."""
    slot = F.pmod(F.xxhash64(*which.columns), F.lit(SLOTS))
    one = which.select(slot.alias("_s"))
    words = one.groupBy(F.expr("_s div 64").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, int(_s % 64))")).alias("_bits"))
    met = rows.withColumn("_s", slot).withColumn("_word", F.expr("_s div 64")).join(F.broadcast(words), "_word", "left")
    may = F.expr("coalesce(shiftrightunsigned(_bits, int(_s % 64)) & 1L, 0L) = 1L")
    return met.filter(~may).select(*rows.columns), met.filter(may).select(*rows.columns)


def spared(may: DataFrame, which: DataFrame) -> DataFrame:
    """Of the rows that parted() lets pass, those whose keys are not in `which`: the keys are joined, and only the rows of those that
    had but a bit in common with one of `which`, few, are then sought and joined."""
    keys = may.select(*which.columns).distinct()
    other = keys.join(which, same(keys, which, which.columns), "left_anti")
    again = parted(may, other)[1]
    return again.join(other, same(again, other, which.columns), "left_semi")


class Database:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.manifest = spark, folder, Manifest(spark, folder)

    def version(self) -> int:
        return self.manifest.version()

    def table(self, name: str, version: int | None = None) -> DataFrame:
        return self._read((self.manifest.state(version) or {})[name])

    def _read(self, table: dict, buckets: list[int] | None = None) -> DataFrame:
        """The rows of some buckets, or of all."""
        schema = T.StructType.fromJson(table["schema"])
        names = {int(k): v for k, v in table["buckets"].items() if buckets is None or int(k) in buckets}
        by_folder: dict[str, list[int]] = {}
        for k, v in names.items():
            by_folder.setdefault(v, []).append(k)
        parts = [self.spark.read.schema(T.StructType([*schema, T.StructField("_bucket", T.IntegerType())])).parquet(f"{self.folder}/data/{v}").filter(F.col("_bucket").isin(ks)) for v, ks in by_folder.items()]
        if not parts:
            return self.spark.createDataFrame([], schema)
        return reduce(DataFrame.unionByName, parts).select(*schema.names)

    def change(self) -> Change:
        return Change(self)

    def vacuum(self, keep: int = 1) -> None:
        """Deletes the data that none of the last `keep` versions names."""
        files, last = Files(self.spark), self.version()
        named = {f for v in range(max(1, last - keep + 1), last + 1) for t in self.manifest.state(v).values() for f in t["buckets"].values()}
        for name in files.names(f"{self.folder}/data"):
            if name not in named:
                files.delete(f"{self.folder}/data/{name}")


class Change:
    """Changes of tables that commit() makes at once. Each step sees the steps before it."""

    def __init__(self, db: Database):
        self.db, self.after = db, db.version()
        self.state: dict = db.manifest.state(self.after) or {}

    def table(self, name: str) -> DataFrame:
        return self.db._read(self.state[name])

    def _bucket(self, name: str) -> Column:
        t = self.state[name]
        return F.pmod(F.xxhash64(*t["by"]), F.lit(t["n"])).cast("int")

    def _write(self, name: str, rows: DataFrame, folder: str) -> None:
        conf, key = self.db.spark.conf, "spark.sql.maxConcurrentOutputFileWriters"
        before = conf.get(key, "0")
        conf.set(key, str(min(self.state[name]["n"], WRITERS) + 1))  # a task that reaches this number sorts the rest
        try:
            rows.write.partitionBy("_bucket").option("compression", "zstd").parquet(folder)
        finally:
            conf.set(key, before)

    def _put(self, name: str, rows: DataFrame | None, touched: list[int], stay: DataFrame | None = None) -> None:
        """rows, and those that `stay` where the tasks read them, are all that the touched buckets hold from now on."""
        t, folder = self.state[name], new_name(name)
        parts, columns = [], [f["name"] for f in t["schema"]["fields"]]
        if stay is not None:
            parts.append(stay.select(*columns).withColumn("_bucket", self._bucket(name)))
        if rows is not None:
            spread = F.pmod(F.shiftrightunsigned(F.xxhash64(*t["by"]), 32), F.lit(FILES))
            parts.append(rows.select(*columns).withColumn("_bucket", self._bucket(name)).repartition("_bucket", spread))
        self._write(name, reduce(DataFrame.unionByName, parts), f"{self.db.folder}/data/{folder}")
        there = {n.split("=")[1] for n in Files(self.db.spark).names(f"{self.db.folder}/data/{folder}") if n.startswith("_bucket=")}
        kept = {k: v for k, v in t["buckets"].items() if int(k) not in touched}
        self.state[name] = t | {"buckets": kept | dict.fromkeys(there, folder)}

    def _like(self, name: str, which: DataFrame) -> DataFrame:
        """which, with the types of the table's columns, so that equal keys have equal hashes."""
        kinds = {f.name: f.dataType for f in T.StructType.fromJson(self.state[name]["schema"])}
        return which.select(*[F.col(c).cast(kinds[c]) if which.schema[c].dataType != kinds[c] else F.col(c) for c in which.columns])

    def _touched(self, name: str, rows: DataFrame) -> list[int]:
        return [r[0] for r in rows.select(self._bucket(name)).distinct().collect()]  # as many as buckets

    def create(self, name: str, rows: DataFrame, keys: list[str], by: list[str] | None = None, buckets: int = 64, shuffle: bool = True) -> Change:
        """keys tell rows apart; by: the keys that deal them to buckets (those that changes name). Without `shuffle` each task
        writes its rows of each bucket to a file of its own: for rows that come in large pieces, as from large files."""
        self.state[name] = {"schema": rows.schema.jsonValue(), "keys": keys, "by": by or keys, "n": buckets, "buckets": {}}
        self._put(name, *((rows, []) if shuffle else (None, [], rows)))
        return self

    def delete(self, name: str, which: DataFrame) -> Change:
        """Removes the rows whose key columns (those of `which`; the dealing ones among them) are in `which`."""
        which = self._like(name, which)
        touched = self._touched(name, which)
        stay, may = parted(self.db._read(self.state[name], touched), which)
        self._put(name, spared(may, which), touched, stay)
        return self

    def upsert(self, name: str, rows: DataFrame, order: str | None = None, keep_where_null: tuple[str, ...] = ()) -> Change:
        """Inserts rows, or updates all columns of those whose keys are there; a null of keep_where_null leaves what was."""
        keys = self.state[name]["keys"]
        columns = [f["name"] for f in self.state[name]["schema"]["fields"]]
        new = self._like(name, latest(rows, keys, order).select(*columns))
        touched = self._touched(name, new)
        stay, old = parted(self.db._read(self.state[name], touched), new.select(*keys))
        if keep_where_null:
            was = old.select(*[F.col(c).alias(f"_was_{c}") for c in (*keys, *keep_where_null)])
            met = new.join(was, reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_was_{k}")) for k in keys]), "left")
            new = met.select(*[F.coalesce(c, f"_was_{c}").alias(c) if c in keep_where_null else F.col(c) for c in columns])
        self._put(name, spared(old, new.select(*keys)).unionByName(new), touched, stay)
        return self

    def insert_new(self, name: str, rows: DataFrame, order: str | None = None) -> Change:
        """Inserts the rows whose keys are not there; of equal new ones the last by order."""
        keys = self.state[name]["keys"]
        columns = [f["name"] for f in self.state[name]["schema"]["fields"]]
        new = self._like(name, latest(rows, keys, order).select(*columns))
        touched = self._touched(name, new)
        old = self.db._read(self.state[name], touched)
        may = parted(old.select(*keys), new.select(*keys))[1]
        self._put(name, new.join(may, same(new, may, keys), "left_anti"), touched, old)
        return self

    def replace(self, name: str, which: DataFrame, rows: DataFrame) -> Change:
        """Removes the rows of `which` and inserts `rows`; rows stay whole when a key is in both."""
        columns = [f["name"] for f in self.state[name]["schema"]["fields"]]
        which, rows = self._like(name, which), self._like(name, rows.select(*columns))
        touched = sorted({*self._touched(name, which), *self._touched(name, rows)})
        stay, may = parted(self.db._read(self.state[name], touched), which)
        self._put(name, spared(may, which).unionByName(rows), touched, stay)
        return self

    def backup(self, name: str, into: str, which: DataFrame, run_id: str) -> Change:
        """Copies the rows of `which` to the table `into` (made if it is not there) under a run's name."""
        keys, which = which.columns, self._like(name, which)
        old = parted(self.db._read(self.state[name], self._touched(name, which)), which)[1]
        copies = old.join(which.distinct(), same(old, which, keys), "left_semi").withColumn("run_id", F.lit(run_id))
        if into not in self.state:
            t = self.state[name]
            return self.create(into, copies, [*t["keys"], "run_id"], t["by"], t["n"])
        return self.insert_new(into, copies)

    def commit(self) -> int:
        return self.db.manifest.put(self.state, self.after)
