"""Flows of stages over documents that go on where they stopped.

A flow's documents are dealt to parts by a hash of their key. A stage is a function from rows to rows, and one Spark job does it for
`at_once` parts: the job's rows are written, then the ledger (a manifest) says that these parts are done and where they are. A job that
is lost leaves rows that no ledger names; run() again does what is left, and that only. The driver holds the ledger: a few
entries for each stage and part, no rows.

A stage names what it could not do: rows with an `error` (a string) are written apart (_failed=true) and not handed on but wait in
quarantine(), each a document (`key`); should a document have both kinds of rows in a stage, it failed. retry() gives the failed documents of a stage their input once more,
as further parts, until they were tried `tries` times.
take() adds documents; those whose key was taken before are left alone. Rows of one key are one document; null is a key like others.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.sources.store import Manifest, new_name
from docloom.sources.versioned import parted, spared

Stage = tuple[str, Callable[[DataFrame], DataFrame]]
GIVEN = "given"  # the name of the stage before the first


class Flow:
    """stages in their order; parts: how many a taken set is dealt to; files: into how many files a part's rows are written."""

    def __init__(self, spark: SparkSession, folder: str, key: str, stages: list[Stage], parts: int = 64, files: int = 1, at_once: int = 16, tries: int = 3):
        if not 0 < len(stages) == len({n for n, _ in stages} - {GIVEN}):
            raise ValueError("stages need names of their own")
        self.spark, self.folder, self.key, self.stages = spark, folder, key, stages
        self.parts, self.files, self.at_once, self.tries = parts, files, at_once, tries
        self.ledger = Manifest(spark, folder)
        self.before = dict(zip([n for n, _ in stages], [GIVEN, *(n for n, _ in stages)], strict=False))

    # The ledger: schema by stage; todo and done, by stage: folder by part; tries by part; errors and retried, by stage

    def _state(self) -> tuple[dict, int]:
        version = self.ledger.version()
        empty = {"schema": {}, "todo": {n: {} for n, _ in self.stages}, "done": {n: {} for n in (GIVEN, *self.before)}, "tries": {}, "errors": {n: [] for n in self.before}, "retried": {n: [] for n in self.before}}
        return self.ledger.state(version) or empty, version

    def _read(self, schema: dict, folders: dict[str, str], failed: bool | None = None) -> DataFrame:
        """The rows of some parts (part: folder), with _part; of what a stage wrote only those with an error, or those without."""
        apart = [] if failed is None else [T.StructField("_failed", T.BooleanType())]
        fields = T.StructType([*T.StructType.fromJson(schema), *apart, T.StructField("_part", T.StringType())])
        by_folder: dict[str, list[str]] = {}
        for part, folder in folders.items():
            by_folder.setdefault(folder, []).append(part)
        rows = [self.spark.read.schema(fields).parquet(f"{self.folder}/data/{f}").filter(F.col("_part").isin(ps)) for f, ps in by_folder.items()]
        out = reduce(DataFrame.unionByName, rows) if rows else self.spark.createDataFrame([], fields)
        return out if failed is None else out.filter(F.col("_failed") == failed).drop("_failed")

    def _write(self, rows: DataFrame, what: str, *apart: str) -> str:
        folder = new_name(what)
        rows.write.partitionBy(*apart, "_part").option("compression", "zstd").parquet(f"{self.folder}/data/{folder}")
        return folder

    def _same(self, a: DataFrame, b: DataFrame) -> Column:
        return a[self.key].eqNullSafe(b[self.key])

    def _failed(self, state: dict, stage: str, parts: list[str]) -> DataFrame:
        """The rows with an error of some parts of a stage."""
        return self._read(state["schema"][stage], {p: state["done"][stage][p] for p in parts}, True)

    def _good(self, state: dict, stage: str, parts: dict[str, str]) -> DataFrame:
        """What a stage hands on of some parts: the rows of documents without an error."""
        if stage == GIVEN:
            return self._read(state["schema"][stage], parts)
        bad = [p for p in parts if p in state["errors"][stage]]
        rows = self._read(state["schema"][stage], parts, False).drop("error")
        if not bad:
            return rows
        failed = self._failed(state, stage, bad).select(self.key, "_part").distinct()
        rest, rows = parted(rows, failed)  # the rest is handed on by the tasks that read it
        return rest.unionByName(rows.join(failed, self._same(rows, failed) & (rows["_part"] == failed["_part"]), "left_anti"))

    # What a user calls

    def take(self, rows: DataFrame) -> int:
        """Adds the documents of rows that were not taken before; how many parts of the flow are new."""
        state, version = self._state()
        schema = rows.schema.jsonValue()
        if state["done"][GIVEN]:
            names = T.StructType.fromJson(state["schema"][GIVEN]).names
            schema, known = state["schema"][GIVEN], self._read(state["schema"][GIVEN], state["done"][GIVEN]).select(self.key).distinct()
            rows = self._others(rows.select(*names), known)
        batch = str(len({p.split(".")[0] for p in state["tries"]}))
        deal = F.concat(F.lit(f"{batch}."), F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("string"))
        plain = [c for c, t in rows.dtypes if "map<" not in t and "variant" not in t]
        spread = F.pmod(F.xxhash64(*plain), F.lit(self.files))  # so that a part, or a key with many rows, is not one task's
        folder = self._write(rows.withColumn("_part", deal).repartition("_part", spread), GIVEN)
        there = self._parts(folder)
        state["schema"][GIVEN] = schema
        self._add(state, GIVEN, self.stages[0][0], there, folder, 1)
        self.ledger.put(state, version)
        return len(there)

    def _others(self, rows: DataFrame, known: DataFrame) -> DataFrame:
        """rows whose key is not in `known`."""
        kind = known.schema[self.key].dataType
        if rows.schema[self.key].dataType != kind:  # equal keys have equal hashes
            rows = rows.withColumn(self.key, F.col(self.key).cast(kind))
        others, met = parted(rows, known)
        return others.unionByName(spared(met, known))

    def _parts(self, folder: str) -> list[str]:
        names = self.ledger.files.names(f"{self.folder}/data/{folder}")
        return [n.split("=", 1)[1] for n in names if n.startswith("_part=")]

    @staticmethod
    def _add(state: dict, done: str, todo: str, parts: list[str], folder: str, tries: int) -> None:
        for p in parts:
            state["done"][done][p] = state["todo"][todo][p] = folder
            state["tries"][p] = tries

    def left(self) -> dict[str, list[str]]:
        """The parts that each stage has still to do, as far as the stages before have come."""
        state, _ = self._state()
        return {n: sorted(set(state["todo"][n]) - set(state["done"][n])) for n in self.before}

    def run(self) -> None:
        """Does what is left, `at_once` parts a job, and enters each job in the ledger."""
        for k, (name, work) in enumerate(self.stages):
            while parts := self.left()[name][: self.at_once]:
                state, version = self._state()
                given = {p: state["todo"][name][p] for p in parts}
                source = self.before[name]
                inputs = self._good(state, source, given) if all(p in state["done"][source] for p in parts) else self._inputs(state, name, given)
                out = work(inputs)
                if "error" not in out.columns:
                    out = out.withColumn("error", F.lit(None).cast("string"))
                folder = self._write(out.withColumn("_failed", F.col("error").isNotNull()), name, "_failed")
                state["schema"][name] = out.drop("_part").schema.jsonValue()
                state["done"][name] |= dict.fromkeys(parts, folder)
                state["errors"][name] += self._parts(f"{folder}/_failed=true")
                if k + 1 < len(self.stages):
                    state["todo"][self.stages[k + 1][0]] |= dict.fromkeys(parts, folder)
                self.ledger.put(state, version)

    def _inputs(self, state: dict, stage: str, given: dict[str, str]) -> DataFrame:
        """The input of parts; that of a retried part is written as it was handed on, without `error`."""
        source = self.before[stage]
        first = {p: f for p, f in given.items() if p in state["done"][source]}
        again = {p: f for p, f in given.items() if p not in first}
        fields = T.StructType.fromJson(state["schema"][source])
        handed = T.StructType([f for f in fields if f.name != "error" or source == GIVEN]).jsonValue()
        rows = self._read(handed, again)
        return self._good(state, source, first).unionByName(rows) if first else rows

    def retry(self) -> int:
        """Readies the failed documents that were tried fewer than `tries` times for run(); how many parts that makes."""
        made = 0
        for name in self.before:
            for tried in range(1, self.tries):
                state, version = self._state()
                parts = [p for p in state["errors"][name] if p not in state["retried"][name] and state["tries"][p] == tried]
                if not parts:
                    continue
                failed = self._failed(state, name, parts).select(self.key).distinct()
                inputs = parted(self._inputs(state, name, {p: state["todo"][name][p] for p in parts}), failed)[1]
                batch = str(len({p.split(".")[0] for p in state["tries"]}))
                again = inputs.join(failed, self._same(inputs, failed), "left_semi")
                folder = self._write(again.withColumn("_part", F.concat(F.lit(f"{batch}."), F.substring_index("_part", ".", -1))), f"{name}-again")
                there = self._parts(folder)
                state["todo"][name] |= dict.fromkeys(there, folder)
                state["tries"] |= dict.fromkeys(there, tried + 1)
                state["retried"][name] += parts
                self.ledger.put(state, version)
                made += len(there)
        return made

    def table(self, stage: str) -> DataFrame:
        """What a stage has handed on so far."""
        state, _ = self._state()
        return self._good(state, stage, state["done"][stage]).drop("_part")

    def quarantine(self) -> DataFrame:
        """key, stage, error (the least of a document's), tries: documents that failed and did not pass since."""
        state, _ = self._state()
        out = []
        for name in self.before:
            parts = [p for p in state["errors"][name] if p not in state["retried"][name]]
            if parts:
                rows = self._failed(state, name, parts).groupBy(self.key, "_part").agg(F.min("error").alias("error"))
                tries = F.create_map(*[F.lit(x) for p in parts for x in (p, state["tries"][p])])
                out.append(rows.select(self.key, F.lit(name).alias("stage"), "error", tries[F.col("_part")].alias("tries")))
        if out:
            return reduce(DataFrame.unionByName, out)
        key = T.StructType.fromJson(state["schema"][GIVEN])[self.key].dataType if state["schema"] else T.StringType()
        return self.spark.createDataFrame([], T.StructType([T.StructField(self.key, key), T.StructField("stage", T.StringType()), T.StructField("error", T.StringType()), T.StructField("tries", T.IntegerType())]))
