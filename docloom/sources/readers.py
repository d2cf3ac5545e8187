"""Where documents, cards and logs come from, and where results go."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """One row a file, by lower-case stem the first path."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    stem = F.lower(F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1))
    first = F.row_number().over(Window.partitionBy("stem").orderBy("path"))
    return found.withColumn("stem", stem).withColumn("n", first).filter("n = 1").drop("n")


def cards(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", "true").json(folder).withColumn("path", F.col("_metadata.file_path"))


def json_lines(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Lines that are records; blank and bad lines are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(folder)


def id_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("id")).filter("id <> '' and not startswith(id, '#')")


def upserted(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Old and new rows, the latest of each key."""
    last = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last())
    return old.unionByName(new).withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n")


def first_kept(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key; rows with a null in a key are all kept."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return rows.withColumn("_n", n).filter(~whole | (F.col("_n") == 1)).drop("_n")
