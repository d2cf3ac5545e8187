"""Ids that hold the numbers a question names.

Each run of seven digits or more is looked for in all ids, as it is and without leading zeros; a word for a country keeps the ids
with its prefix. The ids of a number come shortest first, then by name; of an id that several numbers find, the first counts.

A number stands inside a run of digits of an id. The runs of many ids are cut at once into the numbers of the lengths asked for; a
bitmap of the asked ones, of SLOTS bits whatever their count, drops most others, and a join the rest. Of each number a batch sends
the first ids of each country only, as no other can be among the first of all. So the work grows with the ids and with the
questions, not with their product. Numbers of more than WIDE digits are cut by Spark, from the ids that have such runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import rules
from docloom.functions import text as tx

WIDE = 18  # digits of a number that fit 64 bits
SLOTS = 1 << 26  # 8 MB
BATCH = 2 << 20  # bytes of ids that are cut at once


def _slots(n, value: np.ndarray) -> np.ndarray:
    """A slot of the bitmap for each number of n digits."""
    h = (value.astype(np.uint64) * np.uint64(32) + np.asarray(n).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def _bitmap(numbers: DataFrame) -> np.ndarray:
    """The slots of numbers (fragment) in words of 64 bits."""
    @F.pandas_udf("long")
    def slot(n: pd.Series, value: pd.Series) -> pd.Series:
        return pd.Series(_slots(n.to_numpy(), value.to_numpy()))

    at = numbers.select(slot(F.length("fragment"), F.col("fragment").cast("long")).alias("s"))
    bit = F.expr("shiftleft(1L, int(s % 64))")
    some = at.groupBy(F.floor(F.col("s") / 64).alias("w")).agg(F.bit_or(bit).alias("bits")).toPandas()  # SLOTS / 64 rows at most
    words = np.zeros(SLOTS // 64, np.int64)
    words[some.w.to_numpy(np.int64)] = some.bits.to_numpy(np.int64)
    return words.view(np.uint64)


def cut(ids: pa.Array, sizes: list[int], words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, length and value of the numbers in ids whose bit is set, of the lengths `sizes` (WIDE at most); each place is one."""
    ids = ids.cast(pa.large_binary())
    ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset:ids.offset + len(ids) + 1]
    code = np.frombuffer(ids.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]].astype(np.int64) - 48
    row = np.repeat(np.arange(len(ids)), np.diff(ends))
    at = np.flatnonzero((code >= 0) & (code <= 9))  # where numbers of the length reached start
    value, found = np.zeros(len(at), np.int64), []
    for n in range(1, max(sizes) + 1):
        inside = at + n - 1 < len(code)
        at, value = at[inside], value[inside]
        inside = (row[at + n - 1] == row[at]) & (code[at + n - 1] >= 0) & (code[at + n - 1] <= 9)
        at, value = at[inside], value[inside]
        value = value * 10 + code[at + n - 1]
        if n in sizes:
            s = _slots(n, value)
            met = (words[s >> 6] >> (s & 63).astype(np.uint64)) & np.uint64(1) == 1
            found.append((row[at[met]], np.full(int(met.sum()), n), value[met]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _numbers(sizes: list[int], words: np.ndarray, limit: int):
    """Of batches of id and country: id, country, size and value of the numbers that can be asked for; of each number and country the
    first `limit` ids of a batch."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in it:
            held.append(b)
            if sum(x.nbytes for x in held) >= BATCH:
                yield first(held)
                held = []
        if held:
            yield first(held)

    def first(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        ids, country = t.column("id").combine_chunks(), t.column("country").to_numpy()
        row, n, value = cut(ids, sizes, words)
        order = np.empty(len(ids), np.int64)
        order[pc.sort_indices(pa.table({"n": pc.utf8_length(ids), "id": ids}), [("n", "ascending"), ("id", "ascending")]).to_numpy()] = np.arange(len(ids))
        by = np.lexsort((order[row], country[row], value, n))
        row, n, value = row[by], n[by], value[by]
        other = np.ones(len(row), bool)  # an id that holds a number twice counts once
        other[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1]) | (n[1:] != n[:-1])
        row, n, value = row[other], n[other], value[other]
        new = np.ones(len(row), bool)
        new[1:] = (value[1:] != value[:-1]) | (n[1:] != n[:-1]) | (country[row[1:]] != country[row[:-1]])
        k = np.arange(len(row)) - np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
        row, n, value = row[k < limit], n[k < limit], value[k < limit]
        return pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pa.array(country[row], pa.int32()), pa.array(n, pa.int32()), pa.array(value, pa.int64())], ["id", "country", "size", "value"])

    return run


def _long(ids: DataFrame, numbers: DataFrame) -> DataFrame:
    """id, country, fragment: all numbers of the lengths of `numbers` in the ids' runs of more than WIDE digits."""
    runs = ids.select("id", "country", F.explode(F.regexp_extract_all("id", F.lit(f"[0-9]{{{WIDE + 1},}}"), F.lit(0))).alias("run"))
    lengths = numbers.select(F.length("fragment").alias("n")).filter(F.col("n") > WIDE).distinct()
    each = runs.join(F.broadcast(lengths), F.col("n") <= F.length("run")).select("id", "country", "run", "n", F.explode(F.sequence(F.lit(1), F.length("run") - F.col("n") + 1)).alias("i"))
    return each.select("id", "country", F.substr("run", "i", "n").alias("fragment")).distinct()


def holding(ids: DataFrame, numbers: DataFrame, limit: int) -> DataFrame:
    """fragment, id: of each number (fragment, each once) the ids that hold it, of each country (ids: id, each once) the first `limit`."""
    low = F.lower("id")
    country = F.coalesce(*[F.when(low.startswith(p), F.lit(k)) for k, (p, _) in enumerate(rules.COUNTRY_WORDS, 1)], F.lit(0))
    ids = ids.filter("id is not null").select("id", country.alias("country"))
    lengths = sorted(r.n for r in numbers.select(F.least(F.length("fragment"), F.lit(WIDE + 1)).alias("n")).distinct().collect())
    if not lengths:
        return numbers.join(ids.select("id"), F.lit(False))
    met, sizes = _long(ids, numbers), [n for n in lengths if n <= WIDE]
    if sizes:
        some = ids.mapInArrow(_numbers(sizes, _bitmap(numbers.filter(F.length("fragment") <= WIDE)), limit), "id string, country int, size int, value long")
        some = some.select("id", "country", F.lpad(F.col("value").cast("string"), F.col("size"), F.lit("0")).alias("fragment"))
        met = some.unionByName(met) if lengths[-1] > WIDE else some
    order = Window.partitionBy("fragment", "country").orderBy(F.length("id"), "id")
    return met.join(numbers, "fragment", "left_semi").withColumn("k", F.row_number().over(order)).filter(F.col("k") <= limit).select("fragment", "id")


def lookup(questions: DataFrame, ids: DataFrame, limit: int = 8) -> DataFrame:
    """query_id, rank, id. questions: query_id, text; ids: id (string)."""
    low = F.lower(F.coalesce("text", F.lit("")))
    prefix = F.coalesce(*[F.when(F.greatest(*[low.contains(w) for w in words]), p) for p, words in rules.COUNTRY_WORDS], F.lit(""))
    numbers = questions.select("query_id", prefix.alias("prefix"), F.posexplode(tx.id_fragments(F.col("text"))).alias("number", "fragment"))
    bare = F.coalesce(F.nullif(F.ltrim("fragment", F.lit("0")), F.lit("")), F.col("fragment"))
    forms = numbers.select("query_id", "prefix", "number", F.posexplode(F.array_distinct(F.array("fragment", bare))).alias("form", "fragment"))
    held = holding(ids.select("id").distinct(), forms.select("fragment").distinct(), limit)
    met = forms.join(held, "fragment").filter(F.lower("id").startswith(F.col("prefix")))
    order = Window.partitionBy("query_id", "number", "form").orderBy(F.length("id"), "id")
    some = met.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= limit)
    once = some.groupBy("query_id", "id").agg(F.min(F.struct("number", "form", "k")).alias("first"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("first"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= limit).select("query_id", "rank", "id")
