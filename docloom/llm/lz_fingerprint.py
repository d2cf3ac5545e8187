"""Operator 5, Lempel-Ziv phrase fingerprints.

A text is parsed into dictionary phrases (LZ78: each phrase is the shortest not seen before), the phrases
are hashed, and the least hashes of the set are the document's signature. Documents that compress
alike share phrases; likeness() estimates the Jaccard similarity of two phrase sets from signatures.

The query compares each document with its neighbour in descending doc_id. Ranges of ids go to
partitions; the first row of a range also goes to the range before it, as a guest, so each range is
parsed alone, in order, two rows at a time.

Defined results: null text: empty, no phrases, fingerprint ''; two empty sets are alike (1); ties of
doc_id are ordered by text; null doc_id last; a single row is its own neighbour; extra columns do not matter.
"""

from __future__ import annotations

import base64
import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import mixed, shuffle_partitions, small_batches, table, written

SIZE = 128  # least hashes that are kept
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(1 << 14, 2 * n)
        _powers["up"], _powers["down"] = (np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b))), dtype=np.uint64) for b in (BASE, INVERSE))
    return _powers["up"][:n], _powers["down"][:n]


@dataclass
class Parse:
    """phrases: phrase -> its rank; ends: where each phrase of the dictionary ended."""

    phrases: dict[str, int]
    ends: list[int]


def parse(text: str) -> Parse:
    phrases: dict[str, int] = {}
    ends: list[int] = []
    x, at = "", 0
    for c in text:
        x += c
        if x not in phrases:
            phrases[x] = len(ends)
            at += len(x)
            ends.append(at)
            x = ""
    return Parse(phrases, ends)


def parse_changed(text: str, cut: int, before: Parse) -> list[int]:
    """The phrase ends of a text that equals the parsed one up to `cut`: its parse goes on from there."""
    known = int(np.searchsorted(before.ends, cut, side="right"))
    ends, own, old = before.ends[:known], set(), before.phrases
    x, at = "", ends[-1] if ends else 0
    for c in text[at:]:
        x += c
        if x not in own and old.get(x, known) >= known:
            own.add(x)
            at += len(x)
            ends.append(at)
            x = ""
    return ends


def least_hashes(text: str, ends: list[int], size: int = SIZE) -> np.ndarray:
    """The `size` least 32-bit hashes of the phrases; what is left at the end, a known phrase, adds nothing."""
    if not ends:
        return np.zeros(0, np.uint32)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    up, down = _power(len(codes) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * up[: len(codes)], dtype=np.uint64)))
    stop = np.array(ends)
    start = np.append(0, stop[:-1])
    h = mixed((sums[stop] - sums[start]) * down[start] + (stop - start).astype(np.uint64) * BASE)
    return np.unique((h >> np.uint64(32)).astype(np.uint32))[:size]


def shown(h: np.ndarray) -> str:
    return base64.b64encode(h.astype("<u4").tobytes()).decode()


def hashes(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Estimated Jaccard similarity: of the least hashes of both together, the part that both have."""
    if not len(a) and not len(b):
        return 1.0
    both = np.union1d(a, b)[:size]
    return float(np.isin(both, np.intersect1d(a, b, assume_unique=True), assume_unique=True).mean())


def fingerprint(text: str | None) -> str:
    return shown(least_hashes(text or "", parse(text or "").ends))


def _ranges(docs: DataFrame, n: int) -> DataFrame:
    """docs with part: ranges of descending doc_id; null ids in the last."""
    bounds = docs.stat.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.25 / n) if n > 1 else []
    cuts = F.array(*[F.lit(int(x)) for x in sorted(set(bounds), reverse=True)]).cast("array<long>")
    return docs.withColumn("part", F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(F.size(F.filter(cuts, lambda x: x >= F.col("doc_id")))))


def neighbours(docs: DataFrame, n: int) -> DataFrame:
    """docs by part in descending doc_id; each part ends with a guest: the first row of the next, or of all."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    docs = _ranges(docs, n)
    # one row a part: the largest id, and of its rows the first by text hash
    heads = written(docs.groupBy("part").agg(F.min(F.struct((-F.col("doc_id")).alias("o"), F.md5("text").alias("h"))).alias("first")), "heads")
    parts = [r["part"] for r in heads.select("part").orderBy("part").collect()]
    if not parts:
        return docs.withColumns({"guest": F.lit(False)})
    after = {p: parts[i - 1] for i, p in enumerate(parts)}  # the part that a head is a guest of
    guests = heads.select(F.col("part").alias("p"), F.col("first.o").alias("o"), F.col("first.h").alias("h"), F.element_at(F.create_map(*[F.lit(x) for kv in after.items() for x in kv]), F.col("part")).alias("to"))
    met = docs.join(F.broadcast(guests), (F.col("part") == F.col("p")) & F.col("o").eqNullSafe(-F.col("doc_id")) & (F.md5("text") == F.col("h")), "left")
    first = F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("guest")))
    return met.select("doc_id", "text", F.explode(F.when(F.col("to").isNull(), first).otherwise(F.concat(first, F.array(F.struct(F.col("to").alias("part"), F.lit(True).alias("guest")))))).alias("x")).select("x.part", "x.guest", "doc_id", "text")


def compared(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document."""
    spark = docs.sparkSession
    small_batches(spark, 256)
    n = max(1, shuffle_partitions(spark))

    def run(it):
        held, part, done = None, None, False
        for b in it:
            out = []
            for p, doc, text, guest in zip(*(b.column(c).to_pylist() for c in ("part", "doc_id", "text", "guest")), strict=True):
                if p != part:
                    held, part, done = None, p, False
                if done:  # rows equal to the guest
                    continue
                now = (doc, text, parse(text))
                now = (*now, least_hashes(text, now[2].ends))
                if held is not None:
                    out.append(row(*held, text, now[3]))
                held, done = now, guest
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    def row(doc, text, parsed, mine, other, others):
        cut = len(text) - len(text) // 3
        edited = text[:cut] + other[: len(text) // 3]
        theirs = least_hashes(edited, parse_changed(edited, cut, parsed))
        return {"doc_id": doc, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), "fingerprint": shown(mine), "edited_fingerprint": shown(theirs), "near_edited": likeness(mine, theirs), "near_next": likeness(mine, others)}

    arrow = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    rows = neighbours(docs, 4 * n).repartition(n, "part").sortWithinPartitions("part", "guest", F.col("doc_id").desc_nulls_last(), F.md5("text"))
    return rows.select("part", "doc_id", "text", "guest").mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op5_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(table(spark, sf_dir, "documents"))


QUERIES = {"op5_lz_fingerprint": op5_lz_fingerprint}
