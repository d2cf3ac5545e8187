"""Operator 3, benchmark decontamination by pigeonhole edit matching.

An item of m characters may occur with up to e = floor(RATE * m) edits. It is split into e + 1 pieces; an
occurrence with at most e edits leaves one piece untouched, so exact piece hits (one pass of an
Aho-Corasick automaton over each whole text) find every place to look at. Each place is verified by
Myers' bit-parallel edit distance, the item being one bit vector.

Case and runs of white space do not count. Items are a stated query set: they are held in blocks of
BLOCK items, and each block meets all documents; nothing grows with the number of documents.

Defined results: null or empty texts and items match nothing; repeated items and documents each give
their rows; ties take the leftmost occurrence; extra columns stay (filter) or do not matter (hits).
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import small_batches, table

RATE = 0.08
BLOCK = 5_000


def normal(text: str) -> str:
    low = text.lower()
    if len(low) != len(text):
        low = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    return " ".join(low.split())


def budget(m: int, rate: float) -> int:
    return int(m * rate)


def pieces(item: str, rate: float) -> Iterator[tuple[int, str]]:
    n = budget(len(item), rate) + 1
    for i in range(n):
        low, high = i * len(item) // n, (i + 1) * len(item) // n
        yield low, item[low:high]


def best_end(pattern: str, text: str) -> tuple[int, int]:
    """The least edit distance of the pattern to any substring of text, and where the first such one ends."""
    m = len(pattern)
    peq: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        peq[c] |= 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = mask, 0, m, (m, 0)
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & mask)
        mh = pv & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = (ph << 1) & mask, (mh << 1) & mask
        pv, mv = mh | (~(xv | ph) & mask), ph & xv
        if score < best[0]:
            best = (score, j + 1)
    return best


def occurrence(item: str, text: str, low: int, high: int) -> tuple[int, int, int]:
    """(distance, start, end) of the item's best occurrence within text[low:high]."""
    window = text[max(0, low) : high]
    distance, end = best_end(item, window)
    _, back = best_end(item[::-1], window[:end][::-1][: len(item) + distance])
    return distance, max(0, low) + end - back, max(0, low) + end


class Scanner:
    """The automaton of a block of items (item_id, normal text)."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items, self.rate = items, rate
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, item) in enumerate(items):
            for at, piece in pieces(item, rate):
                where[piece].append((k, at))
        self.auto = ahocorasick.Automaton()
        for piece, places in where.items():
            self.auto.add_word(piece, (len(piece), places))
        if where:
            self.auto.make_automaton()
        self.empty = not where

    def hits(self, text: str) -> dict[int, tuple[int, int, int]]:
        """Per item: its best occurrence, leftmost of equals."""
        found: dict[int, tuple[int, int, int]] = {}
        seen: dict[int, set[int]] = defaultdict(set)
        if self.empty or not text:
            return found
        for last, (size, places) in self.auto.iter(text):
            for k, at in places:
                item = self.items[k][1]
                e, start = budget(len(item), self.rate), last - size + 1 - at
                if start in seen[k] or (k in found and found[k][0] == 0):
                    continue
                seen[k].add(start)
                if start >= 0 and text.startswith(item, start):
                    now = (0, start, start + len(item))
                else:
                    now = occurrence(item, text, start - e, start + len(item) + e)
                if now[0] <= e and (k not in found or now < found[k]):
                    found[k] = now
        return found


def _original(text: str, start: int, end: int) -> tuple[int, int]:
    """Code points of the raw text for a span of the normal one."""
    at, low, high = 0, 0, len(text)
    for m in re.finditer(r"\S+", text):
        n = len(m.group())
        if at <= start < at + n + 1:
            low = m.start() + min(start - at, n)
        if at < end <= at + n + 1:
            high = m.start() + min(end - at, n)
            break
        at += n + 1
    return low, high


def item_blocks(items: DataFrame, size: int = BLOCK) -> Iterator[list[tuple[int, str]]]:
    block: list[tuple[int, str]] = []
    for r in items.select("item_id", "text").filter("text is not null").toLocalIterator():
        if t := normal(r["text"]):
            block.append((r["item_id"], t))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def hits(docs: DataFrame, items: DataFrame, rate: float = RATE, size: int = BLOCK) -> DataFrame:
    """doc_id, item_id, distance, start, end (code points of the raw text): a row for each item that occurs in a document."""
    spark = docs.sparkSession
    small_batches(spark)
    schema = "doc_id long, item_id long, distance int, start long, end long"
    out = spark.createDataFrame([], schema)
    for block in item_blocks(items, size):
        sent = spark.sparkContext.broadcast(block)  # at most `size` items

        def run(it, sent=sent):
            scan = Scanner(sent.value, rate)
            for b in it:
                rows = []
                for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                    for k, (distance, start, end) in scan.hits(normal(text or "")).items():
                        rows.append((doc, scan.items[k][0], distance, *_original(text, start, end)))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int32() if i == 2 else pa.int64()) for i in range(5)], ["doc_id", "item_id", "distance", "start", "end"])

        out = out.unionByName(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema))
    return out


def clean(docs: DataFrame, items: DataFrame, rate: float = RATE, size: int = BLOCK) -> DataFrame:
    """The documents without any item, with all their columns; no shuffle."""
    spark = docs.sparkSession
    small_batches(spark)
    for block in item_blocks(items, size):
        sent = spark.sparkContext.broadcast(block)

        def run(it, sent=sent):
            scan = Scanner(sent.value, rate)
            for b in it:
                yield b.filter(pa.array([not scan.hits(normal(t or "")) for t in b.column("text").to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op3_decontaminate": op3_decontaminate}
